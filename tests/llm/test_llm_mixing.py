from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from perkline.llm import mixing
from perkline.llm.queries import QUERIES


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    budget = share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        level = (budget - sum(cap * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > cap * sizes[s]]
        if not over:
            return {s: cap * sizes[s] if s in full else level * weight[s] for s in names}
        full.update(over)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows, sources = [], []
    for i in range(900):
        rows.append((i, " ".join("w" for _ in range(int(rng.paretovariate(1.3) * 20) % 900))))
        sources.append("hot" if i % 3 == 0 else rng.choice(["a", "B", "ü", "", None, "z9", "m"]))
    return rows, sources


def test_targets_and_words_taken(documents, corpus):
    rows, sources = corpus
    got = mixing.curriculum(documents(rows, sources)).collect()
    sizes = defaultdict(int)
    for (_, text), source in zip(rows, sources):
        sizes[source] += size(text)
    targets = brute_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == size(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert sum(t["words"] for t in r["takes"]) <= 2 * r["size"]
        assert all(0 <= t["position"] <= 1 for t in r["takes"])
        taken[r["source"]] += sum(t["words"] for t in r["takes"])
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_positions_follow_the_schedule(documents, corpus):
    rows, sources = corpus
    takes = defaultdict(list)
    slope = {s: mixing.SLOPES[i % 3] for i, s in enumerate(sorted(set(sources), key=lambda s: (s is None, s or "")))}
    for r in mixing.curriculum(documents(rows, sources)).collect():
        takes[r["source"]] += [(t["position"], t["words"], r["target"]) for t in r["takes"]]
    for source, own in takes.items():
        demanded = 0
        for position, words, target in sorted(own):
            k = slope[source]
            assert target * (position + k * (position**2 - position)) == pytest.approx(demanded, abs=1 + target / 1e6)
            demanded += words


def test_whole_documents_and_order(documents, corpus):
    rows, sources = corpus
    docs = documents(rows, sources)
    planned = mixing.curriculum(docs, whole=True)
    expected = defaultdict(int)
    for r in planned.collect():
        assert all(t["words"] == r["size"] for t in r["takes"])
        expected[r["doc_id"]] = len(r["takes"])
    ordered = mixing.training_order(planned, docs.columns)
    assert ordered.columns == docs.columns
    seen = defaultdict(int)
    for r in ordered.collect():
        seen[r["doc_id"]] += 1
    assert seen == {d: n for d, n in expected.items() if n}


def test_reruns_agree(documents, corpus):
    runs = [
        sorted((r["doc_id"], tuple(map(tuple, r["takes"]))) for r in mixing.curriculum(documents(*corpus)).collect())
        for _ in range(2)
    ]
    assert runs[0] == runs[1]


def test_odd_rows(documents, odd_texts):
    got = mixing.curriculum(documents(odd_texts)).collect()
    assert sorted(repr((r["doc_id"], r["size"])) for r in got) == sorted(repr((d, size(t))) for d, t in odd_texts)
    assert mixing.curriculum(documents(odd_texts).where("false")).count() == 0
    empty = mixing.curriculum(documents([(1, None), (2, " ")])).collect()
    assert [(r["target"], r["takes"]) for r in empty] == [(0.0, [])] * 2


def test_ranks_follow_positions(session, documents, corpus):
    """The query's rows: what is taken, and where in the training order, from the schedules of all sources."""
    rows, sources = corpus
    planned = mixing.curriculum(documents(rows, sources))
    got = mixing.training_ranks(planned).collect()
    plain = {r["doc_id"]: r for r in planned.collect()}
    places = sorted((rank, r["doc_id"]) for r in got for rank in r["ranks"])
    assert [rank for rank, _ in places] == list(range(len(places)))
    assert len(got) == len(rows)
    positions, seen = [], defaultdict(int)
    for _, doc_id in places:
        takes = sorted(plain[doc_id]["takes"], key=lambda t: t["position"])
        positions.append(takes[seen[doc_id]]["position"])
        seen[doc_id] += 1
    assert positions == sorted(positions)
    for r in got:
        takes = plain[r["doc_id"]]["takes"]
        assert len(r["ranks"]) == len(takes) and r["taken"] == sum(t["words"] for t in takes)
        assert r["first_position"] == min((t["position"] for t in takes), default=None)


def test_query_equals_brute_force(session):
    """The registered query against targets and demands counted in Python over the whole table."""
    sf_dir = "/root/testdata/sf0.001"
    got = QUERIES["op7_mixing"](session, sf_dir).collect()
    docs = session.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    sizes, taken, demand = defaultdict(int), defaultdict(int), defaultdict(list)
    for d in docs:
        sizes[d["source"]] += size(d["text"])
    targets = brute_targets(sizes)
    source = {d["doc_id"]: d["source"] for d in docs}
    plain = {d["doc_id"]: size(d["text"]) for d in docs}
    assert sorted(r["doc_id"] for r in got) == sorted(source)
    for r in got:
        own = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (plain[r["doc_id"]], sizes[own])
        assert r["target"] == pytest.approx(targets[own]) and 0 <= r["taken"] <= 2 * r["size"]
        assert bool(r["ranks"]) == (r["taken"] > 0)
        taken[own] += r["taken"]
        demand[own] += [r["first_position"]] if r["ranks"] else []
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    ranks = sorted(rank for r in got for rank in r["ranks"])
    assert ranks == list(range(len(ranks)))


def test_the_training_order_is_range_sorted(documents, corpus, capsys):
    mixing.training_order(mixing.curriculum(documents(*corpus), whole=True), ["doc_id"]).explain()
    assert "rangepartitioning" in capsys.readouterr().out


def test_columns_with_names_of_helpers_stay(documents, corpus):
    rows, sources = corpus
    names = ("_order", "_range", "_start", "_source", "_inside", "_from", "_take", "_position", "_tie", "slope", "_at")
    docs = documents(rows[:200], sources[:200]).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    planned = mixing.curriculum(docs, whole=True)
    got = mixing.training_order(planned, docs.columns).collect()
    assert got and all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names)
    same = mixing.curriculum(documents(rows[:200], sources[:200]), whole=True)
    assert sorted(map(repr, planned.select("doc_id", "takes").collect())) == sorted(map(repr, same.select("doc_id", "takes").collect()))
