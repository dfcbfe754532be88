from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from perkline.llm import ngram_join
from perkline.llm.components import connected_components


def sets_of(text, n):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) >= n:
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def brute(pairs, n, percent):
    """Per row (doc_id, size, smallest id reachable), every pair compared."""
    sets = [sets_of(t, n) for _, t in pairs]
    group = list(range(len(pairs)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if pairs[i][0] is None or pairs[j][0] is None or not a or not b:
                continue
            if 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    out = Counter()
    for i, (d, _) in enumerate(pairs):
        ids = [pairs[j][0] for j in range(len(pairs)) if group[j] == group[i]]
        out[(d, len(sets[i]), None if d is None else min(ids))] += 1
    return out


def found(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.fixture(scope="module")
def copies():
    """Exact and near copies in a large group, a chain of edits, and documents sharing one passage."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = []
    base, passage, chain = text(120), text(40), text(100)
    for i in range(150):
        words = list(base)
        for _ in range(i % 7):
            words[rng.randrange(len(words))] = "edit" + str(rng.randrange(50))
        rows.append(" ".join(words))
    for i in range(60):
        rows.append(" ".join(text(20 + i) + passage + text(15)))
    for i in range(25):
        rows.append(" ".join(chain))
        chain = list(chain)
        chain[4 * i] = f"changed{i}"
    rows += ["a b c", "A b  c", "a b c d", "b c d e f g h", "b c d e f g h i", ""]
    ids = list(range(1000, 1000 + len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (1, 50)])
def test_components_equal_those_of_all_pairs(documents, copies, n, percent):
    assert found(ngram_join.ngram_join(documents(copies), n, percent)) == brute(copies, n, percent)


def test_odd_rows(documents, odd_texts):
    assert found(ngram_join.ngram_join(documents(odd_texts), 4, 85)) == brute(odd_texts, 4, 85)


def test_frequent_ngrams_change_no_result(documents, copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", 2)
    assert found(ngram_join.ngram_join(documents(copies), 4, 85)) == brute(copies, 4, 85)
    monkeypatch.setattr(ngram_join, "MOST_FREQUENT", 0)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 1000)
    assert found(ngram_join.ngram_join(documents(copies), 4, 85)) == brute(copies, 4, 85)


def test_empty_table(documents):
    empty = documents([(1, "a")]).where("false")
    assert ngram_join.ngram_join(empty).count() == 0
    assert ngram_join.one_of_each_group(empty).count() == 0


def test_large_group_of_near_copies_makes_few_pairs(documents, copies, monkeypatch):
    counts = []
    kept = ngram_join.stored

    def counting(df, purpose):
        out = kept(df, purpose)
        if purpose == "ngram-pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counting)
    near = copies[:150]
    ngram_join.ngram_join(documents(near), 4, 85).count()
    assert sum(counts) < 3 * len(near)  # all pairs would be more than 11,000


def test_one_of_each_group_stays(documents, copies, odd_texts):
    rows = copies + odd_texts
    kept = ngram_join.one_of_each_group(documents(rows), 5, 80)
    assert kept.columns == documents(rows).columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    wanted = {c if d is not None else None for d, n, c in brute(rows, 5, 80)}
    assert set(ids) == wanted
    assert ids[6] == 1 or ids[6] == 2  # its two texts do not link; the repeated row goes
    assert all(n == 1 for d, n in ids.items() if d not in (6, None))


def test_connected_components(session):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (101, 100), (500, 400)]
    got = {r["node"]: r["component"] for r in connected_components(session.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}, 500: 400, 400: 400}
    assert connected_components(session.createDataFrame([], "a long, b long")).count() == 0


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for size in (3, 40, 400, 4000):
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        b = np.concatenate([a[size // 10 :], rng.integers(0, 1 << 63, size // 20, dtype=np.uint64)])
        x, y = (ngram_join._sketch(np.unique(s)).view(np.uint64) for s in (a, b))
        differing = sum(int(w).bit_count() for w in x ^ y)
        assert differing <= len(np.setxor1d(a, b))


def test_columns_with_names_of_helpers_stay(documents):
    text = " ".join(f"w{k}" for k in range(50))
    pairs = [(1, text), (2, text), (3, text + " more"), (4, "something else than that, of seven words")]
    docs = documents(pairs).selectExpr("*", "concat('mine', doc_id) as _key", "doc_id as __key")
    got = ngram_join.one_of_each_group(docs).collect()
    assert sorted((r["doc_id"], r["_key"], r["__key"]) for r in got) == [(1, "mine1", 1), (4, "mine4", 4)]
