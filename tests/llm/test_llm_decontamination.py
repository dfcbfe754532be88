from __future__ import annotations

import hashlib
import random
import re

import pytest

from perkline.llm import decontamination
from perkline.llm.decontamination import decontaminate, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, span=10):
    own, hit, names = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        n = min(len(w), span)
        if not n:
            continue
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                if item_id is not None:
                    names.add(str(item_id))
    return len(own), len(hit), sorted(names), bool(hit)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(2)
    vocabulary = [f"b{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(1, 40))) for i in range(25)]
    items += [(90, ""), (91, None), (92, "..."), (93, "aa " * 30), (94, "Only Three Words"), (None, text(20)), (95, items[0][1])]
    docs = []
    for i in range(120):
        parts = [text(rng.randrange(0, 30))]
        if i % 2:
            item = items[rng.randrange(25)][1].split()
            low = rng.randrange(len(item))
            parts.append(" ".join(item[low : low + rng.randrange(5, 25)]).upper())
        parts.append(text(rng.randrange(0, 30)))
        docs.append((i, ", ".join(parts)))
    docs += [(500, "aa " * 12), (501, "x aa aa aa"), (502, "only, THREE\nwords!"), (503, "aa " * 9)]
    return docs, items


def test_hits_equal_brute_force(session, documents, cases, odd_texts):
    docs, items = cases
    docs = docs + odd_texts
    benchmark = session.createDataFrame(items, "item_id long, text string")
    got = sorted(
        (repr(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"])
        for r in decontaminate(documents(docs), benchmark).collect()
    )
    assert got == sorted((repr(d), *brute(t, items)) for d, t in docs)


def test_same_without_broadcasts(session, documents, cases):
    docs, items = cases
    benchmark = session.createDataFrame(items, "item_id long, text string")
    before = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = decontaminate(documents(docs), benchmark).select("doc_id", "n_hit").collect()
    finally:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r[0]: r[1] for r in rows} == {d: brute(t, items)[1] for d, t in docs}


def test_every_shared_span_has_a_shared_fingerprint(session):
    rng = random.Random(9)
    for _ in range(3):
        shared = [f"s{rng.randrange(4)}" for _ in range(10)]
        a = [f"a{i}" for i in range(rng.randrange(20))] + shared + ["tail"] * 5
        b = ["head"] * 7 + shared + [f"c{i}" for i in range(rng.randrange(20))]
        df = session.createDataFrame([(0, a), (1, b)], "k int, words array<string>")
        prints = decontamination._fingerprints(df, 10, 5, []).where("at >= 0").collect()
        left, right = ({r["print"] for r in prints if r["k"] == k} for k in (0, 1))
        assert left & right


def test_filter_and_empty_tables(session, documents, cases):
    docs, items = cases
    benchmark = session.createDataFrame(items, "item_id long, text string")
    kept = without_contaminated(documents(docs), benchmark)
    assert kept.columns == documents(docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, t in docs if not brute(t, items)[3]}
    none = benchmark.where("false")
    assert without_contaminated(documents(docs), none).count() == len(docs)
    assert decontaminate(documents(docs).where("false"), benchmark).count() == 0
    judged = decontaminate(documents(docs[:5]), none).collect()
    assert all(r["n_hit"] == 0 and not r["contaminated"] and r["items"] == [] for r in judged)
    assert hashlib.sha256(b"").hexdigest()


def test_plan_has_no_python(session, documents, cases):
    benchmark = session.createDataFrame(cases[1], "item_id long, text string")
    plan = decontaminate(documents(cases[0]), benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def test_columns_with_names_of_helpers_stay(session, documents):
    words = " ".join(f"w{k}" for k in range(30))
    items = session.createDataFrame([(1, words)], "item_id long, text string")
    docs = documents([(1, words), (2, "clean text of a few words")]).selectExpr("*", "concat('mine', doc_id) as _key")
    got = decontamination.without_contaminated(docs, items).collect()
    assert [(r["doc_id"], r["_key"]) for r in got] == [(2, "mine2")]
