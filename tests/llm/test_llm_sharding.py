from __future__ import annotations

import random
from collections import defaultdict

from perkline.llm.queries import QUERIES
from perkline.llm.sharding import shard_documents, splitters


def check(df, pairs, n):
    rows = df.collect()
    assert len(rows) == len(pairs)
    by_shard, texts = defaultdict(list), defaultdict(set)
    for r in rows:
        assert 0 <= r["shard"] < n
        assert r["size"] == len((r["text"] or "").encode()) + 1
        by_shard[r["shard"]].append(r)
        texts[r["text"] or ""].add(r["shard"])
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return {s: sum(r["size"] for r in own) for s, own in by_shard.items()}, texts


def test_equal_bytes_and_whole_groups(documents):
    rng = random.Random(3)
    pairs = [(i, "x" * int(rng.paretovariate(1.2) * 40 % 4000) + str(i)) for i in range(3000)]
    pairs += [(5000 + i, "copy " * 30) for i in range(200)]
    sizes, texts = check(shard_documents(documents(pairs), 16), pairs, 16)
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and all(abs(s - mean) < 0.02 * mean for s in sizes.values())
    assert all(len(shards) == 1 for shards in texts.values())


def test_a_group_of_a_third_of_all_rows_is_split(documents):
    pairs = [(i, f"text number {i} " + "abc " * 20) for i in range(1000)]
    pairs += [(2000 + i, "the very same text " * 5) for i in range(500)]
    sizes, texts = check(shard_documents(documents(pairs), 8), pairs, 8)
    mean = sum(sizes.values()) / 8
    assert all(abs(s - mean) < 0.05 * mean for s in sizes.values())
    assert sum(len(s) > 1 for s in texts.values()) == 1


def test_reruns_agree(documents):
    pairs = [(i, f"text {i % 70} ") for i in range(500)]
    first, second = (
        {(r["doc_id"], r["shard"], r["slot"]) for r in shard_documents(documents(pairs)).collect()} for _ in range(2)
    )
    assert first == second


def test_odd_rows(documents, odd_texts):
    check(shard_documents(documents(odd_texts), 4), odd_texts, 4)
    assert shard_documents(documents(odd_texts).where("false")).count() == 0
    out = shard_documents(documents([(1, None)]))
    assert [(r["size"], r["slot"]) for r in out.collect()] == [(1, 0)]
    assert out.columns.count("size") == out.columns.count("shard") == 1


def test_splitters_come_as_near_as_the_keys_allow(session):
    rng = random.Random(1)
    keys = [(rng.randrange(1 << 40), rng.randrange(1, 50)) for _ in range(2000)] + [(77, 3000)]
    df = session.createDataFrame(keys, "k long, w long")
    total = sum(w for _, w in keys)
    targets = [total * q for q in (0.01, 0.25, 0.5, 0.99)]
    bounds = splitters(df, "k", "w", targets, 0.0, 40)
    for bound, target in zip(bounds, targets):
        below = sum(w for k, w in keys if k < bound)
        best = min(abs(sum(w for k, w in keys if k < b) - target) for b, _ in keys + [(1 << 40, 0)])
        assert abs(below - target) <= best + 50


def test_plan_has_no_python(documents):
    plan = shard_documents(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def test_the_query_shards_the_texts_themselves(session, documents, tmp_path):
    documents([(i, f"text {i}") for i in range(50)]).write.parquet(str(tmp_path / "documents.parquet"))
    plan = QUERIES["op2_sharding"](session, str(tmp_path))._jdf.queryExecution().optimizedPlan()

    def nodes(node):
        yield node
        for i in range(node.children().size()):
            yield from nodes(node.children().apply(i))

    sorted_rows = [n.output().mkString(",") for n in nodes(plan) if n.nodeName() == "Window"]
    assert any("doc_id#" in out and "text#" in out for out in sorted_rows)


def test_columns_with_names_of_helpers_stay(documents):
    names = ("_key", "_own", "_part", "_placed", "_fine", "_first", "_row", "_KEY1")
    pairs = [(i, f"text {i} " * (i % 30)) for i in range(300)] + [(1000 + i, "much " * 4000) for i in range(4)]
    docs = documents(pairs).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    got = shard_documents(docs, 4)
    assert got.columns == [c for c in docs.columns if c not in ("size", "shard", "slot")] + ["size", "shard", "slot"]
    check(got, pairs, 4)
    assert all(r[n] == f"{n}{r['doc_id']}" for r in got.collect() for n in names)
