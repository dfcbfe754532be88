"""Frequent values and numbers of different values from sketches, against exact counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import rows
from perkline.operators import distincts, frequent


def brute_top(values, k):
    counts = sorted(Counter(values).items(), key=lambda c: (-c[1], c[0] is not None, c[0] or ""))
    return [(i, v, n) for i, (v, n) in enumerate(counts[:k], 1)]


def top(df, column):
    found = df.filter(F.col("column_name") == column).orderBy("rank")
    return [(r["rank"], r["value"], r["row_count"]) for r in found.collect()]


@pytest.fixture(scope="module")
def skewed():
    pick = random.Random(3)
    long = "x" * 300
    out = []
    for i in range(6_000):
        hot = pick.choice(["a", "b", None, "", long + "1", long + "2"]) if i % 3 else f"once {i}"
        out.append((hot, f"u{i}", pick.randrange(9)))
    return out


@pytest.mark.parametrize("tracked", [50, 500, 10_000])
def test_top_values_are_exact(spark, skewed, tracked):
    df = spark.createDataFrame(skewed, "hot string, `own.id` string, few int").repartition(5)
    found = frequent.top_values(df, ["hot", "own.id", "few"], k=6, tracked=tracked).cache()
    assert top(found, "hot") == brute_top([r[0] for r in skewed], 6)
    assert top(found, "own.id") == brute_top([r[1] for r in skewed], 6)  # all tied: counted whole
    assert top(found, "few") == brute_top([str(r[2]) for r in skewed], 6)


def test_rare_values_are_not_shuffled(spark, skewed, monkeypatch):
    df = spark.createDataFrame(skewed, "hot string, own string, few int")
    whole = []
    monkeypatch.setattr(frequent, "row_counts", lambda d, keys: whole.append(keys))
    assert len(top(frequent.top_values(df, ["hot", "few"], k=6, tracked=500), "hot")) == 6
    assert not whole


def test_top_values_of_few_or_no_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "s string")
    assert top(frequent.top_values(df, ["s"]), "s") == [(1, "a", 2), (2, None, 1)]
    assert frequent.top_values(df.limit(0), ["s"]).count() == 0


def within(estimate, exact):
    return abs(estimate - exact) <= distincts.ERROR * exact


def test_distinct_history_is_within_its_error(spark, folder):
    df = spark.range(200_000).select(
        (F.col("id") % 5).alias("load"), (F.col("id") * 7 % 60_000).alias("key"), (F.col("id") % 11).cast("double").alias("few")
    )
    for n in range(5):  # every load is sketched when it arrives, one of them in two parts
        load = df.filter(F.col("load") == n)
        parts = [load.filter("key < 30000"), load.filter("key >= 30000")] if n == 3 else [load]
        for part in parts:
            distincts.distinct_sketches(part, ["key", "few"], F.lit(n)).write.mode("append").parquet(f"{folder}/s")
    got = distincts.distinct_history(spark.read.parquet(f"{folder}/s"))
    want = distincts.exact_distinct_history(df, ["key", "few"], F.col("load"))
    verdicts = distincts.judged(got, want)
    assert verdicts.filter("within_error").count() == verdicts.count() == 10
    assert distincts.judged(got.filter("load > 0"), want.withColumn("distinct_so_far", F.col("distinct_so_far") + 9000)).filter("within_error").count() == 0
    got, want = ({(r["load"], r["column_name"]): r for r in d.collect()} for d in (got, want))
    assert got.keys() == want.keys() and len(got) == 10
    for key, exact in want.items():
        for name in ("value_rows", "value_rows_so_far"):
            assert got[key][name] == exact[name]
        for name in ("distinct_values", "distinct_so_far"):
            assert within(got[key][name], exact[name])
    assert want[4, "key"]["distinct_so_far"] == 60_000
    assert {got[n, "few"]["distinct_values"] for n in range(5)} == {11}


def test_distinct_history_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, "a")], "load int, s string")
    for found in (
        distincts.distinct_history(distincts.distinct_sketches(df, ["s"], F.col("load"))),
        distincts.exact_distinct_history(df, ["s"], F.col("load")),
    ):
        assert [tuple(r) for r in found.orderBy(F.asc_nulls_first("load")).collect()] == [
            (None, "s", 1, 1, 1, 1), (1, "s", 0, 0, 1, 1), (2, "s", 1, 1, 2, 1),
        ]
    assert rows(distincts.distinct_history(distincts.distinct_sketches(df.limit(0), ["s"], F.col("load")))) == []
