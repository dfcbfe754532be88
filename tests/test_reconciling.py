"""Differences of two tables by bucket digests, against a plain Python comparison."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from perkline.operators import reconciling
from perkline.operators.reconciling import bucket_digests, differing_buckets, key_differences

SCHEMA = "k int, j string, v double, _small_note string"


def brute(source, target, width=1):
    sides = []
    for rows in (source, target):
        by_key = defaultdict(Counter)
        for r in rows:
            by_key[r[:width]][r] += 1
        sides.append(by_key)
    out = []
    for key in {*sides[0], *sides[1]}:
        a, b = sides[0].get(key, Counter()), sides[1].get(key, Counter())
        if a != b:
            kind = "missing" if not b else "extra" if not a else "changed"
            out.append((*key, kind, sum(a.values()), sum(b.values())))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def sides():
    rng = random.Random(8)
    source = [(k, rng.choice("ab"), rng.choice([None, 1.5, -0.25]), None) for k in range(600)]
    target = [r for r in source if r[0] % 50]  # missing
    target = [(k, j, None if k % 70 == 3 else v, n) for k, j, v, n in target]  # changed, some from NULL to NULL
    target += [(1000 + i, "new", 1.0, "x") for i in range(5)] + [source[7], (None, "null key", 2.0, None)]
    source += [(None, "null key", 2.0, None), (None, None, None, None)]
    return source, target


@pytest.mark.parametrize(("large", "small"), [(256, 64), (4, 3), (1, 1)])
def test_keys_equal_brute_force(spark, sides, large, small):
    source, target = sides
    got = key_differences(spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA).repartition(3), ["k"], large=large, small=small)
    assert found(got) == brute(source, target)


def test_composite_keys_and_other_types(spark, sides):
    source, target = sides
    wide = spark.createDataFrame(target, SCHEMA.replace("k int", "k long"))
    got = key_differences(spark.createDataFrame(source, SCHEMA), wide, ["k", "j"])
    assert found(got) == brute(source, target, 2)


def test_equal_tables_compare_no_keys(spark, sides, monkeypatch):
    rows = spark.createDataFrame(sides[0], SCHEMA)
    assert found(key_differences(rows, rows.repartition(5), ["k"])) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert found(key_differences(empty, empty, ["k"])) == []
    assert len(found(key_differences(rows, empty, ["k"]))) == len({r[0] for r in sides[0]})


def test_only_buckets_that_differ_reach_the_keys(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    other = rows.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v")))
    a, b = (bucket_digests(r, ["k"]) for r in (rows, other))
    large = differing_buckets(a, b, ["_large"]).collect()
    small = differing_buckets(a, b, ["_large", "_small"]).collect()
    assert len(large) == len(small) == 1 and small[0]["source_rows"] < 10
    assert found(key_differences(rows, other, ["k"])) == [(77, "changed", 1, 1)]


def test_null_and_its_place_count(spark):
    one = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "k int, a string, b string")
    two = spark.createDataFrame([(1, "x", None), (2, "y", None)], "k int, a string, b string")
    assert found(key_differences(one, two, ["k"])) == [(1, "changed", 1, 1)]
    assert reconciling.LARGE * reconciling.SMALL == 16384
