"""Joins that compare two tables by key.

A frequent key must not decide how long a join takes. Where only counts are
wanted, rows are therefore counted per key before the join (the first step of a
count runs inside the map tasks), so a key with a third of all rows reaches the
join as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def row_counts(df: DataFrame, keys: list[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def unknown_keys(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys in ``rows`` that ``known`` lacks, with their number of rows. NULL is unknown."""
    return row_counts(rows, [key]).join(known.select(key), key, "left_anti")


def without_value(rows: DataFrame, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Keys in ``rows`` with no entry in ``lookup``, or with an entry whose value is NULL."""
    return unknown_keys(rows, lookup.filter(F.col(value).isNotNull()), key)


def differing_value(rows: DataFrame, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) pairs in ``rows`` whose value is not the one in ``lookup``.

    NULL on either side is no difference. ``lookup`` has one row per key.
    """
    declared = lookup.select(key, F.col(value).alias("declared"))
    return (
        row_counts(rows, [key, value])
        .join(declared, key)
        .filter(F.col(value) != F.col("declared"))
    )


def key_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: ``(key, missing_from)`` with ``left`` or ``right``.

    Both directions come from one shuffle of already reduced keys.
    """
    sides = left.select(key, F.lit(True).alias("in_left")).unionByName(
        right.select(key, F.lit(False).alias("in_left"))
    )
    seen = sides.groupBy(key).agg(
        F.bool_or("in_left").alias("left_has"), F.bool_or(~F.col("in_left")).alias("right_has")
    )
    return seen.filter(F.col("left_has") != F.col("right_has")).select(
        key, F.when(F.col("left_has"), F.lit("right")).otherwise(F.lit("left")).alias("missing_from")
    )
