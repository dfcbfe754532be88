"""Descriptive numbers of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from perkline.operators.matching import row_counts


def column_profile(df: DataFrame) -> DataFrame:
    """``(column_name, row_count, null_count)`` for every column, from one scan."""
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in names],
    )
    return counts.unpivot(["row_count"], [f"`{n}`" for n in names], "column_name", "null_count").select(
        "column_name", "row_count", "null_count"
    )


def shape(df: DataFrame) -> DataFrame:
    """``(row_count, column_count)``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def rows_left(df: DataFrame, key: str) -> DataFrame:
    """``(rows_after, last_key)``."""
    return df.agg(F.count(F.lit(1)).alias("rows_after"), F.max(key).alias("last_key"))


def repeated_rows(
    df: DataFrame, columns: Sequence[str] | None = None, digest_text: bool = True
) -> DataFrame:
    """``(total, later_rows)``: rows equal to an earlier one in ``columns`` (default: all).

    Copies are counted inside the map tasks first. Text is compared by its SHA-256
    digest, so that long texts do not travel: 32 bytes per value do. Without
    ``digest_text`` the texts themselves are compared.
    """
    fields = [df.schema[c] for c in columns or df.columns]
    compared = [
        F.unhex(F.sha2(F.col(f"`{f.name}`"), 256)).alias(f.name)
        if digest_text and isinstance(f.dataType, StringType)
        else F.col(f"`{f.name}`")
        for f in fields
    ]
    groups = row_counts(df.select(*compared), [f"`{f.name}`" for f in fields], "n")
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("later_rows"),
    )


def repeated_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, n)`` of the keys on more than one row."""
    return row_counts(df, list(keys), "n").filter(F.col("n") > 1)


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """``(column, row_count)``, most frequent first; NULL is a value of its own."""
    return row_counts(df, [column]).orderBy(F.desc("row_count"), F.col(column))


def counts_by_month(df: DataFrame, column: str) -> DataFrame:
    """``(month, row_count)`` in time order; the key text is made once per month."""
    months = df.groupBy(F.date_trunc("month", column).alias("first_day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return months.select(
        F.date_format("first_day", "yyyy-MM").alias("month"), "row_count"
    ).orderBy("month")


def counts_of_counts(df: DataFrame, key: str, threshold: int) -> DataFrame:
    """Rows per key, summarised: how many keys, least, most, mean, below and from the threshold."""
    per_key = row_counts(df, [key], "n")
    n = F.col("n")
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.min(n).alias("min_rows"),
        F.max(n).alias("max_rows"),
        F.round(F.avg(n), 2).alias("mean_rows"),
        F.count_if(n < threshold).alias("below_threshold"),
        F.count_if(n >= threshold).alias("at_least_threshold"),
    )


def largest(df: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows, largest first. Every task keeps ``k`` rows; there is no full sort."""
    return df.orderBy(*[F.desc(c) for c in by]).limit(k)
