"""The most frequent values of columns with very many different ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkline.operators.matching import row_counts

#: Values a sketch keeps per column. What it may miss is stated by :func:`largest_missed`.
TRACKED = 10_000

#: A sketch holds texts up to this length themselves and longer ones as digests, so its size has a bound.
KEPT_LENGTH = 64


def largest_missed(rows: int, tracked: int = TRACKED) -> int:
    """The most rows that a value may have which a sketch of ``rows`` rows does not name.

    Such a sketch counts with an error of at most 3.5 / (tracked / 0.75) of its rows, and names every value that is
    above twice its error.
    """
    return int(rows * 2 * 3.5 * 0.75 / tracked)


def _item(value: Column) -> Column:
    """The value, or its digest, in at most ``KEPT_LENGTH`` + 1 characters; NULL is a value too."""
    digest = F.concat(F.lit("#"), F.sha2(value, 256))
    return F.when(value.isNull(), "-").when(F.length(value) > KEPT_LENGTH, digest).otherwise(F.concat(F.lit("="), value))


def _named(place: int) -> Column:
    return F.transform(f"s{place}", lambda s: F.struct(F.lit(place).alias("place"), s["item"].alias("item")))


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.desc("row_count"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("place", "rank", "value", "row_count")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 20, tracked: int = TRACKED) -> DataFrame:
    """``(column_name, rank, value, row_count)``: the ``k`` most frequent values of every column, with exact counts.

    Ties go to the smaller value, NULL first; values are text. A first scan keeps a frequency sketch per column, a second
    one counts only what the sketches name, so nothing of a column's many rare values is shuffled. A column whose k-th
    count is not above what its sketch may have missed is counted whole instead: the result is always exact. Both scans
    should see the same rows. ``k`` rows per column reach the driver.
    """
    spark, places = df.sparkSession, range(len(columns))
    values = df.select(*[F.col(f"`{c}`").cast("string").alias(f"v{i}") for i, c in enumerate(columns)])
    items = values.select(*[_item(F.col(f"v{i}")).alias(f"i{i}") for i in places])
    sketches = items.agg(*[F.expr(f"approx_top_k(i{i}, {tracked}, {tracked})").alias(f"s{i}") for i in places])
    named = sketches.select(F.inline(F.concat(*[_named(i) for i in places])))
    cells = values.select(
        F.inline(
            F.array(*[F.struct(F.lit(i).alias("place"), _item(F.col(f"v{i}")).alias("item"), F.col(f"v{i}").alias("value")) for i in places])
        )
    )
    # What is sent around: at most ``tracked`` short items per column, whatever the size of the table.
    hits = cells.join(F.broadcast(named.withColumn("hit", F.lit(True))), ["place", "item"], "left")
    # All rows that no sketch names are one group per column; it tells how many rows the counts leave out.
    counted = (
        hits.groupBy("place", F.when(F.col("hit"), F.col("item")).alias("item"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.first(F.when(F.col("hit"), F.col("value"))).alias("value"))
        .persist()
    )
    try:
        sizes = {
            r["place"]: (r["all_rows"], r["unnamed"])
            for r in counted.groupBy("place")
            .agg(F.sum("row_count").alias("all_rows"), F.sum(F.when(F.col("item").isNull(), F.col("row_count")).otherwise(0)).alias("unnamed"))
            .collect()
        }
        first = _ranked(counted.filter("item IS NOT NULL"), k).collect()
    finally:
        counted.unpersist()
    proven, exact = [], []
    for place, (all_rows, unnamed) in sizes.items():
        mine = [r for r in first if r["place"] == place]
        smallest = mine[-1]["row_count"] if len(mine) == k else 0
        if unnamed == 0 or smallest > largest_missed(all_rows, tracked):
            proven += mine
        else:
            whole = row_counts(values.select(F.col(f"v{place}").alias("value")), ["value"])
            exact.append(_ranked(whole.withColumn("place", F.lit(place)), k))
    found = spark.createDataFrame(proven, "place int, rank int, value string, row_count long")
    for part in exact:
        found = found.unionByName(part)
    name = F.element_at(F.array(*map(F.lit, columns)), F.col("place") + 1)
    return found.select(name.alias("column_name"), "rank", "value", "row_count")
