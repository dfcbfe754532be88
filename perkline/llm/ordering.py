"""Numbering the rows of groups in order, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.storage import stored

_ROW_BITS = 33  # of monotonically_increasing_id: the rest is the partition


def numbered(rows: DataFrame, group: str, order: Sequence[str | Column]) -> DataFrame:
    """``rows`` plus ``position`` (from 0 in its group) and ``group_size``; ``group`` is not null.

    One range exchange sorts all rows by group and order, so a group with most of the rows is
    spread over many tasks; what is then added up are one count per task and group. Rows that
    are equal in all of ``order`` stand in any order, and may fill a task of their own unless
    ``order`` ends in something different for each row.
    """
    by = [group, *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, row = F.shiftright("_at", _ROW_BITS), F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    placed = placed.withColumns({"_part": part, "_row": row}).drop("_at")
    runs = placed.groupBy("_part", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_part",
        group,
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("group_size"),
    )
    return (
        placed.join(runs, ["_part", group])
        .withColumn("position", F.col("_row") + F.col("_shift"))
        .drop("_part", "_row", "_shift")
    )
