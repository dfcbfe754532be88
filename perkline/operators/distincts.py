"""Numbers of different values that add up over loads, so that no load is read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType

#: Logarithm of the number of buckets of a sketch, which takes 2 ** LOG_BUCKETS bytes at most.
LOG_BUCKETS = 14

#: Stated relative error: three standard errors, each 1.04 / sqrt(buckets).
ERROR = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)


def distinct_sketches(df: DataFrame, columns: Sequence[str], load: Column) -> DataFrame:
    """``(load, column_name, value_rows, sketch)``: one row per load and column, from one scan.

    ``load`` names the load of a row: a literal for a delivery, an expression for a table that holds many. NULL values
    are not counted. Append the result to a table; sketches of parts of a load may be stored apart.
    """
    plain = (StringType, BinaryType, IntegerType, LongType)
    cells = [
        F.col(f"`{c}`") if isinstance(df.schema[c].dataType, plain) else F.col(f"`{c}`").cast("string") for c in columns
    ]
    per_load = df.groupBy(load.alias("load")).agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cells)],
        *[F.hll_sketch_agg(c, LOG_BUCKETS).alias(f"s{i}") for i, c in enumerate(cells)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("value_rows"), F.col(f"s{i}").alias("sketch"))
            for i, c in enumerate(columns)
        ]
    )
    return per_load.select("load", F.inline(entries))


def united(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, value_rows, sketch)``: the sketches of each key as one."""
    return sketches.groupBy(*keys).agg(
        F.sum("value_rows").alias("value_rows"), F.hll_union_agg("sketch").alias("sketch")
    )


def distinct_history(sketches: DataFrame) -> DataFrame:
    """``(load, column_name, value_rows, distinct_values, value_rows_so_far, distinct_so_far)`` per load, in order of ``load``.

    The numbers of different values are estimates within ``ERROR``; small ones are exact. Only sketches are read:
    a load adds one row per column, whatever its size.
    """
    so_far = Window.partitionBy("column_name").orderBy(F.asc_nulls_first("load")).rowsBetween(Window.unboundedPreceding, 0)
    per_load = united(sketches, ["load", "column_name"])
    return per_load.select(
        "load",
        "column_name",
        "value_rows",
        F.hll_sketch_estimate("sketch").alias("distinct_values"),
        F.sum("value_rows").over(so_far).alias("value_rows_so_far"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch").over(so_far)).alias("distinct_so_far"),
    )


def exact_distinct_history(df: DataFrame, columns: Sequence[str], load: Column) -> DataFrame:
    """The same columns as :func:`distinct_history`, exact: reads all loads and shuffles one row per load and value."""
    so_far = Window.partitionBy("column_name").orderBy(F.asc_nulls_first("load")).rowsBetween(Window.unboundedPreceding, 0)
    values = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    cells = df.select(load.alias("load"), F.inline(F.array(*values)))
    per_value = cells.groupBy("load", "column_name", "value").agg(F.count("value").alias("n"))
    # A value counts as new in its first load; NULL loads come first.
    first = F.row_number().over(Window.partitionBy("column_name", "value").orderBy(F.asc_nulls_first("load"))) == 1
    real = F.col("value").isNotNull()
    per_load = per_value.withColumn("new", first & real).groupBy("load", "column_name").agg(
        F.sum("n").alias("value_rows"), F.count_if(real).alias("distinct_values"), F.count_if("new").alias("new_values")
    )
    return per_load.select(
        "load",
        "column_name",
        "value_rows",
        "distinct_values",
        F.sum("value_rows").over(so_far).alias("value_rows_so_far"),
        F.sum("new_values").over(so_far).alias("distinct_so_far"),
    )


def judged(history: DataFrame, exact: DataFrame) -> DataFrame:
    """``exact`` with ``estimated_values``, ``estimated_so_far`` and ``within_error``: rows agree, estimates are within ``ERROR``.

    A load that only one side has is not within it.
    """
    key = ["load", "column_name"]
    both = exact.alias("e").join(
        history.alias("h"), (F.col("e.load").eqNullSafe(F.col("h.load"))) & (F.col("e.column_name") == F.col("h.column_name")), "full"
    )
    right = [F.col(f"e.{n}") == F.col(f"h.{n}") for n in ("value_rows", "value_rows_so_far")]
    near = [F.abs(F.col(f"e.{n}") - F.col(f"h.{n}")) <= F.col(f"e.{n}") * ERROR for n in ("distinct_values", "distinct_so_far")]
    agrees = right[0] & right[1] & near[0] & near[1]
    return both.select(
        *[F.coalesce(f"e.{n}", f"h.{n}").alias(n) for n in key],
        *[f"e.{n}" for n in exact.columns if n not in key],
        F.col("h.distinct_values").alias("estimated_values"),
        F.col("h.distinct_so_far").alias("estimated_so_far"),
        F.coalesce(agrees, F.lit(False)).alias("within_error"),
    )
