"""Agreement between two tables, and between measured and expected numbers."""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

METRIC = "decimal(20,2)"


def volumes(source: DataFrame, target: DataFrame) -> DataFrame:
    """``(source_rows, target_rows, difference, status)``: any difference is a WARNING."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    counted = sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
    ).withColumn("difference", F.col("source_rows") - F.col("target_rows"))
    return counted.withColumn(
        "status", F.when(F.col("difference") == 0, F.lit("OK")).otherwise(F.lit("WARNING"))
    )


def metric_rows(one_row: DataFrame) -> DataFrame:
    """One row of numbers to ``(metric_name, metric_value)`` rows."""
    names = one_row.columns
    return one_row.select([F.col(n).cast(METRIC).alias(n) for n in names]).unpivot(
        [], names, "metric_name", "metric_value"
    )


def expected_metrics(spark: SparkSession, expected: dict[str, object]) -> DataFrame:
    table = pa.table(
        {
            "metric_name": pa.array(list(expected), pa.string()),
            "metric_value": pa.array([str(Decimal(str(v))) for v in expected.values()], pa.string()),
        }
    )
    return spark.createDataFrame(table).withColumn("metric_value", F.col("metric_value").cast(METRIC))


def against_expected(actual: DataFrame, expected: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """``(metric_name, expected, actual, matches)``; an expected metric not measured fails.

    ``matches`` is true while the absolute difference stays below the tolerance.
    """
    wanted = expected.select("metric_name", F.col("metric_value").alias("expected"))
    found = actual.select("metric_name", F.col("metric_value").alias("actual"))
    close = F.abs(F.col("actual") - F.col("expected")) < F.lit(Decimal(tolerance))
    return wanted.join(found, "metric_name", "left").withColumn(
        "matches", F.coalesce(close, F.lit(False))
    )
