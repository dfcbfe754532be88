"""Small rule tables kept by the application and looked up per row."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from perkline.fixed_values import COMMUTE_RULES, KNOWN_SPORTS
from perkline.operators.matching import row_counts


def _rule_table(spark: SparkSession, columns: dict[str, list[str]]) -> DataFrame:
    """Written out in the application, so the planner knows its size and joins accordingly."""
    return spark.createDataFrame(
        pa.table({name: pa.array(values, pa.string()) for name, values in columns.items()})
    )


def commute_rules(
    spark: SparkSession, rules: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """``(commute_mode, travel_mode, threshold_km)``, one row per mode."""
    rules = COMMUTE_RULES if rules is None else rules
    columns = {
        "commute_mode": list(rules),
        "travel_mode": [mode for mode, _ in rules.values()],
        "threshold_km": [limit for _, limit in rules.values()],
    }
    return _rule_table(spark, columns).withColumn(
        "threshold_km", F.col("threshold_km").cast("decimal(10,2)")
    )


def known_sports(spark: SparkSession, sports: tuple[str, ...] = KNOWN_SPORTS) -> DataFrame:
    return _rule_table(spark, {"sport_type": list(sports)})


def look_up(df: DataFrame, rules: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to rules by key.

    Few keys with very many rows each are normal here. A rule table whose measured size
    allows it is sent to every task, so that ``df`` is not shuffled; with a larger one a
    hot key is split.
    """
    return df.join(rules, key, how)


def uncovered(df: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` without a rule, with their number of rows. NULL needs no rule."""
    present = row_counts(df.filter(F.col(key).isNotNull()), [key])
    return present.join(rules.select(key), key, "left_anti")
