"""Declared commutes against the distance rule of their mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from perkline.functions.texts import commute_reason
from perkline.operators.rules import look_up

UPDATED_COLUMNS = ("distance_km", "threshold_km", "is_sport_commute", "is_valid", "validation_reason")


def candidates(employees: DataFrame, rules: DataFrame) -> DataFrame:
    """Employees whose declared mode has a rule, by id, with the travel mode to ask for."""
    return (
        look_up(employees.select("employee_id", "home_address", "commute_mode"), rules, "commute_mode")
        .select("employee_id", "home_address", "commute_mode", "travel_mode")
        .orderBy("employee_id")
    )


def _judged(requests: DataFrame, rules: DataFrame) -> DataFrame:
    # The limit is compared before the distance is rounded for storage.
    return look_up(requests, rules, "commute_mode").withColumn(
        "is_valid", F.col("distance_km") <= F.col("threshold_km")
    )


def validated(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """Validation rows for ``(employee_id, commute_mode, distance_km)``.

    Modes without a rule are not sport commutes and give no row. A NULL distance
    (no route was found) gives none either, rather than a false one.
    """
    return (
        _judged(requests, rules)
        .filter(F.col("distance_km").isNotNull())
        .select(
            "employee_id",
            F.col("distance_km").cast("decimal(10,2)").alias("distance_km"),
            "threshold_km",
            F.lit(True).alias("is_sport_commute"),
            "is_valid",
            commute_reason(F.col("is_valid"), F.col("threshold_km")).alias("validation_reason"),
        )
    )


def summary(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """``(checked, valid, anomalies, errors)`` in one pass; an error is a missing distance."""
    return _judged(requests, rules).agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("anomalies"),
        F.count_if(F.col("distance_km").isNull()).alias("errors"),
    )
