"""Volumes, quality counters, their history and the overall state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from perkline.operators.checks import Check, all_checks, key_counts, violation_counts
from perkline.plans.quality import END_BEFORE_START

OK, WARNING, ERROR = "OK", "WARNING", "ERROR"

ACTIVITY_METRICS = (
    Check("null_activity_id", "activity_id IS NULL"),
    Check("null_employee_id_activities", "employee_id IS NULL"),
    Check("inconsistent_dates", END_BEFORE_START),
    Check("negative_distances", "distance_meters < 0"),
)
BENEFIT_METRICS = (Check("null_benefit_employee_id", "employee_id IS NULL"),)


def quality_metrics(activities: DataFrame, benefits: DataFrame) -> DataFrame:
    """The seven monitored counters; a NULL key counts as one key here."""
    return all_checks(
        key_counts(activities, ["activity_id"], "duplicate_activity_id", "later_rows"),
        violation_counts(activities, ACTIVITY_METRICS),
        key_counts(benefits, ["employee_id"], "duplicate_benefit_employee_id", "later_rows"),
        violation_counts(benefits, BENEFIT_METRICS),
    )


def metric_history(checks: DataFrame, checked_at: dt.datetime) -> DataFrame:
    """Counters as rows of the append-only history."""
    return checks.select(
        F.col("check_name").alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.lit(checked_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("checked_at"),
    )


def overall_status(volume: DataFrame, checks: DataFrame) -> DataFrame:
    """``(volume_status, quality_status, overall)``: a blocking count is an ERROR, else a
    difference in volume a WARNING, else OK."""
    signals = volume.select(
        (F.col("status") != OK).alias("volume_off"), F.lit(False).alias("broken")
    ).unionByName(
        checks.select(
            F.lit(False).alias("volume_off"), (F.col("blocking") & (F.col("value") > 0)).alias("broken")
        )
    )
    state = signals.agg(F.bool_or("volume_off").alias("off"), F.bool_or("broken").alias("broken"))
    return state.select(
        F.when(F.col("off"), WARNING).otherwise(OK).alias("volume_status"),
        F.when(F.col("broken"), ERROR).otherwise(OK).alias("quality_status"),
        F.when(F.col("broken"), ERROR).when(F.col("off"), WARNING).otherwise(OK).alias("overall"),
    )


def component_counts(readers: dict[str, Callable[[], DataFrame]]) -> dict[str, int | None]:
    """Rows per component; None where it cannot be read. One count job per component,
    so that one broken component does not hide the others."""
    found: dict[str, int | None] = {}
    for name, reader in readers.items():
        try:
            found[name] = reader().count()
        except (PySparkException, FileNotFoundError):
            found[name] = None
    return found


def component_status(
    counts: dict[str, int | None],
    source: str,
    target: str,
    quality_failed: bool,
) -> dict[str, str]:
    """States by name, plus ``volume``, ``quality`` and ``overall``."""
    states = {name: ERROR if rows is None else OK for name, rows in counts.items()}
    if counts[source] is None or counts[target] is None:
        volume = ERROR
    else:
        volume = OK if counts[source] == counts[target] else WARNING
    quality = ERROR if quality_failed else OK
    if ERROR in states.values() or quality == ERROR:
        overall = ERROR
    else:
        overall = WARNING if volume == WARNING else OK
    return {**states, "volume": volume, "quality": quality, "overall": overall}
