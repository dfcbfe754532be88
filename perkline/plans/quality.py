"""The quality suites of the activity tables and the contracts of all tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from perkline.functions.periods import in_future, outside, too_old
from perkline.operators.checks import (
    Check,
    all_checks,
    key_counts,
    key_measures,
    max_length,
    not_blank,
    required,
    tidy,
    violation_counts,
)
from perkline.operators.matching import row_counts, unknown_keys
from perkline.operators.profiling import counts_of_counts

END_BEFORE_START = "end_datetime < start_datetime"
END_NOT_AFTER_START = "end_datetime <= start_datetime"

NATURAL_KEY = ("employee_id", "start_datetime", "sport_type")

# --- Suite of the analytical table ------------------------------------------

ACTIVITY_CHECKS = (
    required("activity_id"),
    required("employee_id"),
    not_blank("sport_type", "invalid_sport"),
    required("start_datetime"),
    required("end_datetime"),
    Check("invalid_dates", END_BEFORE_START),
    Check("negative_distances", "distance_meters < 0"),
    Check("null_distances", "distance_meters IS NULL", blocking=False),
)


def activity_quality(activities: DataFrame) -> DataFrame:
    """Eight blocking counters and one for information: two scans, of which one
    shuffles nothing and the other only the key column."""
    return all_checks(
        key_counts(activities, ["activity_id"], "duplicates"),
        violation_counts(activities, ACTIVITY_CHECKS),
    )


def activity_stats(activities: DataFrame) -> DataFrame:
    """Totals, three distinct counts and the covered time in one row.

    The distinct counts of the two short columns are taken from (employee, sport)
    pairs, which one count reduces early, instead of multiplying every row.
    """
    pairs = activities.groupBy("employee_id", "sport_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("start_datetime").alias("first"),
        F.max("start_datetime").alias("last_start"),
        F.max("end_datetime").alias("last_end"),
    )
    facts = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.countDistinct("employee_id").alias("distinct_employees"),
        F.countDistinct("sport_type").alias("distinct_sports"),
        F.min("first").alias("first_activity"),
        F.max("last_start").alias("last_activity"),
        F.max("last_end").alias("last_end"),
    )
    ids = key_measures(activities, ["activity_id"]).select(
        F.col("distinct_non_null").alias("distinct_activity_ids")
    )
    # Both frames have one row; the maximum takes the side that has the value.
    both = facts.unionByName(ids, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


# --- Suite of the source table ----------------------------------------------


def source_quality(
    activities: DataFrame,
    employees: DataFrame,
    profile: DataFrame,
    as_of: dt.date | dt.datetime,
    min_activities: int = 15,
) -> DataFrame:
    """Eight blocking counters, and volume and threshold figures for information.

    Two passes over the activities: one groups by the natural key, one by employee and
    sport. The second carries all counts of rows and joins employees and profiles, so
    a busy employee joins as a few rows; its groups are then summed per employee and
    per sport at once.
    """
    start, end = F.col("start_datetime"), F.col("end_datetime")
    counters = {
        "total": F.count(F.lit(1)),
        "invalid_dates": F.count_if(F.expr(END_NOT_AFTER_START)),
        "future_activities": F.count_if(in_future(end, as_of)),
        "too_old_activities": F.count_if(too_old(start, as_of)),
        "negative_distances": F.count_if(F.col("distance_meters") < 0),
        "null_distances": F.count_if(F.col("distance_meters").isNull()),
    }
    pairs = activities.groupBy("employee_id", "sport_type").agg(
        *[c.alias(name) for name, c in counters.items()]
    )
    known = employees.select("employee_id", F.lit(True).alias("known"))
    declared = profile.select("employee_id", F.col("sport_type").alias("declared"))
    compared = pairs.join(known, "employee_id", "left").join(declared, "employee_id", "left")
    faults = {
        "unknown_employees": F.col("known").isNull(),
        "inconsistent_sports": F.col("sport_type") != F.col("declared"),
        "activities_without_profile": F.col("declared").isNull(),
    }
    sums = [F.sum(name).alias(name) for name in counters]
    sums += [F.sum(F.when(fault, F.col("total"))).alias(name) for name, fault in faults.items()]
    groups = compared.groupingSets([["employee_id"], ["sport_type"]], "employee_id", "sport_type").agg(
        *sums, F.grouping("sport_type").alias("of_employee")
    )
    of_employee, n = F.col("of_employee") == 1, F.col("total")
    counted = groups.agg(
        *[F.sum(F.when(of_employee, F.col(name))).alias(name) for name in [*counters, *faults]],
        F.count_if(of_employee & F.col("employee_id").isNotNull()).alias("employees_with_activity"),
        F.count_if(of_employee & (n < min_activities)).alias("below_threshold"),
        F.count_if(of_employee & (n >= min_activities)).alias("at_least_threshold"),
        F.count_if(~of_employee & F.col("sport_type").isNotNull()).alias("sports_count"),
    )
    informative = ["total", "null_distances", "employees_with_activity", "below_threshold"]
    return all_checks(
        tidy(counted, informative=[*informative, "at_least_threshold", "sports_count"]),
        key_counts(activities, list(NATURAL_KEY), "duplicates", "repeated_keys"),
    )


# --- Gates --------------------------------------------------------------------


def load_gate(activities: DataFrame, period_end: dt.date | dt.datetime) -> DataFrame:
    """What must be zero before a load may replace the history."""
    return tidy(
        activities.agg(
            F.count_if(F.expr(END_NOT_AFTER_START)).alias("invalid_dates"),
            F.count_if(F.col("distance_meters") < 0).alias("negative_distances"),
            F.count_if(in_future(F.col("end_datetime"), period_end)).alias("future_activities"),
        )
    )


def load_summary(activities: DataFrame) -> DataFrame:
    pairs = row_counts(activities, ["employee_id", "sport_type"], "n")
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_activities"),
        F.countDistinct("employee_id").alias("employees_with_activity"),
        F.countDistinct("sport_type").alias("sports_count"),
    )


def period_report(
    activities: DataFrame,
    start: dt.date | dt.datetime,
    end: dt.date | dt.datetime,
    min_activities: int = 15,
) -> DataFrame:
    """Figures of a batch of activities as ``(check_name, value, blocking)`` rows."""
    checks = tidy(
        activities.agg(
            F.count_if(F.expr(END_NOT_AFTER_START)).alias("invalid_dates"),
            F.count_if(F.col("distance_meters") < 0).alias("negative_distances"),
            F.count_if(outside(F.col("start_datetime"), start, end)).alias("outside_period"),
        )
    )
    return all_checks(
        checks,
        tidy(
            load_summary(activities),
            informative=["total_activities", "employees_with_activity", "sports_count"],
        ),
        tidy(
            counts_of_counts(activities, "employee_id", min_activities).select(
                F.col("min_rows").alias("min_per_employee"),
                F.col("max_rows").alias("max_per_employee"),
                # Counters are whole numbers: hundredths.
                (F.col("mean_rows") * 100).alias("mean_per_employee_x100"),
                "below_threshold",
                "at_least_threshold",
            ),
            informative=[
                "min_per_employee",
                "max_per_employee",
                "mean_per_employee_x100",
                "below_threshold",
                "at_least_threshold",
            ],
        ),
        row_counts(activities, ["sport_type"], "value").select(
            F.concat(F.lit("sport: "), F.coalesce("sport_type", F.lit("none"))).alias("check_name"),
            "value",
            F.lit(False).alias("blocking"),
        ),
    )


# --- Contracts: declared constraints as checks -----------------------------------


@dataclass(frozen=True)
class Contract:
    """What a table promises. A foreign key is ``column -> (table, column)``."""

    primary_key: str
    rules: tuple[Check, ...] = ()
    foreign_keys: Mapping[str, tuple[str, str]] | None = None


CONTRACTS: dict[str, Contract] = {
    "employees": Contract(
        "employee_id",
        (
            required("employee_id"),
            required("last_name"),
            required("first_name"),
            required("birth_date"),
            required("business_unit"),
            required("hire_date"),
            required("gross_salary"),
            required("contract_type"),
            required("paid_leave_days"),
            required("home_address"),
            required("commute_mode"),
            Check("salary_not_positive", "NOT gross_salary > 0"),
            Check("negative_leave_days", "paid_leave_days < 0"),
            max_length("last_name", 100),
            max_length("first_name", 100),
            max_length("business_unit", 100),
            max_length("contract_type", 20),
            max_length("commute_mode", 100),
        ),
    ),
    "sport_profile": Contract(
        "employee_id",
        (required("employee_id"), max_length("sport_type", 100)),
        {"employee_id": ("employees", "employee_id")},
    ),
    "activities": Contract(
        "activity_id",
        (
            required("activity_id"),
            required("employee_id"),
            required("start_datetime"),
            required("sport_type"),
            required("end_datetime"),
            Check("negative_distance", "distance_meters < 0"),
            Check("end_not_after_start", END_NOT_AFTER_START),
            max_length("sport_type", 100),
        ),
        {"employee_id": ("employees", "employee_id")},
    ),
    "commute_validation": Contract(
        "employee_id",
        (
            required("employee_id"),
            required("distance_km"),
            required("is_sport_commute"),
            required("is_valid"),
            Check("negative_distance", "distance_km < 0"),
            Check("negative_threshold", "threshold_km < 0"),
        ),
        {"employee_id": ("employees", "employee_id")},
    ),
    "data_quality_metrics": Contract(
        "quality_id",
        (
            required("quality_id"),
            required("metric_name"),
            required("metric_value"),
            required("checked_at"),
            max_length("metric_name", 100),
        ),
    ),
}


def contract_violations(
    name: str, tables: Mapping[str, DataFrame], contract: Contract | None = None
) -> DataFrame:
    """``(table_name, check_name, value)``: violations of every promise of one table.

    A NULL foreign key violates NOT NULL, not the reference.
    """
    contract = contract or CONTRACTS[name]
    df = tables[name]
    parts = [
        key_counts(
            df.filter(F.col(contract.primary_key).isNotNull()),
            [contract.primary_key],
            f"repeated_{contract.primary_key}",
        ),
        violation_counts(df, contract.rules),
    ]
    for column, (table, key) in (contract.foreign_keys or {}).items():
        parent = tables[table].select(F.col(key).alias(column))
        orphans = unknown_keys(df.filter(F.col(column).isNotNull()), parent, column)
        parts.append(tidy(orphans.agg(F.sum("row_count").alias(f"unknown_{column}"))))
    return all_checks(*parts).select(F.lit(name).alias("table_name"), "check_name", "value")
