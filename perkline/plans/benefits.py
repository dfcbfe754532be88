"""Benefits per employee: the commute bonus and the wellbeing days."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from perkline import fixed_values as fixed
from perkline.functions.periods import in_window
from perkline.schemas import BENEFIT_COLUMNS


def activity_summary(
    activities: DataFrame, as_of: dt.date | dt.datetime, bounded: bool = False
) -> DataFrame:
    """Activities and metres per employee inside the rolling window."""
    recent = activities.filter(in_window(F.col("start_datetime"), as_of, bounded=bounded))
    return recent.groupBy("employee_id").agg(
        F.count("activity_id").alias("activity_count"),
        F.sum("distance_meters").alias("total_distance_meters"),
    )


def bonus_amount(salary: Column, eligible: Column, rate: str = fixed.BONUS_RATE) -> Column:
    """Salary times rate in decimal arithmetic, half a cent up; 0.00 if not eligible."""
    amount = F.round(salary * F.lit(Decimal(rate)), 2)
    return F.when(eligible, amount).otherwise(F.lit(Decimal("0.00"))).cast("decimal(12,2)")


def wellbeing(
    counts: DataFrame,
    min_activities: int = fixed.MIN_ACTIVITIES,
    days: int = fixed.WELLBEING_DAYS,
) -> DataFrame:
    """Add the two wellbeing columns to rows with an ``activity_count``."""
    eligible = F.col("activity_count") >= min_activities
    return counts.withColumns(
        {
            "wellbeing_days_eligible": eligible,
            "wellbeing_days_awarded": F.when(eligible, F.lit(days)).otherwise(F.lit(0)),
        }
    )


def wellbeing_eligibility(
    activities: DataFrame,
    as_of: dt.date | dt.datetime,
    min_activities: int = fixed.MIN_ACTIVITIES,
    days: int = fixed.WELLBEING_DAYS,
) -> DataFrame:
    """Eligibility of employees who have an activity in the window that ends at ``as_of``."""
    counts = activity_summary(activities, as_of, bounded=True).drop("total_distance_meters")
    return wellbeing(counts, min_activities, days)


def wellbeing_summary(eligibility: DataFrame, days: int = fixed.WELLBEING_DAYS) -> DataFrame:
    """Counts on both sides of the threshold, and the days cross-checked against them."""
    eligible = F.count_if("wellbeing_days_eligible")
    awarded = F.coalesce(F.sum("wellbeing_days_awarded"), F.lit(0))
    return eligibility.agg(
        F.count(F.lit(1)).alias("employees_with_activity"),
        F.count_if(~F.col("wellbeing_days_eligible")).alias("not_eligible"),
        eligible.alias("eligible"),
        awarded.alias("days_awarded"),
        (eligible * days).alias("days_expected"),
        (awarded == eligible * days).alias("days_agree"),
    )


def employee_benefits(
    employees: DataFrame,
    commute: DataFrame,
    activities: DataFrame,
    as_of: dt.date | dt.datetime,
    rate: str = fixed.BONUS_RATE,
    min_activities: int = fixed.MIN_ACTIVITIES,
    days: int = fixed.WELLBEING_DAYS,
) -> DataFrame:
    """One row per employee with both benefits.

    ``employees`` and ``commute`` have one row per employee, and activities are
    reduced to one before they are joined, so no join sees a repeated key. All
    three inputs are keyed by employee: each is shuffled at most once, and the
    second join reuses the placement of the first. Employees without a commute
    or without activities stay, with FALSE and 0.
    """
    return benefits_of(employees, commute, activity_summary(activities, as_of), as_of, rate, min_activities, days)


def benefits_of(
    employees: DataFrame,
    commute: DataFrame,
    summary: DataFrame,
    as_of: dt.date | dt.datetime,
    rate: str = fixed.BONUS_RATE,
    min_activities: int = fixed.MIN_ACTIVITIES,
    days: int = fixed.WELLBEING_DAYS,
) -> DataFrame:
    """The same from activities that are already one row per employee."""
    checked = commute.select("employee_id", "distance_km", "is_sport_commute", "is_valid")
    joined = employees.join(checked, "employee_id", "left").join(summary, "employee_id", "left")
    facts = joined.select(
        "employee_id",
        "first_name",
        "last_name",
        "business_unit",
        "gross_salary",
        "commute_mode",
        F.col("distance_km").alias("commute_distance_km"),
        F.coalesce("is_sport_commute", F.lit(False)).alias("is_sport_commute"),
        F.coalesce("is_valid", F.lit(False)).alias("commute_validated"),
        F.coalesce("activity_count", F.lit(0)).cast("int").alias("activity_count"),
        F.coalesce("total_distance_meters", F.lit(Decimal("0.00"))).alias("total_distance_meters"),
    )
    eligible = F.col("is_sport_commute") & F.col("commute_validated")
    awarded = facts.withColumns(
        {
            "sport_bonus_eligible": eligible,
            "sport_bonus_amount": bonus_amount(F.col("gross_salary"), eligible, rate),
        }
    )
    day = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    return (
        wellbeing(awarded, min_activities, days)
        .withColumn("calculation_date", F.lit(day))
        .select(*BENEFIT_COLUMNS)
    )


def benefits_totals(benefits: DataFrame) -> DataFrame:
    """All control figures of a benefits table in one row.

    Rows are first reduced to one per employee, which answers the uniqueness
    question and carries the sums along, so the table is read once.
    """
    per_employee = benefits.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("sport_bonus_eligible").alias("bonus"),
        F.sum("sport_bonus_amount").alias("amount"),
        F.count_if("wellbeing_days_eligible").alias("wellbeing"),
        F.sum("wellbeing_days_awarded").alias("days"),
        F.count_if(F.col("activity_count") > 0).alias("active"),
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return per_employee.agg(
        total("n").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_employees"),
        (total("n") - F.count(F.lit(1))).alias("duplicates"),
        total("active").alias("employees_with_activity"),
        total("bonus").alias("bonus_eligible"),
        (total("n") - total("bonus")).alias("bonus_not_eligible"),
        F.round(F.coalesce(F.sum("amount"), F.lit(0)), 2).cast("decimal(20,2)").alias("bonus_total"),
        total("wellbeing").alias("wellbeing_eligible"),
        (total("n") - total("wellbeing")).alias("wellbeing_not_eligible"),
        total("days").alias("wellbeing_days"),
    )


def benefits_counters() -> dict[str, Column]:
    """The control figures that need no grouping, as aggregates that a write can take along."""

    def rows(condition: str) -> Column:
        return F.count_if(F.expr(condition))

    return {
        "row_count": F.count(F.lit(1)),
        "employees_with_activity": rows("activity_count > 0"),
        "bonus_eligible": rows("sport_bonus_eligible"),
        "bonus_not_eligible": rows("NOT sport_bonus_eligible"),
        "bonus_total": F.coalesce(F.sum("sport_bonus_amount"), F.lit(0)).cast("decimal(20,2)"),
        "wellbeing_eligible": rows("wellbeing_days_eligible"),
        "wellbeing_not_eligible": rows("NOT wellbeing_days_eligible"),
        "wellbeing_days": F.coalesce(F.sum("wellbeing_days_awarded"), F.lit(0)).cast("long"),
    }


def benefits_by_unit(benefits: DataFrame) -> DataFrame:
    """The dashboard's figures per business unit."""
    return benefits.groupBy("business_unit").agg(
        F.count(F.lit(1)).alias("employees"),
        F.count_if("sport_bonus_eligible").alias("bonus_eligible"),
        F.sum("sport_bonus_amount").cast("decimal(20,2)").alias("bonus_total"),
        F.count_if("wellbeing_days_eligible").alias("wellbeing_eligible"),
        F.sum("wellbeing_days_awarded").alias("wellbeing_days"),
        F.sum("activity_count").alias("activities"),
    )
