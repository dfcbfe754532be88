"""Benefits kept up to date at the cost of what changed.

Next to the results stands a table of partial sums: one row per employee and day, with the number of activities
and the metres. Both are published tables laid out by employee, and their records say from which
versions of the inputs (and for which day) they were made. An update

* finds the rows that differ between the version used last and the newest one, reading only buckets that
  were rewritten,
* adds them up, with a sign, per employee and day, and adds that to the partial sums in the buckets
  of these employees,
* recomputes the results of employees with a difference in any input, or with an activity on one of the
  days that left or entered the window, from their partial sums, in their buckets.

Every step is published after the version it read. A run that dies in between, or is repeated, goes on
from what the records say, so no difference counts twice.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from perkline import fixed_values as fixed
from perkline.functions.periods import in_window, window_start
from perkline.operators.merging import copied, rewrite_published
from perkline.plans.benefits import benefits_of
from perkline.sources.tables import (
    Layout,
    Snapshot,
    changed_rows,
    publish,
    published_snapshot,
    require_published,
)

KEY = "employee_id"
BUCKETS = 64


def daily_sums(activities: DataFrame) -> DataFrame:
    """(employee_id, day, activity_count, total_distance_meters); with a ``_times`` column rows count so often."""
    times = F.col("_times") if "_times" in activities.columns else F.lit(1)
    counted = F.when(F.col("activity_id").isNotNull(), times).otherwise(0)
    return activities.groupBy(KEY, F.col("start_datetime").cast("date").alias("day")).agg(
        F.sum(counted).cast("long").alias("activity_count"),
        F.coalesce(F.sum(F.col("distance_meters") * times), F.lit(0)).cast("decimal(20,2)").alias("total_distance_meters"),
    )


def _added(days: DataFrame, difference: DataFrame) -> DataFrame:
    both = days.unionByName(difference.select(*days.columns))
    summed = both.groupBy(KEY, "day").agg(
        F.sum("activity_count").alias("activity_count"),
        F.sum("total_distance_meters").cast("decimal(20,2)").alias("total_distance_meters"),
    )
    return summed.filter("activity_count != 0 OR total_distance_meters != 0")


def update_days(spark: SparkSession, activities: str, days: str, buckets: int = BUCKETS) -> int:
    """Bring the partial sums up to the newest version of the activities; returns the version of the sums."""
    new = require_published(spark, activities)
    notes = {"activities": new.version}
    have = published_snapshot(spark, days)
    if have is None:
        return publish(daily_sums(new.read(spark)), days, after=0, layout=Layout((KEY,), buckets), notes=notes)
    if have.notes["activities"] == new.version:
        return have.version
    old = require_published(spark, activities, have.notes["activities"])
    difference = copied(daily_sums(changed_rows(spark, old, new)))
    return rewrite_published(spark, have, difference, [KEY], lambda rows: _added(rows, difference), notes=notes)


def _summary(days: DataFrame, as_of: dt.date) -> DataFrame:
    # A day is inside the window or outside as a whole: the window starts at midnight.
    recent = days.filter(in_window(F.col("day").cast("timestamp_ntz"), as_of))
    return recent.groupBy(KEY).agg(
        F.sum("activity_count").alias("activity_count"),
        F.sum("total_distance_meters").cast("decimal(20,2)").alias("total_distance_meters"),
    )


def _affected(
    spark: SparkSession, have: Snapshot, inputs: dict[str, Snapshot], days: Snapshot, as_of: dt.date
) -> DataFrame:
    """Employees whose row may differ from the stored one."""
    found = []
    for name, new in inputs.items():
        if have.notes[name] != new.version:
            old = require_published(spark, new.path, have.notes[name])
            found.append(changed_rows(spark, old, new).select(KEY))
    before = dt.date.fromisoformat(have.notes["as_of"])
    if before != as_of:
        first, last = sorted((before, as_of))
        moved = (F.col("day") >= window_start(first).cast("date")) & (F.col("day") < window_start(last).cast("date"))
        found.append(days.read(spark).filter(moved).select(KEY))
    nobody = days.read(spark, buckets=()).select(KEY)
    return reduce(DataFrame.unionByName, found, nobody).filter(F.col(KEY).isNotNull()).distinct()


def update_benefits(
    spark: SparkSession,
    employees: str,
    commute: str,
    activities: str,
    days: str,
    results: str,
    as_of: dt.date,
    rate: str = fixed.BONUS_RATE,
    min_activities: int = fixed.MIN_ACTIVITIES,
    buckets: int = BUCKETS,
) -> int:
    """Bring the results (paths of published tables) up to the newest inputs and ``as_of``; returns their version.

    The rows are those of :func:`~perkline.plans.benefits.employee_benefits` without the day, which is in the record: read
    them with :func:`read_benefits`. Other rules than those of the stored rows recompute all.
    """
    update_days(spark, activities, days, buckets)
    sums = require_published(spark, days)
    inputs = {
        "employees": require_published(spark, employees),
        "commute": require_published(spark, commute),
        "activities": require_published(spark, activities, sums.notes["activities"]),
    }
    rules = {"rate": rate, "min_activities": min_activities}
    notes = {name: s.version for name, s in inputs.items()} | rules | {"as_of": as_of.isoformat()}
    have = published_snapshot(spark, results)
    if have is not None and have.notes == notes:
        return have.version

    def computed(only: DataFrame | None) -> DataFrame:
        staff, checked, partial = inputs["employees"].read(spark), inputs["commute"].read(spark), sums.read(spark)
        if only is not None:
            staff, checked, partial = (t.join(only, KEY, "left_semi") for t in (staff, checked, partial))
        rows = benefits_of(staff, checked, _summary(partial, as_of), as_of, rate, min_activities)
        return rows.drop("calculation_date")

    if have is None or any(have.notes[name] != value for name, value in rules.items()):
        layout = Layout((KEY,), buckets)
        return publish(computed(None), results, after=0 if have is None else have.version, layout=layout, notes=notes)
    affected = copied(_affected(spark, have, inputs, sums, as_of))
    new = copied(computed(affected))

    def replaced(rows: DataFrame) -> DataFrame:
        return rows.join(affected, KEY, "left_anti").select(*rows.columns).unionByName(new)

    return rewrite_published(spark, have, affected, [KEY], replaced, notes=notes)


def read_benefits(spark: SparkSession, results: str) -> DataFrame:
    """The stored results in the columns of a full computation."""
    have = require_published(spark, results)
    day = dt.date.fromisoformat(have.notes["as_of"])
    return have.read(spark).withColumn("calculation_date", F.lit(day))
