"""Benefits kept up to date against the full computation, after every kind of change."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from perkline.operators.merging import delete_published, merge_published
from perkline.plans import incremental
from perkline.plans.benefits import employee_benefits
from perkline.sources import tables

STAFF = "employee_id int, first_name string, last_name string, business_unit string, gross_salary decimal(10,2), commute_mode string"
COMMUTE = "employee_id int, distance_km decimal(10,2), is_sport_commute boolean, is_valid boolean"
ACTIVITIES = "activity_id int, employee_id int, start_datetime timestamp_ntz, distance_meters decimal(10,2)"
DAY = dt.date(2025, 1, 24)


class World:
    def __init__(self, spark, folder, buckets=8):
        self.spark, self.at = spark, {n: f"{folder}/{n}" for n in ("employees", "commute", "activities", "days", "results")}
        rng = random.Random(1)
        staff = [(e, f"f{e}", f"l{e}", "u", Decimal(2000 + e), "w") for e in range(40)]
        checked = [(e, Decimal(5), True, e % 3 == 0) for e in range(0, 40, 2)]
        acts = [self.activity(rng, i) for i in range(900)]
        for name, data, schema, key in (("employees", staff, STAFF, "employee_id"), ("commute", checked, COMMUTE, "employee_id"), ("activities", acts, ACTIVITIES, "activity_id")):
            tables.publish(spark.createDataFrame(data, schema), self.at[name], layout=tables.Layout((key,), buckets))

    @staticmethod
    def activity(rng, i, employee=None):
        start = dt.datetime(2024, 1, 10) + dt.timedelta(minutes=rng.randrange(0, 600_000))
        distance = None if i % 7 == 0 else Decimal(rng.randrange(0, 10**6)) / 100
        return (i, rng.randrange(42) if employee is None else employee, start, distance)

    def update(self, day=DAY):
        before = tables.published_snapshot(self.spark, self.at["results"])
        incremental.update_benefits(self.spark, *[self.at[n] for n in ("employees", "commute", "activities", "days", "results")], day, buckets=16)
        read = lambda name: tables.read_published(self.spark, self.at[name])
        full = employee_benefits(read("employees"), read("commute"), read("activities"), day)
        found = incremental.read_benefits(self.spark, self.at["results"])
        assert found.dtypes == full.dtypes
        assert rows(found) == rows(full)
        now = tables.published_snapshot(self.spark, self.at["results"])
        return 16 if before is None else sum(before.buckets.get(b) != now.buckets.get(b) for b in range(16))

    def merge(self, name, data, schema, key):
        merge_published(self.spark, self.at[name], self.spark.createDataFrame(data, schema), [key])


@pytest.fixture
def world(spark, folder):
    made = World(spark, folder)
    assert made.update() == 16
    return made


def test_inserted_changed_and_deleted_activities(world, spark):
    rng = random.Random(2)
    # One activity changes its employee and another its distance; one is new.
    world.merge("activities", [world.activity(rng, 3, 5), world.activity(rng, 1000, 6)], ACTIVITIES, "activity_id")
    assert 1 <= world.update() <= 3
    delete_published(spark, world.at["activities"], spark.createDataFrame([(7,), (8,)], "activity_id int"), ["activity_id"])
    assert 1 <= world.update() <= 2
    assert world.update() == 0


def test_changed_people_and_commutes(world, spark):
    world.merge("employees", [(3, "new", "name", "v", Decimal(9000), "w"), (99, "x", "y", "z", Decimal(1), "w")], STAFF, "employee_id")
    world.merge("commute", [(5, Decimal(1), True, True)], COMMUTE, "employee_id")
    assert 1 <= world.update() <= 3
    delete_published(spark, world.at["employees"], spark.createDataFrame([(4,)], "employee_id int"), ["employee_id"])
    assert world.update() == 1


@pytest.mark.parametrize("day", [dt.date(2025, 1, 25), dt.date(2025, 3, 1), dt.date(2024, 12, 1), dt.date(2027, 1, 1)])
def test_a_moved_window(world, day):
    world.update(day)
    world.update()


def test_several_versions_at_once_and_a_run_that_died(world, spark):
    rng = random.Random(4)
    world.merge("activities", [world.activity(rng, 2000 + i) for i in range(5)], ACTIVITIES, "activity_id")
    world.merge("activities", [world.activity(rng, 2000)], ACTIVITIES, "activity_id")
    # The sums were published, the results not: the next run counts nothing twice.
    incremental.update_days(spark, world.at["activities"], world.at["days"])
    world.update()
    # A whole replacement has no buckets in common; still only what differs counts.
    same = tables.read_published(spark, world.at["activities"]).withColumn("distance_meters", F.when(F.col("activity_id") == 11, 1).otherwise(F.col("distance_meters")).cast("decimal(10,2)"))
    tables.publish(same, world.at["activities"])
    assert world.update() == 1


def test_other_rules_recompute_all(world):
    incremental.update_benefits(world.spark, *[world.at[n] for n in ("employees", "commute", "activities", "days", "results")], DAY, rate="0.10")
    assert tables.published_snapshot(world.spark, world.at["results"]).notes["rate"] == "0.10"
    world.update()


def test_changed_rows_of_repeated_rows(spark, folder):
    path = f"{folder}/t"
    tables.publish(spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int"), path)
    tables.publish(spark.createDataFrame([(1,), (None,), (None,), (2,)], "k int"), path)
    old, new = (tables.published_snapshot(spark, path, v) for v in (1, 2))
    found = sorted(tuple(r) for r in tables.changed_rows(spark, old, new).fillna(-1, ["k"]).collect())
    assert found == [(-1, 1), (1, -1)]
    assert tables.changed_rows(spark, new, new).count() == 0
