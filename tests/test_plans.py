"""Shapes of plans that matter once tables are large, and results under a hot key."""

import datetime as dt
from contextlib import contextmanager
from decimal import Decimal

import pytest

from helpers import values
from perkline import schemas
from perkline.operators.checks import key_measures
from perkline.operators.merging import merged
from perkline.operators.profiling import repeated_rows
from perkline.operators.rules import commute_rules, look_up
from perkline.plans import benefits, quality
from perkline.streaming import changes
from perkline.streaming.notifications import notifications
import __spark_entry__  # noqa: F401  (registers the queries)
from workload import roles
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@pytest.fixture
def large(spark):
    """As if no table were small enough to be sent around."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


@pytest.mark.parametrize("size", ["0.001", "0.01", "0.1"])
def test_declared_columns_are_those_of_the_files(spark, size):
    for name in roles.SCHEMAS:
        path = f"/root/testdata/sf{size}"
        found = spark.read.parquet(f"{path}/{name}.parquet").schema
        assert roles.table(spark, path, name).schema == found


def test_window_reaches_the_scan(spark):
    plan = plan_of(benefits.wellbeing_eligibility(roles.activities(spark, SF_DIR), roles.AS_OF))
    (scan,) = scans(plan)
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in scan
    assert "LessThanOrEqual(ts,2025-01-24T00:00)" in scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in scan


def test_benefits_shuffle_each_input_once_by_employee(spark, large):
    frame = spark.createDataFrame
    staff, checked = frame([], schemas.EMPLOYEES), frame([], schemas.COMMUTE_VALIDATION)
    done = frame([], schemas.ACTIVITIES)
    plan = plan_of(benefits.benefits_totals(benefits.employee_benefits(staff, checked, done, roles.AS_OF)))
    assert plan.count("Exchange hashpartitioning(employee_id") == 3
    assert plan.count("Exchange") == 4  # and the last step to one row


def test_rules_are_sent_around_because_they_are_small(spark):
    answers = roles.commute_answers(spark, SF_DIR)
    plan = plan_of(look_up(answers, commute_rules(spark, roles.RULES), "commute_mode"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_rules_too_large_to_send_are_joined_by_key(spark, large):
    plan = plan_of(look_up(roles.commute_answers(spark, SF_DIR), commute_rules(spark, roles.RULES), "commute_mode"))
    assert "SortMergeJoin" in plan


def test_source_suite_passes_over_the_activities_twice(spark):
    plan = plan_of(QUERIES["source_quality"].build(spark, SF_DIR))
    # What stands for the activities reads the events twice, the profiles once.
    events = [line for line in scans(plan) if "events.parquet" in line]
    activities = [line for line in events if "ts:timestamp_ntz" in line]
    assert len(activities) <= 4


def test_audits_move_no_texts(spark):
    documents = roles.table(spark, SF_DIR, "documents")
    for plan in (plan_of(QUERIES["file_audit"].build(spark, SF_DIR)), plan_of(repeated_rows(documents))):
        # Both text columns and all others of the documents are replaced before any exchange.
        lines = [line for line in plan.splitlines() if "unhex(sha2(cast(text#" in line]
        assert lines and all("Project" in line or "HashAggregate" in line for line in lines)
    assert "sha2" not in plan_of(repeated_rows(documents, digest_text=False))


def test_row_checks_take_one_scan_and_no_key_shuffle(spark):
    plan = plan_of(quality.violation_counts(roles.activities(spark, SF_DIR), quality.ACTIVITY_CHECKS))
    assert len(scans(plan)) == 1 and "hashpartitioning" not in plan


def test_key_checks_read_the_key_column_only(spark):
    plan = plan_of(key_measures(roles.table(spark, SF_DIR, "lineitem"), ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_rows_are_counted_before_they_are_joined(spark, large):
    plan = plan_of(QUERIES["unknown_employees"].build(spark, SF_DIR)).splitlines()
    order = [i for i, line in enumerate(plan) if "partial_count" in line]
    exchange = [i for i, line in enumerate(plan) if "hashpartitioning(employee_id" in line]
    join = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line and "LeftAnti" in line)
    assert join < exchange[0] < order[0]  # read from the join down: exchange, then the first count


def test_messages_are_parsed_once(spark, folder):
    path = f"{folder}/topic"
    roles.messages(spark, "/root/testdata/sf0.001").write.parquet(path)
    plan = plan_of(changes.created_activities(spark.read.parquet(path)))
    assert plan.count("from_json") == 1


def test_small_upsert_does_not_move_the_table(spark):
    target = roles.table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_tax")
    few = roles.table(spark, SF_DIR, "nation").selectExpr("CAST(n_nationkey AS BIGINT) l_orderkey", "0.0D l_tax")
    for update in (None, ["l_tax"]):
        assert "hashpartitioning" not in plan_of(merged(target, few, ["l_orderkey"], update))


# --- A key with a third of all rows -------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 activities: employee 0 has a third of them, and a third have no employee."""
    return spark.range(30_000, numPartitions=8).selectExpr(
        "CAST(id AS INT) AS activity_id",
        "CASE WHEN id < 10000 THEN 0 WHEN id < 20000 THEN NULL ELSE CAST(id AS INT) END AS employee_id",
        "timestamp_ntz'2025-01-01 00:00:00' AS start_datetime",
        "'Tennis' AS sport_type",
        "CAST(1 AS DECIMAL(10,2)) AS distance_meters",
        "timestamp_ntz'2025-01-01 01:00:00' AS end_datetime",
        "CAST(NULL AS STRING) AS comment",
    )


def test_hot_employee_is_counted_whole(spark, hot, large):
    found = benefits.activity_summary(hot, dt.date(2025, 6, 30))
    first = found.filter("employee_id = 0").first()
    assert (first["activity_count"], first["total_distance_meters"]) == (10_000, Decimal("10000.00"))

    known = spark.createDataFrame([(0,)], "employee_id int")
    declared = spark.createDataFrame([(0, "Judo")], "employee_id int, sport_type string")
    suite = values(quality.source_quality(hot, known, declared, dt.date(2025, 6, 30)))
    assert suite["unknown_employees"] == 20_000
    assert suite["inconsistent_sports"] == 10_000
    assert suite["activities_without_profile"] == 20_000
    assert suite["duplicates"] == 2  # the natural keys of employee 0 and of no employee


def test_hot_key_of_changes_keeps_its_last(spark, hot):
    history = hot.selectExpr("coalesce(employee_id, -1) AS activity_id", "activity_id AS offset", "'u' AS operation")
    last = changes.latest_per_key(history, "activity_id", ["offset"])
    assert values(last.filter("activity_id < 1"), "activity_id", "offset") == {0: 9_999, -1: 19_999}
    assert last.count() == 10_002


def test_busy_employee_gets_all_messages(spark, large):
    from test_streaming import after, envelope, messages

    batch = messages(spark, *[envelope("c", after(i, employee_id=0 if i % 3 else i)) for i in range(1, 301)])
    people = spark.createDataFrame([(i, f"F{i}", f"L{i}") for i in range(400)], "employee_id int, first_name string, last_name string")
    found = notifications(batch, people)
    assert found.count() == 300 and found.filter("first_name = 'F0'").count() == 200
