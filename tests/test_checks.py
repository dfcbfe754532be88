"""Quality suites, uniqueness definitions, contracts and gates."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from helpers import rows, values
from perkline import schemas
from perkline.operators.checks import (
    Check,
    QualityError,
    enforce,
    key_measures,
    require_rows,
    require_unique,
    split_by_checks,
    verdict,
    violation_counts,
)
from perkline.operators.matching import (
    differing_value,
    key_differences,
    unknown_keys,
    without_value,
)
from perkline.operators.profiling import (
    column_profile,
    counts_by_month,
    counts_of_counts,
    frequencies,
    largest,
    repeated_rows,
)
from perkline.plans import monitoring, quality

T0 = dt.datetime(2024, 5, 1, 10)
H = dt.timedelta(hours=1)

# Nullable, so that faults can be put in.
LOOSE = T.StructType([T.StructField(f.name, f.dataType, True) for f in schemas.ACTIVITIES.fields])


@pytest.fixture(scope="module")
def faulty(spark):
    d = Decimal
    return spark.createDataFrame(
        [
            (1, 1, T0, "Running", d("5.00"), T0 + H, None),
            (1, 1, T0, "Running", d("5.00"), T0 + H, None),  # same in all columns
            (2, 1, T0, "Running", d("0.00"), T0, None),  # same natural key, end = start
            (3, 2, T0, "  ", d("-1.00"), T0 - H, None),  # blank sport, negative, end < start
            (4, 9, T0, None, None, T0 + H, None),  # unknown employee, no sport
            (None, None, None, "Judo", None, None, None),
            (None, 3, T0, "Judo", None, T0 + 9000 * H, None),  # second NULL key, far future
            (5, 2, T0 - 9000 * H, "Tennis", None, T0, None),  # too old, other sport than declared
        ],
        LOOSE,
    )


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame([(1,), (2,), (3,)], "employee_id int")


@pytest.fixture(scope="module")
def profile(spark):
    return spark.createDataFrame(
        [(1, "Running"), (2, "Boxe"), (3, None)], "employee_id int, sport_type string"
    )


def test_activity_suite(faulty):
    suite = quality.activity_quality(faulty)
    assert values(suite) == {
        "duplicates": 3,  # 8 rows, 5 different non-NULL keys
        "null_activity_id": 2,
        "null_employee_id": 1,
        "invalid_sport": 2,
        "null_start_datetime": 1,
        "null_end_datetime": 1,
        "invalid_dates": 1,
        "negative_distances": 1,
        "null_distances": 4,
    }
    assert verdict(suite).first().asDict() == {
        "blocking_errors": 12,
        "failed_checks": 8,
        "verdict": "KO",
    }


def test_informative_counters_do_not_block(spark):
    good = spark.createDataFrame([(1, 1, T0, "Tennis", None, T0 + H, None)], LOOSE)
    suite = quality.activity_quality(good)
    assert values(suite)["null_distances"] == 1
    assert verdict(suite).first()["verdict"] == "OK"
    enforce(suite, "nothing to refuse")


def test_source_suite(faulty, staff, profile):
    suite = values(quality.source_quality(faulty, staff, profile, T0 + 100 * H))
    assert suite == {
        "total": 8,
        "invalid_dates": 2,
        "future_activities": 1,
        "too_old_activities": 1,
        "negative_distances": 1,
        "null_distances": 4,
        "duplicates": 1,  # one natural key on three rows
        "unknown_employees": 2,  # employee 9 and the row without employee
        "inconsistent_sports": 2,  # the blank and the tennis of employee 2
        "activities_without_profile": 3,  # 9, NULL, and 3 whose profile is NULL
        "employees_with_activity": 4,
        "sports_count": 4,
        "below_threshold": 5,
        "at_least_threshold": 0,
    }


def test_three_meanings_of_duplicate(faulty):
    found = key_measures(faulty, ["activity_id"]).first().asDict()
    assert found == {
        "total": 8,
        "distinct_non_null": 5,
        "distinct_keys": 6,
        "repeated_keys": 2,
        "surplus_rows": 3,
        "later_rows": 2,
    }
    assert key_measures(faulty.limit(0), ["activity_id"]).first()["total"] == 0


def test_repeated_rows_exact_and_by_digest(faulty):
    assert repeated_rows(faulty).first().asDict() == {"total": 8, "later_rows": 1}
    assert repeated_rows(faulty, digest_text=True).first()["later_rows"] == 1
    assert repeated_rows(faulty, ["sport_type"], digest_text=True).first()["later_rows"] == 3


def test_stats(faulty):
    found = quality.activity_stats(faulty).first()
    assert (found["total"], found["distinct_activity_ids"]) == (8, 5)
    assert (found["distinct_employees"], found["distinct_sports"]) == (4, 4)
    assert found["first_activity"] == T0 - 9000 * H and found["last_end"] == T0 + 9000 * H


def test_quarantine_keeps_every_row_once(faulty):
    good, bad = split_by_checks(faulty, quality.ACTIVITY_CHECKS)
    assert good.count() + bad.count() == faulty.count()
    assert good.count() == 4
    reasons = {r["activity_id"]: r["violations"] for r in bad.collect() if r["activity_id"]}
    assert reasons == {3: ["invalid_sport", "invalid_dates", "negative_distances"], 4: ["invalid_sport"]}


def test_gates_stop(faulty, spark):
    with pytest.raises(QualityError, match="invalid_dates=2"):
        enforce(quality.load_gate(faulty, T0 + 100 * H), "load")
    with pytest.raises(QualityError, match="repeated_activity_id=3"):
        require_unique(faulty, ["activity_id"], "source")
    two = spark.createDataFrame([(1,), (2,)], "k int")
    require_rows(two, ["k"], 2, "export")
    with pytest.raises(QualityError, match="expected 161"):
        require_rows(two, ["k"], 161, "export")
    with pytest.raises(QualityError, match="repeated key"):
        require_rows(two.union(two), ["k"], None, "export")


def test_null_is_no_violation_of_a_comparison(spark):
    df = spark.createDataFrame([(None,), (-1,), (1,)], "x int")
    checks = [Check("negative", "x < 0"), Check("absent", "x IS NULL", blocking=False)]
    assert values(violation_counts(df, checks)) == {"negative": 1, "absent": 1}


def test_contracts(spark, faulty, staff):
    found = values(quality.contract_violations("activities", {"activities": faulty, "employees": staff}))
    assert found["repeated_activity_id"] == 1
    assert found["end_not_after_start"] == 2
    assert found["unknown_employee_id"] == 1  # NULL is a matter of NOT NULL
    assert found["null_employee_id"] == 1
    metrics = spark.createDataFrame(
        [(1, "m" * 101, 0, T0), (1, "ok", 1, T0), (2, None, None, None)],
        "quality_id int, metric_name string, metric_value long, checked_at timestamp_ntz",
    )
    found = values(quality.contract_violations("data_quality_metrics", {"data_quality_metrics": metrics}))
    assert found == {
        "repeated_quality_id": 1,
        "null_quality_id": 0,
        "null_metric_name": 1,
        "null_metric_value": 1,
        "null_checked_at": 1,
        "too_long_metric_name": 1,
    }


def test_matching(faulty, staff, profile):
    assert values(unknown_keys(faulty, staff, "employee_id"), "employee_id", "row_count") == {9: 1, None: 1}
    assert values(
        without_value(faulty, profile, "employee_id", "sport_type"), "employee_id", "row_count"
    ) == {9: 1, None: 1, 3: 1}
    assert rows(differing_value(faulty, profile, "employee_id", "sport_type").select("employee_id", "sport_type")) == [
        (("employee_id", 2), ("sport_type", "  ")),
        (("employee_id", 2), ("sport_type", "Tennis")),
    ]


def test_key_differences_both_ways(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    right = spark.createDataFrame([(2,), (4,), (4,)], "id int")
    assert values(key_differences(left, right, "id"), "id", "missing_from") == {
        1: "right",
        3: "right",
        4: "left",
    }
    assert key_differences(left, left, "id").count() == 0


def test_profiles(faulty):
    nulls = values(column_profile(faulty), "column_name", "null_count")
    assert nulls["comment"] == 8 and nulls["activity_id"] == 2 and nulls["distance_meters"] == 4
    first = frequencies(faulty, "sport_type").collect()
    assert (first[0]["sport_type"], first[0]["row_count"]) == ("Running", 3)
    assert {r["sport_type"] for r in first} == {"Running", "Judo", "  ", "Tennis", None}
    assert values(counts_by_month(faulty.dropna(subset=["start_datetime"]), "start_datetime"), "month", "row_count") == {
        "2023-04": 1,
        "2024-05": 6,
    }
    spread = counts_of_counts(faulty, "employee_id", 3).first()
    assert (spread["keys"], spread["min_rows"], spread["max_rows"]) == (5, 1, 3)
    assert (spread["below_threshold"], spread["at_least_threshold"]) == (4, 1)
    assert [r["activity_id"] for r in largest(faulty, ["activity_id"], 2).collect()] == [5, 4]


def test_monitoring(spark, faulty):
    benefits = spark.createDataFrame([(1,), (1,), (None,)], "employee_id int")
    metrics = monitoring.quality_metrics(faulty, benefits)
    assert values(metrics) == {
        "duplicate_activity_id": 2,
        "null_activity_id": 2,
        "null_employee_id_activities": 1,
        "inconsistent_dates": 1,
        "negative_distances": 1,
        "duplicate_benefit_employee_id": 1,
        "null_benefit_employee_id": 1,
    }
    history = monitoring.metric_history(metrics, T0)
    assert history.columns == ["metric_name", "metric_value", "checked_at"]


def test_component_states(spark, folder):
    readers = {
        "source": lambda: spark.range(5),
        "table": lambda: spark.range(4),
        "gone": lambda: spark.read.parquet(f"{folder}/nothing-here"),
    }
    counts = monitoring.component_counts(readers)
    assert counts == {"source": 5, "table": 4, "gone": None}
    broken = monitoring.component_status(counts, "source", "table", False)
    assert broken["gone"] == "ERROR" and broken["overall"] == "ERROR" and broken["volume"] == "WARNING"
    del counts["gone"]
    assert monitoring.component_status(counts, "source", "table", False)["overall"] == "WARNING"
    assert monitoring.component_status(counts, "source", "table", True)["overall"] == "ERROR"
    counts["table"] = 5
    assert monitoring.component_status(counts, "source", "table", False)["overall"] == "OK"
