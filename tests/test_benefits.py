"""The benefit rules on small tables that hold every boundary."""

import datetime as dt
from decimal import Decimal

import pytest

from helpers import rows, values
from perkline import schemas
from perkline.operators.comparing import against_expected, expected_metrics, metric_rows
from perkline.operators.rules import commute_rules, known_sports, uncovered
from perkline.plans import benefits, commute

AS_OF = dt.date(2025, 6, 30)
FIRST = dt.datetime(2024, 6, 30)


def people(spark, *entries):
    """(id, salary, mode)"""
    day = dt.date(1990, 5, 17)
    return spark.createDataFrame(
        [
            (i, f"L{i}", f"F{i}", day, "Unit", day, Decimal(salary), "CDI", 25, "somewhere", mode)
            for i, salary, mode in entries
        ],
        schemas.EMPLOYEES,
    )


def activity(number, employee, start, metres="1000.00"):
    distance = None if metres is None else Decimal(metres)
    return (number, employee, start, "Running", distance, start + dt.timedelta(minutes=30), None)


@pytest.fixture(scope="module")
def tables(spark):
    staff = people(
        spark,
        (1, "30000.00", "Marche/running"),
        (2, "30000.10", "Vélo/Trottinette/Autres"),
        (3, "41000.30", "Transports en commun"),
        (4, "25000.00", "Marche/running"),
    )
    distances = spark.createDataFrame(
        [(1, Decimal("15.000")), (2, Decimal("25.000")), (3, Decimal("1.000")), (4, Decimal("15.001"))],
        "employee_id int, distance_km decimal(12,3)",
    )
    asked = staff.join(distances, "employee_id")
    entries, number = [], 0
    # 14, 15 and 16 in the window; employee 2 also has one on the first day, one too old.
    for employee, count in ((1, 14), (2, 15), (4, 16)):
        for k in range(count):
            number += 1
            start = FIRST if k == 0 else dt.datetime(2025, 1, 1) + dt.timedelta(hours=k)
            entries.append(activity(number, employee, start, None if k == 1 else "1000.00"))
    entries.append(activity(900, 1, FIRST - dt.timedelta(microseconds=1)))
    entries.append(activity(901, 2, dt.datetime(2026, 1, 1)))  # after the reference day
    activities = spark.createDataFrame(entries, schemas.ACTIVITIES)
    return staff, commute.validated(asked, commute_rules(spark)), activities


def test_every_employee_gets_one_row(spark, tables):
    result = {r["employee_id"]: r for r in benefits.employee_benefits(*tables, AS_OF).collect()}
    assert sorted(result) == [1, 2, 3, 4]

    assert result[1]["sport_bonus_eligible"] and result[1]["sport_bonus_amount"] == Decimal("1500.00")
    # Half a cent goes up: 30000.10 * 5 % = 1500.005.
    assert result[2]["sport_bonus_amount"] == Decimal("1500.01")
    # No rule for the mode: not a sport commute, no distance.
    assert not result[3]["is_sport_commute"] and result[3]["commute_distance_km"] is None
    assert result[3]["activity_count"] == 0 and result[3]["total_distance_meters"] == 0
    # One metre beyond the limit, although the stored distance reads 15.00.
    assert result[4]["is_sport_commute"] and not result[4]["commute_validated"]
    assert result[4]["commute_distance_km"] == Decimal("15.00")
    assert result[4]["sport_bonus_amount"] == Decimal("0.00")

    assert [result[i]["activity_count"] for i in (1, 2, 4)] == [14, 16, 16]
    assert [result[i]["wellbeing_days_awarded"] for i in (1, 2, 3, 4)] == [0, 5, 0, 5]
    assert {r["calculation_date"] for r in result.values()} == {AS_OF}
    # The activity without a distance adds nothing, the others 1 km each.
    assert result[1]["total_distance_meters"] == Decimal("13000.00")


def test_columns_and_types(tables):
    result = benefits.employee_benefits(*tables, AS_OF)
    assert tuple(result.columns) == schemas.BENEFIT_COLUMNS
    kinds = dict(result.dtypes)
    assert kinds["activity_count"] == "int"
    assert kinds["sport_bonus_amount"].startswith("decimal")
    assert kinds["calculation_date"] == "date"


def test_bounded_window_excludes_the_future(tables):
    eligible = benefits.wellbeing_eligibility(tables[2], AS_OF)
    assert values(eligible, "employee_id", "activity_count") == {1: 14, 2: 15, 4: 16}
    summary = benefits.wellbeing_summary(eligible).first()
    assert (summary["eligible"], summary["not_eligible"]) == (2, 1)
    assert summary["days_awarded"] == summary["days_expected"] == 10 and summary["days_agree"]


def test_parameters_change_the_rules(tables):
    result = benefits.employee_benefits(*tables, AS_OF, rate="0.10", min_activities=1, days=2)
    found = {r["employee_id"]: r for r in result.collect()}
    assert found[1]["sport_bonus_amount"] == Decimal("3000.00")
    assert [found[i]["wellbeing_days_awarded"] for i in (1, 2, 3, 4)] == [2, 2, 0, 2]


def test_totals_and_expected_figures(spark, tables):
    result = benefits.employee_benefits(*tables, AS_OF)
    totals = benefits.benefits_totals(result)
    row = totals.first()
    assert row["bonus_total"] == Decimal("3000.01")
    assert (row["row_count"], row["duplicates"], row["bonus_eligible"]) == (4, 0, 2)
    twice = benefits.benefits_totals(result.union(result)).first()
    assert (twice["row_count"], twice["distinct_employees"], twice["duplicates"]) == (8, 4, 4)

    wanted = {"row_count": 4, "bonus_total": "3000.01", "wellbeing_days": 15, "no_such": 1}
    judged = values(
        against_expected(metric_rows(totals), expected_metrics(spark, wanted)), "metric_name", "matches"
    )
    assert judged == {"row_count": True, "bonus_total": True, "wellbeing_days": False, "no_such": False}


def test_tolerance_is_exclusive(spark):
    actual = expected_metrics(spark, {"a": "10.00", "b": "10.01"})
    expected = expected_metrics(spark, {"a": "10.00", "b": "10.00"})
    assert values(against_expected(actual, expected), "metric_name", "matches") == {"a": True, "b": False}


def test_commute_counters(spark):
    rules = commute_rules(spark)
    requests = spark.createDataFrame(
        [
            (1, "Marche/running", Decimal("15.000")),
            (2, "Marche/running", Decimal("15.001")),
            (3, "Vélo/Trottinette/Autres", None),
            (4, "véhicule thermique/électrique", Decimal("2.000")),
        ],
        "employee_id int, commute_mode string, distance_km decimal(12,3)",
    )
    assert commute.summary(requests, rules).first().asDict() == {
        "checked": 3,
        "valid": 1,
        "anomalies": 1,
        "errors": 1,
    }
    stored = rows(commute.validated(requests, rules).select("employee_id", "is_valid", "validation_reason"))
    assert stored == [
        (
            ("employee_id", 1),
            ("is_valid", True),
            ("validation_reason", "Distance inférieure ou égale au seuil de 15 km."),
        ),
        (("employee_id", 2), ("is_valid", False), ("validation_reason", "Distance supérieure au seuil de 15 km.")),
    ]


def test_candidates_are_ordered_and_have_a_travel_mode(spark):
    staff = people(
        spark, (3, "1.00", "Marche/running"), (1, "1.00", "Vélo/Trottinette/Autres"), (2, "1.00", "voiture")
    )
    found = commute.candidates(staff, commute_rules(spark)).collect()
    assert [(r["employee_id"], r["travel_mode"]) for r in found] == [(1, "BICYCLE"), (3, "WALK")]


def test_uncovered_sports(spark):
    declared = spark.createDataFrame(
        [("Tennis",), ("Curling",), (None,), ("Curling",)], "sport_type string"
    )
    assert rows(uncovered(declared, known_sports(spark), "sport_type")) == [
        (("row_count", 2), ("sport_type", "Curling"))
    ]


def test_unit_figures(spark, tables):
    by_unit = benefits.benefits_by_unit(benefits.employee_benefits(*tables, AS_OF)).collect()
    assert len(by_unit) == 1
    assert by_unit[0]["bonus_total"] == Decimal("3000.01") and by_unit[0]["activities"] == 46
