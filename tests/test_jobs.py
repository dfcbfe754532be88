"""The jobs in the order in which one runs them, on a handful of people."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from helpers import rows, values
from perkline import jobs, schemas
from perkline.operators.checks import QualityError
from perkline.sources import tables
from test_sources import HR
from test_streaming import MESSAGES, after, envelope, feed, messages

AS_OF = dt.date(2026, 10, 1)
SPORT = "ID salarié,Pratique d'un sport\n1,Runing\n2,Tennis\n"


def activities(spark, count, employee=1, first=1, start=dt.datetime(2026, 3, 1, 8)):
    return spark.createDataFrame(
        [
            (
                first + i,
                employee,
                start + dt.timedelta(days=i),
                "Running",
                Decimal("1000.00"),
                start + dt.timedelta(days=i, minutes=30),
                None,
            )
            for i in range(count)
        ],
        schemas.ACTIVITIES,
    )


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return tmp_path_factory.mktemp("jobs")


@pytest.fixture(scope="module")
def run(spark, place):
    (place / "hr.csv").write_text(HR, encoding="utf-8")
    (place / "sport.csv").write_text(SPORT, encoding="utf-8")
    published = ("employees", "sport_profile", "commute_validation", "source_activities", "activities", "employee_benefits")
    files = ("commute_distances", "new_activities", "doomed_activities", "data_quality_metrics", "distinct_sketches", "notifications", "unknown_people")
    settings = {
        "tables": {
            **{n: {"kind": "published", "path": f"{place}/{n}"} for n in published},
            **{n: {"kind": "path", "path": f"{place}/{n}"} for n in files},
            "hr_file": {"kind": "csv", "path": f"{place}/hr.csv"},
            "sport_file": {"kind": "csv", "path": f"{place}/sport.csv"},
        },
        "paths": {n: f"{place}/{n}" for n in ("reports", "results", "checkpoints")},
        "single_file_reports": True,
        "topic": {"format": "parquet", "path": f"{place}/topic", "schema": MESSAGES},
        "expected": {"row_count": 2, "bonus_eligible": 1, "bonus_total": "1500.03", "wellbeing_days": 5},
        "once": True,
    }
    json.dumps(settings)  # a settings file can hold it
    return jobs.Context(spark, settings, AS_OF)


def test_people(spark, run, place):
    assert run.spark and jobs.JOBS["audit-files"](run).count() > 10
    top = spark.read.csv(f"{place}/results/top-values-left", header=True)
    assert {r["column_name"] for r in top.collect()} == set(run.read("hr_file").columns)
    for _ in range(2):  # may be repeated
        report = jobs.JOBS["ingest-people"](run)
        assert {r["value"] for r in report.collect()} == {0}
    assert run.read("employees").count() == 2
    assert values(run.read("sport_profile"), "employee_id", "sport_type") == {1: "Running", 2: "Tennis"}
    jobs.JOBS["check-sports"](run)


def test_commutes(spark, run, place):
    distances = [(1, Decimal("15.000")), (2, None)]
    spark.createDataFrame(distances, "employee_id int, distance_km decimal(12,3)").write.parquet(
        f"{place}/commute_distances"
    )
    for _ in range(2):
        assert jobs.JOBS["validate-commutes"](run).first().asDict() == {
            "checked": 2,
            "valid": 1,
            "anomalies": 0,
            "errors": 1,
        }
    assert run.read("commute_validation").count() == 1


def test_activities(spark, run, place):
    bad = activities(spark, 1, start=dt.datetime(2027, 1, 1))
    tables.write_table(bad, f"{place}/new_activities")
    with pytest.raises(QualityError, match="future"):
        jobs.JOBS["load-activities"](run)
    tables.write_table(activities(spark, 16), f"{place}/new_activities")
    assert jobs.JOBS["load-activities"](run).first()["total_activities"] == 16
    assert jobs.JOBS["load-activities"](run).first()["total_activities"] == 16  # replaced, not added
    history = jobs.JOBS["distinct-history"](run).filter("column_name = 'activity_id'").orderBy("load").collect()
    assert [(r["distinct_values"], r["value_rows_so_far"], r["distinct_so_far"]) for r in history] == [(16, 16, 16), (16, 32, 16)]
    blocking = jobs.JOBS["check-source"](run).filter("blocking AND value > 0")
    assert blocking.count() == 0

    # The stream starts with nothing and takes creations; the merge brings the history.
    from perkline.streaming.changes import start_table

    start_table(spark, f"{place}/activities", activities(spark, 1))
    feed(messages(spark, envelope("c", after(16, employee_id=1)), envelope("c", after(90))), f"{place}/topic")
    jobs.JOBS["ingest-changes"](run)
    assert run.read("activities").count() == 2
    volume = jobs.JOBS["merge-history"](run).first()
    assert (volume["source_rows"], volume["target_rows"], volume["status"]) == (16, 17, "WARNING")
    assert [r["activity_id"] for r in jobs.JOBS["last-activities"](run).collect()][0] == 90

    spark.createDataFrame([(90,)], "activity_id int").write.parquet(f"{place}/doomed_activities")
    found = jobs.JOBS["cleanup-activities"](run).first()
    assert (found["rows_before"], found["rows_after"], found["last_key"]) == (17, 16, 16)
    gone = spark.read.csv(f"{place}/results/deleted-activities", header=True)
    assert [r["activity_id"] for r in gone.collect()] == ["90"]
    assert run.read("activities").count() == 16
    assert jobs.JOBS["check-activities"](run).filter("value > 0").count() == 0


def test_benefits_reports_and_monitoring(run, place):
    assert jobs.JOBS["check-wellbeing"](run).first()["days_awarded"] == 5
    judged = values(jobs.JOBS["build-benefits"](run), "metric_name", "matches")
    assert set(judged.values()) == {True}
    jobs.JOBS["export-reports"](run)
    with open(f"{place}/reports/employee_benefits.csv", encoding="utf-8") as file:
        assert file.readline().strip() == ",".join(schemas.BENEFIT_COLUMNS)
    with open(f"{place}/reports/activities.csv", encoding="utf-8") as file:
        assert len(file.readlines()) == 17

    for n in (1, 2):  # history grows by one set of counters per run
        states = values(jobs.JOBS["monitor"](run), "component", "status")
        assert set(states.values()) == {"OK"}
        assert run.read("data_quality_metrics").count() == 7 * n


def test_watch_rebuilds_after_a_change(spark, run, place):
    jobs.JOBS["watch"](run)  # first start: the present version counts as done
    version = tables.published_version(spark, f"{place}/employee_benefits")
    tables.publish(
        run.read("activities").union(activities(spark, 15, employee=2, first=100)), f"{place}/activities"
    )
    jobs.JOBS["watch"](run)
    assert tables.published_version(spark, f"{place}/employee_benefits") == version + 1
    assert run.read("employee_benefits").filter("wellbeing_days_awarded = 5").count() == 2
    with open(f"{place}/reports/activities.csv", encoding="utf-8") as file:
        assert len(file.readlines()) == 32


def test_figures_are_taken_while_the_rows_are_written(run, monkeypatch):
    def read_again(rows):
        raise AssertionError("the stored rows are not counted again")

    monkeypatch.setattr(jobs.benefits, "benefits_totals", read_again)
    figures = values(jobs.JOBS["build-benefits"](changed(run)), "metric_name", "matches")
    assert set(figures) == set(run.settings["expected"])


def test_benefits_by_what_changed(spark, run, place):
    kept = changed(run, **{n: {"kind": "published", "path": f"{place}/{n}"} for n in ("benefit_days", "maintained_benefits")})
    jobs.JOBS["build-benefits"](run)
    jobs.JOBS["update-benefits"](kept)
    stored = jobs.incremental.read_benefits(spark, f"{place}/maintained_benefits")
    assert rows(stored) == rows(run.read("employee_benefits"))
    jobs.JOBS["watch"](kept)
    later = activities(spark, 3, employee=2, first=500)
    tables.publish(run.read("activities").union(later), f"{place}/activities")
    jobs.JOBS["watch"](kept)
    assert jobs.JOBS["reconcile"](run).count() >= 3  # those activities are not in the source
    jobs.JOBS["build-benefits"](run)
    stored = jobs.incremental.read_benefits(spark, f"{place}/maintained_benefits")
    assert rows(stored) == rows(run.read("employee_benefits"))


def test_bad_records_and_dead_letters_are_set_aside(spark, run, place):
    folder = place / "dirty"
    folder.mkdir()
    lines = HR.strip().split("\n")
    (folder / "hr.csv").write_text("\n".join([*lines, lines[1] + ",one cell more", lines[1].replace(lines[1].split(",")[0], "x1", 1)]) + "\n", encoding="utf-8")
    lenient = changed(
        run,
        hr_file={"kind": "csv", "path": f"{folder}/hr.csv"},
        **{n: {"kind": "published", "path": f"{folder}/{n}"} for n in ("employees", "sport_profile")},
        activities={"kind": "path", "path": f"{folder}/activities"},
        dead_letters={"kind": "path", "path": f"{folder}/dead"},
    )
    with pytest.raises(Exception):  # noqa: B017  (whatever the reader raises)
        jobs.JOBS["ingest-people"](lenient)
    lenient.settings["set_bad_records_aside"] = True
    jobs.JOBS["ingest-people"](lenient)
    assert lenient.read("employees").count() == len(lines) - 1
    bad = spark.read.csv(f"{place}/results/employees-set-aside", header=True).collect()
    assert sorted(r["reasons"] for r in bad) == ["cells", "employee_id: not int"]

    lenient.settings["topic"]["path"] = f"{folder}/topic"
    lenient.settings["paths"] = {n: f"{folder}/{n}" for n in ("reports", "results", "checkpoints")}
    feed(messages(spark, envelope("c", after(1)), "{broken", None, envelope("z", after(2)), envelope("u", after(None)), '{"payload": null}'), f"{folder}/topic")
    for _ in range(2):  # a restart repeats nothing
        jobs.JOBS["ingest-changes"](lenient)
    assert lenient.read("activities").count() == 1
    dead = lenient.read("dead_letters").collect()
    assert sorted((r["offset"], r["reason"]) for r in dead) == [
        (1, "no JSON"), (2, "no value"), (3, "unknown operation"), (4, "no key"), (5, "no payload"),
    ]


def test_late_people(spark, run, place):
    assert jobs.JOBS["notify-late"](run).first()["messages"] == 0


def test_notify(spark, run, place):
    jobs.JOBS["notify"](run)
    notes = run.read("notifications").collect()
    assert [(n["activity_id"], n["first_name"]) for n in notes] == [(16, "Ana")]
    assert [n["activity_id"] for n in run.read("unknown_people").collect()] == [90]


def test_a_broken_component_is_reported(run, place):
    settings = json.loads(json.dumps(run.settings))
    settings["tables"]["source_activities"]["path"] = f"{place}/nowhere"
    states = values(
        jobs.JOBS["monitor"](jobs.Context(run.spark, settings, AS_OF)), "component", "status"
    )
    assert states["source_activities"] == states["volume"] == states["overall"] == "ERROR"
    assert states["quality"] == "OK"


def test_unknown_table_is_named(run):
    with pytest.raises(KeyError, match="no table"):
        run.read("unheard_of")


def changed(run, **places):
    settings = json.loads(json.dumps(run.settings))
    settings["tables"] |= places
    return jobs.Context(run.spark, settings, AS_OF)


WRITERS = {
    "ingest-people": "employees",
    "validate-commutes": "commute_validation",
    "load-activities": "source_activities",
    "merge-history": "activities",
    "cleanup-activities": "activities",
    "build-benefits": "employee_benefits",
}


@pytest.mark.parametrize("kind", ["jdbc", "path", "csv"])
@pytest.mark.parametrize("name,table", WRITERS.items())
def test_a_table_that_cannot_be_updated_is_refused_before_any_read(run, name, table, kind):
    # Nothing named here exists, so a read would fail otherwise.
    nowhere = {t: {"kind": kind, "path": "/nowhere", "url": "jdbc:none", "table": "t"} for t in run.settings["tables"]}
    with pytest.raises(ValueError, match=f"{table}.*needed: published or catalog"):
        jobs.JOBS[name](changed(run, **nowhere))


def test_streams_refuse_kinds_too(run):
    for name, table in (("watch", "activities"), ("notify", "notifications"), ("ingest-changes", "activities")):
        with pytest.raises(ValueError, match=table):
            jobs.JOBS[name](changed(run, **{table: {"kind": "csv", "path": "/nowhere"}}))


def test_monitor_reports_although_its_history_fails(run, place):
    broken = changed(run, data_quality_metrics={"kind": "published", "path": f"{place}/no-append"})
    states = values(jobs.JOBS["monitor"](broken), "component", "status")
    assert states["quality"] == states["overall"] == "ERROR" and states["activities"] == "OK"


def test_results_arrive_whole(spark, run):
    path = run.keep("many", spark.range(2500))
    assert spark.read.csv(path, header=True).count() == 2500
