"""The jobs one submits: each reads tables named in a settings file, and writes or reports.

``spark-submit … perkline/jobs.py <job> --settings settings.json [--as-of 2025-01-24]``

Settings name where every table is::

    {"tables": {
        "employees":  {"kind": "published", "path": "hdfs://…/employees", "buckets": 64},
        "activities": {"kind": "catalog", "table": "lake.activities"},
        "hr_file":    {"kind": "csv", "path": "…"},
        "commute_distances": {"kind": "path", "path": "…", "format": "parquet"},
        "source_activities": {"kind": "jdbc", "url": "jdbc:postgresql://…", "table": "public.activities",
                              "options": {"user": "…"}, "split": {"column": "activity_id", "partitions": 64}}},
     "paths":  {"reports": "…", "results": "…", "checkpoints": "…"},
     "single_file_reports": ["employee_benefits"],
     "apply_interval": "10 minutes",
     "topic":  {"format": "kafka", "servers": "…", "name": "…", "starting": "latest"}}

What a kind allows besides reading: ``published`` and ``catalog`` (a table format with row-level updates)
everything; ``path`` and ``jdbc`` appending; ``csv`` nothing. A job names the kinds it needs and
refuses others before it reads anything. A published table with ``buckets`` is laid out by its key when it
is first loaded, so that later jobs rewrite the touched buckets only. What a job returns is written whole
to ``results/<job>``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from perkline import fixed_values as fixed
from perkline.operators import distincts
from perkline.operators.checks import QualityError, all_checks, enforce, require_unique, verdict
from perkline.operators.comparing import against_expected, expected_metrics, metric_rows, volumes
from perkline.operators.frequent import top_values
from perkline.operators.merging import (
    delete_catalog,
    delete_published,
    load_or_merge_published,
    merge_catalog,
    with_keys,
)
from perkline.operators.profiling import counts_by_month, frequencies, largest, rows_left
from perkline.operators.reconciling import key_differences
from perkline.operators.rules import commute_rules, known_sports, uncovered
from perkline.plans import benefits, commute, incremental, monitoring, people, quality, reporting
from perkline.session import build_session
from perkline.sources.files import read_delimited, read_delimited_leniently, write_report
from perkline.sources.jdbc import Database, Split, append_database, read_database
from perkline.sources.streams import read_stream, read_topic
from perkline.sources.tables import publish, published_snapshot, read_published, read_table, write_table
from perkline.streaming import changes
from perkline.streaming.notifications import notify_late, notify_stream
from perkline.streaming.recompute import recompute_on_change, version_stream


LOG = logging.getLogger(__name__)
UPDATABLE = ("published", "catalog")


class Context:
    """A session, the settings and the reference time of one run.

    Without a given day every computation takes its own today, so that a job that
    runs for weeks does not stay at the day it was started.
    """

    def __init__(self, spark: SparkSession, settings: dict, as_of: dt.date | None = None) -> None:
        self.spark, self.settings, self._as_of = spark, settings, as_of

    @property
    def as_of(self) -> dt.date:
        return self._as_of or dt.date.today()

    def place(self, table: str) -> dict:
        try:
            return self.settings["tables"][table]
        except KeyError:
            raise KeyError(f"settings name no table {table!r}") from None

    def path(self, name: str) -> str:
        return self.settings["paths"][name]

    def checkpoint(self, job: str) -> str:
        return f"{self.path('checkpoints')}/{job}"

    def needs(self, table: str, *kinds: str) -> dict:
        """The place of a table whose kind must be one of ``kinds``."""
        place = self.place(table)
        if place["kind"] not in kinds:
            raise ValueError(f"table {table!r} is of kind {place['kind']!r}; needed: {' or '.join(kinds)}")
        return place

    def read(self, table: str) -> DataFrame:
        place = self.needs(table, "published", "catalog", "jdbc", "csv", "path")
        if place["kind"] == "published":
            return read_published(self.spark, place["path"])
        if place["kind"] == "catalog":
            return self.spark.read.table(place["table"])
        if place["kind"] == "jdbc":
            split = Split(**place["split"]) if "split" in place else None
            db = Database(place["url"], place.get("options", {}))
            return read_database(self.spark, db, place["table"], split)
        if place["kind"] == "csv":
            return read_delimited(self.spark, place["path"])
        return read_table(
            self.spark, place["path"], place.get("format", "parquet"), **place.get("options", {})
        )

    def replace(self, table: str, rows: DataFrame, **options) -> None:
        """``options`` are those of a published table."""
        place = self.needs(table, *UPDATABLE)
        if place["kind"] == "published":
            publish(rows, place["path"], **options)
        else:
            rows.writeTo(place["table"]).overwrite(F.lit(True))

    def append(self, table: str, rows: DataFrame) -> None:
        place = self.needs(table, "jdbc", "path", "catalog")
        if place["kind"] == "jdbc":
            append_database(rows, Database(place["url"], place.get("options", {})), place["table"])
        elif place["kind"] == "catalog":
            rows.writeTo(place["table"]).append()
        else:
            write_table(rows, place["path"], "append", place.get("format", "parquet"))

    def upsert(self, table: str, rows: DataFrame, keys: list[str], update: list[str] | None = None) -> None:
        place = self.needs(table, *UPDATABLE)
        if place["kind"] == "published":
            load_or_merge_published(self.spark, place["path"], rows, keys, update, place.get("buckets"))
        else:
            merge_catalog(rows, place["table"], keys, update)

    def delete(self, table: str, doomed: DataFrame, keys: list[str]) -> None:
        place = self.needs(table, *UPDATABLE)
        if place["kind"] == "published":
            delete_published(self.spark, place["path"], doomed, keys)
        else:
            delete_catalog(doomed, place["table"], keys)

    def keep(self, name: str, result: DataFrame) -> str:
        """A result, whole, in ``results/<name>``."""
        return write_report(result, self.path("results"), name)

    def messages(self) -> DataFrame:
        topic = self.settings["topic"]
        if topic["format"] == "kafka" and "servers" in topic:
            return read_topic(self.spark, topic["servers"], topic["name"], topic.get("starting", "latest"))
        return read_stream(
            self.spark, topic["format"], topic.get("path"), topic.get("schema"), **topic.get("options", {})
        )


JOBS: dict[str, Callable[[Context], DataFrame | None]] = {}


def job(name: str):
    def add(function):
        JOBS[name] = function
        return function

    return add


# --- People and commutes -----------------------------------------------------------


@job("audit-files")
def audit_files(run: Context) -> DataFrame:
    """Counts; the missing ids, the frequency tables and the most frequent values of all columns are results of their own."""
    staff, sport = run.read("hr_file"), run.read("sport_file")
    run.keep("missing-ids", people.missing_ids(staff, sport, "ID salarié"))
    tables = people.frequency_table(staff, fixed.AUDITED_HR_COLUMNS, "left").unionByName(
        people.frequency_table(sport, fixed.AUDITED_SPORT_COLUMNS, "right")
    )
    run.keep("frequencies", tables)
    run.keep("top-values-left", top_values(staff, staff.columns))
    run.keep("top-values-right", top_values(sport, sport.columns))
    return people.audit(staff, sport, "ID salarié")


@job("ingest-people")
def ingest_people(run: Context) -> DataFrame:
    """With the setting ``set_bad_records_aside`` records that do not fit become results of their own, and the others are
    loaded; without, one of them ends the job."""
    run.needs("employees", *UPDATABLE)
    run.needs("sport_profile", *UPDATABLE)
    files = (
        ("hr_file", "employees", people.employees_from_file, people.employees_or_set_aside),
        ("sport_file", "sport_profile", people.profile_from_file, people.profile_or_set_aside),
    )
    for file, table, from_file, or_set_aside in files:
        if run.settings.get("set_bad_records_aside", False):
            lenient = read_delimited_leniently(run.spark, run.needs(file, "csv")["path"])
            rows, bad = or_set_aside(lenient)
            run.keep(f"{table}-set-aside", bad.withColumn("reasons", F.array_join("reasons", "; ")))
        else:
            rows = from_file(run.read(file))
        run.upsert(table, rows, ["employee_id"])
    return all_checks(
        quality.contract_violations("employees", {"employees": run.read("employees")}),
        quality.contract_violations(
            "sport_profile",
            {"sport_profile": run.read("sport_profile"), "employees": run.read("employees")},
        ),
    )


@job("validate-commutes")
def validate_commutes(run: Context) -> DataFrame:
    """``commute_distances`` holds ``(employee_id, distance_km)``; NULL means no route."""
    run.needs("commute_validation", *UPDATABLE)
    rules = commute_rules(run.spark)
    people_with_rule = commute.candidates(run.read("employees"), rules)
    asked = people_with_rule.join(run.read("commute_distances"), "employee_id", "left").select(
        "employee_id", "commute_mode", "distance_km"
    )
    run.upsert(
        "commute_validation",
        commute.validated(asked, rules),
        ["employee_id"],
        list(commute.UPDATED_COLUMNS),
    )
    return commute.summary(asked, rules)


# --- Activities --------------------------------------------------------------------


@job("check-sports")
def check_sports(run: Context) -> DataFrame:
    """Declared sports without a rule; fails if there is one."""
    missing = uncovered(run.read("sport_profile"), known_sports(run.spark), "sport_type")
    first = missing.first()
    if first is not None:
        raise QualityError(f"no rule for sport {first['sport_type']!r}")
    return missing


SKETCHED = ["activity_id", "employee_id", "sport_type"]


@job("load-activities")
def load_activities(run: Context) -> DataFrame:
    """Replace the history by ``new_activities`` if no essential rule is broken.

    If ``distinct_sketches`` is a table, sketches of the load's different values are added to it."""
    run.needs("source_activities", *UPDATABLE)
    new = run.read("new_activities")
    enforce(quality.load_gate(new, run.as_of), "load of activities")
    run.replace("source_activities", new)
    if "distinct_sketches" in run.settings["tables"]:
        loaded_at = F.lit(dt.datetime.now(dt.UTC).isoformat(sep=" ", timespec="microseconds")[:26])
        run.append("distinct_sketches", distincts.distinct_sketches(run.read("source_activities"), SKETCHED, loaded_at))
    return quality.load_summary(run.read("source_activities"))


@job("distinct-history")
def distinct_values(run: Context) -> DataFrame:
    """Different activities, employees and sports of every load and of all loads up to it, from the sketches that
    ``load-activities`` keeps if ``distinct_sketches`` is a table; no load is read again."""
    return distincts.distinct_history(run.read("distinct_sketches"))


@job("check-source")
def check_source(run: Context) -> DataFrame:
    """Counters; the period covered and the counts per sport and per month are results of their own."""
    activities = run.read("source_activities")
    run.keep("source-period", quality.activity_stats(activities))
    run.keep("source-sports", frequencies(activities, "sport_type"))
    run.keep("source-months", counts_by_month(activities, "start_datetime"))
    return quality.source_quality(
        run.read("source_activities"), run.read("employees"), run.read("sport_profile"), run.as_of
    )


@job("check-activities")
def check_activities(run: Context) -> DataFrame:
    """Counters; statistics, verdict and counts per sport are results of their own."""
    activities = run.read("activities")
    checks = quality.activity_quality(activities)
    run.keep("activity-stats", quality.activity_stats(activities))
    run.keep("activity-sports", frequencies(activities, "sport_type"))
    run.keep("activity-verdict", verdict(checks))
    return checks


@job("last-activities")
def last_activities(run: Context) -> DataFrame:
    return largest(run.read("activities"), ["activity_id"], 5)


@job("merge-history")
def merge_history(run: Context) -> DataFrame:
    """Upsert the source's history; the report compares the numbers of rows."""
    run.needs("activities", *UPDATABLE)
    source = run.read("source_activities")
    run.upsert("activities", source, ["activity_id"])
    return volumes(source, run.read("activities"))


@job("cleanup-activities")
def cleanup_activities(run: Context) -> DataFrame:
    """Delete the keys listed in ``doomed_activities``; the rows themselves are kept in
    ``results/deleted-activities`` first. Reports rows before and after, and the last key left."""
    run.needs("activities", *UPDATABLE)
    doomed, before = run.read("doomed_activities"), run.read("activities")
    run.keep("deleted-activities", with_keys(before, doomed, ["activity_id"]))
    rows_before = before.count()
    run.delete("activities", doomed, ["activity_id"])
    return rows_left(run.read("activities"), "activity_id").withColumn("rows_before", F.lit(rows_before))


# --- Benefits ----------------------------------------------------------------------


@job("check-wellbeing")
def check_wellbeing(run: Context) -> DataFrame:
    return benefits.wellbeing_summary(
        benefits.wellbeing_eligibility(run.read("activities"), run.as_of)
    )


@job("build-benefits")
def build_benefits(run: Context) -> DataFrame:
    """Compute and store; the report compares the stored rows' figures with the expected ones, if given."""
    place = run.needs("employee_benefits", *UPDATABLE)
    computed = benefits.employee_benefits(
        run.read("employees"), run.read("commute_validation"), run.read("activities"), run.as_of
    )
    if place["kind"] == "published":
        # The figures are taken while the rows are written, and the written keys are checked before they are published.
        unique = lambda rows: require_unique(rows, ["employee_id"], "benefits")
        run.replace("employee_benefits", computed, counters=benefits.benefits_counters(), check=unique)
        figures = published_snapshot(run.spark, place["path"]).notes["counters"]
        figures |= {"distinct_employees": figures["row_count"], "duplicates": 0}
        actual = expected_metrics(run.spark, figures)
    else:
        run.replace("employee_benefits", computed)
        actual = metric_rows(benefits.benefits_totals(run.read("employee_benefits")))
    return _judged(run, actual)


def _judged(run: Context, actual: DataFrame) -> DataFrame:
    expected = run.settings.get("expected")
    return actual if expected is None else against_expected(actual, expected_metrics(run.spark, expected))


@job("update-benefits")
def update_benefits(run: Context) -> DataFrame:
    """Benefits by what changed since the last update: all inputs are published tables, ``benefit_days``
    holds the partial sums, and ``maintained_benefits`` the results."""
    names = ("employees", "commute_validation", "activities", "benefit_days", "maintained_benefits")
    paths = [run.needs(name, "published")["path"] for name in names]
    incremental.update_benefits(run.spark, *paths, run.as_of)
    return _judged(run, metric_rows(benefits.benefits_totals(incremental.read_benefits(run.spark, paths[-1]))))


@job("reconcile")
def reconcile(run: Context) -> DataFrame:
    """Every activity that is missing, extra or changed in ``activities`` against the source."""
    source = run.read("source_activities")
    return key_differences(source, run.read("activities").select(*source.columns), ["activity_id"])


@job("export-reports")
def export_reports(run: Context) -> None:
    maintained = run.settings["tables"].get("maintained_benefits")
    reporting.export_reports(
        run.read("employee_benefits") if maintained is None else incremental.read_benefits(run.spark, maintained["path"]),
        run.read("activities"),
        run.path("reports"),
        run.settings.get("expected", {}).get("row_count"),
        run.settings.get("single_file_reports", False),
    )


@job("monitor")
def monitor(run: Context) -> DataFrame:
    """State of every component, and the quality counters appended to their history.

    Whatever fails, all states are reported: a column that cannot be read or a history
    that cannot be written makes the quality an ERROR.
    """
    names = ("employees", "source_activities", "activities", "employee_benefits")
    counts = monitoring.component_counts({n: (lambda n=n: run.read(n)) for n in names})
    failed = counts["activities"] is None or counts["employee_benefits"] is None
    if not failed:
        metrics = monitoring.quality_metrics(run.read("activities"), run.read("employee_benefits"))
        history = monitoring.metric_history(metrics, dt.datetime.now(dt.UTC).replace(tzinfo=None))
        history = history.persist()
        try:
            failed = verdict(
                history.select(
                    F.col("metric_name").alias("check_name"),
                    F.col("metric_value").alias("value"),
                    F.lit(True).alias("blocking"),
                )
            ).first()["verdict"] == "KO"
            run.append("data_quality_metrics", history)
        except (PySparkException, Py4JError, OSError, KeyError, ValueError):
            LOG.exception("quality counters")
            failed = True
        finally:
            history.unpersist()
    states = monitoring.component_status(counts, "source_activities", "activities", failed)
    return run.spark.createDataFrame(
        [(n, s, counts.get(n)) for n, s in states.items()], "component string, status string, rows long"
    )


# --- Streams: run until stopped -------------------------------------------------------


@job("ingest-changes")
def ingest_changes(run: Context) -> None:
    place = run.needs("activities", "published", "catalog", "path")
    once, interval = run.settings.get("once", False), run.settings.get("apply_interval", "10 minutes")
    queries = []
    if "dead_letters" in run.settings["tables"]:
        aside = run.needs("dead_letters", "path")
        letters, fmt = run.checkpoint("dead-letters"), aside.get("format", "parquet")
        queries.append(changes.set_aside(run.messages(), aside["path"], letters, fmt, once))
    if place["kind"] == "path":
        fmt = place.get("format", "parquet")
        queries.append(changes.ingest(run.messages(), place["path"], run.checkpoint("ingest"), fmt, once))
    else:
        queries.append(
            changes.apply_stream(
                run.messages(),
                place.get("path", ""),
                run.checkpoint("ingest"),
                catalog_table=place.get("table"),
                once=once,
                interval=interval,
            )
        )
    for running in queries:
        running.awaitTermination()


@job("notify")
def notify(run: Context) -> None:
    """Messages go to ``notifications``, activities of people not known then to ``unknown_people``."""
    notify_stream(
        run.messages(),
        lambda spark: run.read("employees"),
        run.needs("notifications", "path")["path"],
        run.needs("unknown_people", "path")["path"],
        run.checkpoint("notify"),
        once=run.settings.get("once", False),
    ).awaitTermination()


@job("notify-late")
def notify_late_people(run: Context) -> DataFrame:
    """Messages for activities in ``unknown_people`` whose people are known by now; reports their number."""
    found = notify_late(
        run.spark,
        run.read("employees"),
        run.needs("notifications", "path")["path"],
        run.needs("unknown_people", "path")["path"],
    )
    return run.spark.createDataFrame([(found,)], "messages long")


@job("watch")
def watch(run: Context) -> None:
    """Rebuild and export after every change of the published activities; where settings name
    ``maintained_benefits``, only what changed is recomputed."""
    path = run.needs("activities", "published")["path"]

    maintained = "maintained_benefits" in run.settings["tables"]

    def recompute(_: SparkSession) -> None:
        if maintained:
            update_benefits(run)
        else:
            build_benefits(run)
        export_reports(run)

    recompute_on_change(
        version_stream(run.spark, path),
        recompute,
        run.checkpoint("watch"),
        adopt_current=True,
        once=run.settings.get("once", False),
    ).awaitTermination()


def main() -> None:
    parser = argparse.ArgumentParser(description="Runs one job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--settings", required=True, help="settings file (JSON)")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="default: today")
    args = parser.parse_args()
    with open(args.settings, encoding="utf-8") as file:
        settings = json.load(file)
    spark = build_session(f"perkline-{args.job}")
    run = Context(spark, settings, args.as_of)
    result = JOBS[args.job](run)
    if result is not None:
        path = run.keep(args.job, result)
        written = read_delimited(spark, path)
        print(f"{written.count()} rows in {path}; the first of them:")
        written.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
