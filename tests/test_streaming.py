"""Streams on small files: decoding, restarts, repeated batches, recomputation."""

import base64
import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from perkline import schemas
from perkline.sources import streams, tables
from perkline.streaming import changes
from perkline.streaming.notifications import notifications, notify_late, notify_stream
from perkline.streaming.recompute import recompute_on_change, version_stream

MESSAGES = "value binary, partition int, offset long"
T0 = dt.datetime(2026, 9, 27, 2, 15, 3, 158506)
MICROS = 1790475303158506


def decimal_text(number):
    return base64.b64encode(number.to_bytes(5, "big", signed=True)).decode()


def after(key, **other):
    row = {
        "activity_id": key,
        "employee_id": 7,
        "start_datetime": MICROS,
        "sport_type": "Running",
        "distance_meters": decimal_text(600000),
        "end_datetime": MICROS + 46 * 60_000_000,
        "comment": None,
    }
    return row | other


def envelope(op, row, before=None):
    return json.dumps({"schema": {"ignored": True}, "payload": {"op": op, "before": before, "after": row}})


def messages(spark, *texts, start=0):
    return spark.createDataFrame(
        [(None if t is None else bytearray(t.encode()), 0, start + i) for i, t in enumerate(texts)], MESSAGES
    )


def feed(df, path):
    """One more file in the topic's folder."""
    df.coalesce(1).write.mode("append").parquet(path)


def topic(spark, path, **options):
    return streams.read_stream(spark, "parquet", path, MESSAGES, **options)


def test_only_creations_with_a_key_come_through(spark):
    batch = messages(
        spark,
        envelope("c", after(1)),
        envelope("u", after(2)),
        envelope("d", None, {"activity_id": 3}),
        envelope("r", after(4)),
        envelope("c", None),
        envelope("c", after(None)),
        json.dumps({"other": 1}),
        "{broken",
        "",
        None,
        envelope("c", after(5, distance_meters=None, end_datetime=None)),
        envelope("c", after(6, distance_meters="%%%")),
    )
    found = {r["activity_id"]: r for r in changes.created_activities(batch).collect()}
    assert sorted(found) == [1, 5, 6]
    assert found[1]["start_datetime"] == T0 and found[1]["distance_meters"] == Decimal("6000.00")
    assert found[5]["end_datetime"] is None and found[5]["distance_meters"] is None
    assert found[6]["distance_meters"] is None

    every = changes.only(changes.parse_envelopes(batch), ("c", "u", "d", "r"))
    assert {r["activity_id"]: r["operation"] for r in every.collect()} == {
        1: "c", 2: "u", 3: "d", 4: "r", 5: "c", 6: "c"
    }
    whole_seconds = changes.created_activities(batch, whole_seconds=True).first()
    assert whole_seconds["start_datetime"] == T0.replace(microsecond=0)


def test_messages_for_known_employees(spark):
    staff = spark.createDataFrame(
        [(7, "Ana", "Roux"), (8, "Bo", "Lin")], "employee_id int, first_name string, last_name string"
    )
    batch = messages(
        spark,
        envelope("c", after(1, comment="Belle séance !")),
        envelope("c", after(2, employee_id=8, distance_meters=None)),
        envelope("c", after(3, employee_id=99)),
        envelope("u", after(4)),
    )
    found = {r["activity_id"]: r for r in notifications(batch, staff).collect()}
    assert sorted(found) == [1, 2]
    assert found[1]["message"] == (
        "Bravo Ana Roux ! Tu viens de terminer une activité Running de 6.00 km en 46 min ! 🔥🏅"
        "\n💬 Belle séance !"
    )
    assert found[1]["start_text"] == "27/09/2026 02:15:03"
    assert found[2]["message"] == "Bravo Bo Lin ! Tu viens de terminer une activité Running en 46 min ! 🔥🏅"
    spoken = notifications(batch, staff, say_missing_distance=True).filter("activity_id = 2").first()
    assert " de Distance non renseignée en " in spoken["message"]


def test_ingest_goes_on_after_a_restart(spark, folder):
    source, target, progress = f"{folder}/topic", f"{folder}/table", f"{folder}/progress"
    feed(messages(spark, envelope("c", after(1)), envelope("u", after(1))), source)
    changes.ingest(topic(spark, source), target, progress, once=True).awaitTermination()
    feed(messages(spark, envelope("c", after(2))), source)
    feed(messages(spark, envelope("c", after(3))), source)
    for _ in range(2):  # the second run finds nothing new
        changes.ingest(topic(spark, source), target, progress, once=True).awaitTermination()
    stored = tables.read_table(spark, target)
    assert sorted(r["activity_id"] for r in stored.collect()) == [1, 2, 3]
    assert dict(stored.dtypes)["distance_meters"] == "decimal(10,2)"
    assert dict(stored.dtypes)["start_datetime"] == "timestamp_ntz"


def test_latest_change_wins_across_and_within_batches(spark, folder):
    source, target = f"{folder}/topic", f"{folder}/table"
    changes.start_table(spark, target, spark.createDataFrame([], schemas.ACTIVITIES))

    def run():
        changes.apply_stream(
            topic(spark, source, maxFilesPerTrigger="1"),
            target,
            f"{folder}/progress",
            operations=("c", "u", "d", "r"),
            once=True,
        ).awaitTermination()

    def state():
        return {r["activity_id"]: r["sport_type"] for r in tables.read_published(spark, target).collect()}

    feed(
        messages(
            spark,
            envelope("c", after(1, sport_type="A")),
            envelope("u", after(1, sport_type="B")),
            envelope("c", after(2, sport_type="A")),
            envelope("c", after(3, sport_type="A")),
            envelope("d", None, {"activity_id": 3}),
        ),
        source,
    )
    run()
    assert state() == {1: "B", 2: "A"}
    feed(messages(spark, envelope("d", None, {"activity_id": 1}), envelope("c", after(3)), start=10), source)
    feed(messages(spark, envelope("u", after(2, sport_type="C")), start=20), source)
    run()
    assert state() == {2: "C", 3: "Running"}


def test_default_application_takes_creations_only_and_may_be_repeated(spark, folder):
    source, target = f"{folder}/topic", f"{folder}/table"
    changes.start_table(spark, target, spark.createDataFrame([], schemas.ACTIVITIES))
    feed(messages(spark, envelope("c", after(1)), envelope("u", after(2)), envelope("c", after(1))), source)
    for attempt in ("first", "second"):  # a fresh checkpoint hands the same batch over again
        changes.apply_stream(
            topic(spark, source), target, f"{folder}/progress-{attempt}", once=True
        ).awaitTermination()
        assert [r["activity_id"] for r in tables.read_published(spark, target).collect()] == [1]


def test_only_a_delete_deletes(spark):
    table = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "activity_id int, v string")
    batch = spark.createDataFrame(
        [(1, "new", None, 1), (2, "new", "d", 1), (None, "new", "c", 1), (4, "a", "c", 1), (4, "b", "u", 2)],
        "activity_id int, v string, operation string, offset int",
    )
    found = {r["activity_id"]: r["v"] for r in changes.applied(table, batch, order=["offset"]).collect()}
    assert found == {1: "new", 3: "old", 4: "b"}


def test_people_published_between_batches_are_found(spark, folder):
    source, out, unknown = (f"{folder}/{n}" for n in ("topic", "notes", "unknown"))
    names = "employee_id int, first_name string, last_name string"
    tables.publish(spark.createDataFrame([(7, "Ana", "Roux")], names), f"{folder}/people")

    def run(progress):
        notify_stream(
            topic(spark, source), lambda s: tables.read_published(s, f"{folder}/people"), out, unknown, progress, once=True
        ).awaitTermination()

    def notes(path):
        return sorted((r["activity_id"], r["first_name"]) for r in spark.read.parquet(path).collect())

    feed(messages(spark, envelope("c", after(1, employee_id=7)), envelope("c", after(2, employee_id=8))), source)
    run(f"{folder}/progress")
    assert notes(out) == [(1, "Ana")] and notes(unknown) == [(2, None)]
    tables.publish(spark.createDataFrame([(7, "Ana", "Roux"), (8, "Bo", "Lin")], names), f"{folder}/people")
    feed(messages(spark, envelope("c", after(3, employee_id=8)), start=10), source)
    run(f"{folder}/progress")
    assert notes(out) == [(1, "Ana"), (3, "Bo")]
    # A lost checkpoint hands everything over again, as batch 0: it replaces that batch.
    run(f"{folder}/other-progress")
    assert len([n for n in notes(out) if n[0] == 1]) == 1


def test_one_message_per_activity_whatever_the_topic_repeats(spark, folder):
    source, out, unknown = (f"{folder}/{n}" for n in ("topic", "notes", "unknown"))
    staff = spark.createDataFrame([(7, "Ana", "Roux")], "employee_id int, first_name string, last_name string")

    def run(progress="progress"):
        query = notify_stream(topic(spark, source), lambda s: staff, out, unknown, f"{folder}/{progress}", once=True)
        query.awaitTermination()

    def notes(path=out):
        return sorted(r["activity_id"] for r in spark.read.parquet(path).collect())

    one, two, lost = envelope("c", after(1)), envelope("c", after(2)), envelope("c", after(9, employee_id=99))
    feed(messages(spark, one, one, lost), source)
    run()
    feed(messages(spark, two, one, lost, start=10), source)
    run()  # after a restart
    feed(messages(spark, two, start=20), source)
    run()
    assert notes() == [1, 2] and notes(unknown) == [9]
    # A lost checkpoint: the new query reads everything again, loses nothing and repeats nothing.
    feed(messages(spark, envelope("c", after(3)), start=30), source)
    run("other-progress")
    assert notes() == [1, 2, 3] and notes(unknown) == [9]


def test_late_people_get_their_messages(spark, folder):
    source, out, unknown = (f"{folder}/{n}" for n in ("topic", "notes", "unknown"))
    names = "employee_id int, first_name string, last_name string"
    first, then = [(7, "Ana", "Roux")], [(7, "Ana", "Roux"), (8, "Bo", "Lin")]
    assert notify_late(spark, spark.createDataFrame(then, names), out, unknown) == 0
    feed(messages(spark, envelope("c", after(1)), envelope("c", after(2, employee_id=8, comment="Enfin")), envelope("c", after(3, employee_id=9))), source)
    staff = spark.createDataFrame(first, names)
    notify_stream(topic(spark, source), lambda s: staff, out, unknown, f"{folder}/progress", once=True).awaitTermination()
    staff = spark.createDataFrame(then, names)
    assert notify_late(spark, staff, out, unknown) == 1
    assert notify_late(spark, staff, out, unknown) == 0
    found = {r["activity_id"]: r["message"] for r in spark.read.parquet(out).collect()}
    assert sorted(found) == [1, 2]
    assert found[2] == "Bravo Bo Lin ! Tu viens de terminer une activité Running de 6.00 km en 46 min ! 🔥🏅\n💬 Enfin"


def test_failed_recomputation_is_tried_again(spark, folder):
    path, progress = f"{folder}/table", f"{folder}/progress"
    tables.publish(spark.range(1), path)
    seen = []

    def run(function, **options):
        recompute_on_change(
            version_stream(spark, path), function, progress, once=True, **options
        ).awaitTermination()

    def failing(_):
        seen.append("failed")
        raise RuntimeError("no luck")

    run(lambda s: seen.append("never"), adopt_current=True)
    assert seen == []  # what was there at first start counts as done
    run(lambda s: seen.append("never"), adopt_current=True)
    assert seen == []

    tables.publish(spark.range(2), path)
    with pytest.raises(StreamingQueryException):
        run(failing, adopt_current=True)
    tables.publish(spark.range(3), path)
    # The failed batch comes again, then the version that arrived meanwhile.
    run(lambda s: seen.append(tables.read_published(s, path).count()), adopt_current=True)
    assert seen == ["failed", 3, 3]
    run(lambda s: seen.append("never"), adopt_current=True)
    assert seen == ["failed", 3, 3]


def test_first_version_after_an_empty_start_is_recomputed(spark, folder):
    path, seen = f"{folder}/table", []

    def run():
        recompute_on_change(
            version_stream(spark, path),
            lambda s: seen.append(tables.read_published(s, path).count()),
            f"{folder}/progress",
            adopt_current=True,
            once=True,
        ).awaitTermination()

    run()  # there is no table yet
    assert seen == []
    tables.publish(spark.range(4), path)
    run()
    run()
    assert seen == [4]


def test_running_watch_picks_up_a_new_version(spark, folder):
    path, seen = f"{folder}/table", []
    tables.publish(spark.range(1), path)
    query = recompute_on_change(
        version_stream(spark, path),
        lambda s: seen.append(tables.read_published(s, path).count()),
        f"{folder}/progress",
        adopt_current=True,
        interval="1 second",
    )
    try:
        tables.publish(spark.range(2), path)
        query.processAllAvailable()
    finally:
        query.stop()
    assert seen == [2]


def test_several_versions_make_one_recomputation(spark, folder):
    path = f"{folder}/table"
    for n in (1, 2, 3):
        tables.publish(spark.range(n), path)
    seen = []
    recompute_on_change(
        version_stream(spark, path),
        lambda s: seen.append(tables.read_published(s, path).count()),
        f"{folder}/progress",
        once=True,
    ).awaitTermination()
    assert seen == [3]


def test_console_stream_runs(spark, folder):
    feed(messages(spark, envelope("c", after(1))), f"{folder}/topic")
    shown = changes.created_activities(topic(spark, f"{folder}/topic"))
    query = streams.show_stream(shown, f"{folder}/progress", once=True)
    query.awaitTermination()
    assert query.exception() is None


def test_broker_options():
    assert streams.broker_options("broker:9092", "t") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
    }
    assert streams.broker_options("b", "t", "earliest", 500)["maxOffsetsPerTrigger"] == "500"
