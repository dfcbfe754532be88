"""Congratulation messages for new activities, as rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from perkline import fixed_values as fixed
from perkline.functions.texts import distance_text, duration_text, message_text
from perkline.sources.streams import each_batch
from perkline.sources.tables import file_system
from perkline.streaming.changes import only, parse_envelopes, typed

PERSON = ("first_name", "last_name")
NOTE = (
    "activity_id",
    "employee_id",
    *PERSON,
    "sport_type",
    "start_text",
    "end_text",
    "duration_text",
    "distance_text",
    "message",
)


def creations(messages: DataFrame, id_type: DataType | None = None) -> DataFrame:
    """Typed rows of the creations in a topic, with the distance as it travelled."""
    return typed(only(parse_envelopes(messages, id_type=id_type)), keep_encoded=True)


def described(new: DataFrame, say_missing_distance: bool = False) -> DataFrame:
    """Creations with the texts of their message that do not depend on the person, and the comment."""
    distance = distance_text(F.col("distance_meters"), F.col("encoded_distance"))
    if not say_missing_distance:
        distance = F.when(F.col("encoded_distance").isNotNull(), distance)
    return new.select(
        "activity_id",
        "employee_id",
        "sport_type",
        F.date_format("start_datetime", fixed.DISPLAY_TIMESTAMP).alias("start_text"),
        F.date_format("end_datetime", fixed.DISPLAY_TIMESTAMP).alias("end_text"),
        duration_text(F.col("start_datetime"), F.col("end_datetime")).alias("duration_text"),
        distance.alias("distance_text"),
        "comment",
    )


def addressed(texts: DataFrame, employees: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Described creations with the person's names and the message, and the comment as last column."""
    names = employees.select("employee_id", *PERSON)
    found = texts.join(names, "employee_id", "left" if keep_unknown else "inner")
    parts = (*PERSON, "sport_type", "duration_text", "distance_text", "comment")
    return found.withColumn("message", message_text(*[F.col(c) for c in parts])).select(*NOTE, "comment")


def notifications(
    messages: DataFrame,
    employees: DataFrame,
    say_missing_distance: bool = False,
    id_type: DataType | None = None,
    keep_unknown: bool = False,
) -> DataFrame:
    """One message per creation of a known employee; batch and streaming alike.

    A row without distance says nothing about it, or ``Distance non renseignée``
    with ``say_missing_distance``. ``keep_unknown`` keeps creations of people who are
    not there, with NULL as message. The employee side is one row per id and is
    broadcast only if its size allows, and otherwise a busy employee's creations are
    split by the adaptive join; the join keeps no state.
    """
    texts = described(creations(messages, id_type), say_missing_distance)
    return addressed(texts, employees, keep_unknown).drop("comment")


def notify_stream(
    messages: DataFrame,
    employees: Callable[[SparkSession], DataFrame],
    path: str,
    unknown_path: str,
    checkpoint: str,
    once: bool = False,
    interval: str | None = None,
    id_type: DataType | None = None,
    repeats_within: str = "7 days",
) -> StreamingQuery:
    """Write one message per activity to ``path``, and creations of unknown people to ``unknown_path``.

    ``employees`` is asked anew for every batch, so people who are published while the
    query runs are found. A creation that the topic delivers again within ``repeats_within`` of its first
    arrival here is left out, in whatever batch it comes: its key is state of the query, which
    forgets it afterwards. Arrival is the time of the batch, so nothing can be too late.

    A batch writes a folder ``query=…/batch_id=…``, which appears whole and stays as it is if the
    batch is handed over again. A query with a new checkpoint has folders of its own; what an earlier query
    has written is not written again. Creations of unknown people become messages with :func:`notify_late`.
    """
    arriving = creations(messages, id_type).withColumn("_arrived", F.current_timestamp())
    new = arriving.withWatermark("_arrived", repeats_within).dropDuplicatesWithinWatermark(["activity_id"])

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = _query_id(spark, checkpoint)
        texts = described(batch.drop("_arrived"))
        for folder in (unknown_path, path):
            earlier = _written(spark, folder, but=query)
            if earlier is not None:
                texts = texts.join(earlier, "activity_id", "left_anti")
        notes = addressed(texts, employees(spark), keep_unknown=True).persist()
        try:
            known = F.col("message").isNotNull()
            # Unknown ones first: who becomes known between two attempts of a batch is then in both folders, not in neither.
            _write_once(notes.filter(~known), f"{unknown_path}/query={query}", f"batch_id={batch_id}")
            _write_once(notes.filter(known).drop("comment"), f"{path}/query={query}", f"batch_id={batch_id}")
        finally:
            notes.unpersist()

    return each_batch(new, on_batch, checkpoint, once, interval)


def notify_late(
    spark: SparkSession, employees: DataFrame, path: str, unknown_path: str
) -> int:
    """Messages for creations whose people were unknown when they arrived and are known now; returns their number.

    An activity that has a message gets no second one, so this may be repeated; let one run at a time.
    """
    parked = _read(spark, unknown_path)
    if parked is None:
        return 0
    due = addressed(parked.drop(*PERSON, "message", "query", "batch_id"), employees)
    sent = _written(spark, path)
    if sent is not None:
        due = due.join(sent, "activity_id", "left_anti")
    due = due.dropDuplicates(["activity_id"]).drop("comment").persist()
    try:
        found = due.count()
        if found:
            _write_once(due, f"{path}/query=late", f"batch_id={uuid.uuid4().hex}")
        return found
    finally:
        due.unpersist()


# --- Folders of batches -------------------------------------------------------------


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps as long as its checkpoint lives."""
    fs, new_path = file_system(spark, checkpoint)
    stream = fs.open(new_path(f"{checkpoint}/metadata"))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def _write_once(rows: DataFrame, folder: str, name: str) -> None:
    """Rows in ``folder/name``, which appears whole; nothing happens if it is there."""
    fs, new_path = file_system(rows.sparkSession, folder)
    target = new_path(f"{folder}/{name}")
    if fs.exists(target):
        return
    # A name that starts with a dot is no data for any reader.
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    rows.write.parquet(draft)
    if not fs.rename(new_path(draft), target):
        raise RuntimeError(f"could not move {draft} to {target}")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    fs, new_path = file_system(spark, path)
    if not fs.globStatus(new_path(f"{path}/query=*/batch_id=*")):
        return None
    return spark.read.option("basePath", path).option("mergeSchema", "false").parquet(f"{path}/query=*/batch_id=*")


def _written(spark: SparkSession, path: str, but: str | None = None) -> DataFrame | None:
    """The activities in ``path``, of which only the ids are read; ``but`` is a query that does not count."""
    fs, new_path = file_system(spark, path)
    queries = {f.getPath().getName().partition("=")[2] for f in fs.globStatus(new_path(f"{path}/query=*")) or []}
    rows = _read(spark, path) if queries - {but} else None
    if rows is None:
        return None
    return rows.filter(F.col("query") != F.lit(but or "")).select("activity_id")
