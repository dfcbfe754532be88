"""Change envelopes: decode, keep the wanted operations, apply without duplicates.

The functions take and return DataFrames and hold for batch and streaming input
alike. Decoding is stateless: one stage, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StringType, StructField, StructType

from perkline import fixed_values as fixed
from perkline.functions.decoding import connect_decimal, micros_to_timestamp
from perkline.operators.merging import change_catalog, rewrite_published
from perkline.schemas import envelope
from perkline.sources.streams import append_stream, each_batch
from perkline.sources.tables import Layout, publish, require_published

POSITION = ("partition", "offset")
UNPARSED = "_unparsed"
ACTIVITY_COLUMNS = (
    "activity_id",
    "employee_id",
    "start_datetime",
    "sport_type",
    "distance_meters",
    "end_datetime",
    "comment",
)


def parse_envelopes(
    messages: DataFrame, carry: Sequence[str] = (), id_type: DataType | None = None
) -> DataFrame:
    """``value`` bytes to ``payload.after.*`` and ``operation``, still in wire types.

    Text that is no JSON, a NULL value or an envelope without payload gives a row
    of NULLs. For a delete, the key is taken from ``before``. ``carry`` names
    columns of the message to keep, such as its position.
    """
    event = F.from_json(F.col("value").cast("string"), envelope(id_type))
    # A one-element explode: later filters stay above it, so that the text is parsed
    # once per message and not once more for every use in a filter.
    parsed = messages.select(*carry, F.explode(F.array(event)).alias("event"))
    old_id, operation = F.col("event.payload.before.activity_id"), F.col("event.payload.op")
    new_id = F.col("event.payload.after.activity_id")
    return parsed.select(
        *carry,
        F.when(operation == fixed.OP_DELETE, F.coalesce(new_id, old_id)).otherwise(new_id).alias(
            "activity_id"
        ),
        *[F.col(f"event.payload.after.{c}").alias(c) for c in ACTIVITY_COLUMNS[1:]],
        operation.alias("operation"),
    )


def dead_letters(messages: DataFrame, carry: Sequence[str] = (), id_type: DataType | None = None) -> DataFrame:
    """Messages that say nothing about a row: ``value`` as it came, the ``carry`` columns and the ``reason``.

    ``no value`` (NULL, as after a compaction), ``no JSON`` (or values of other types), ``no payload``, ``unknown operation``, ``no key``. Together with
    :func:`only` for all operations these are all messages, each once. Batch and streaming alike.
    """
    schema = StructType([*envelope(id_type).fields, StructField(UNPARSED, StringType())])
    text = F.col("value").cast("string")
    event = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNPARSED})
    parsed = messages.select("value", *carry, F.explode(F.array(event)).alias("event"))
    operation, new_id = F.col("event.payload.op"), F.col("event.payload.after.activity_id")
    key = F.when(operation == fixed.OP_DELETE, F.coalesce(new_id, F.col("event.payload.before.activity_id"))).otherwise(new_id)
    known = operation.isin(fixed.OP_CREATE, fixed.OP_UPDATE, fixed.OP_DELETE, fixed.OP_SNAPSHOT)
    reason = (
        F.when(F.col("value").isNull(), "no value")
        .when(F.col(f"event.{UNPARSED}").isNotNull() | F.col("event").isNull(), "no JSON")
        .when(F.col("event.payload").isNull(), "no payload")
        .when(~F.coalesce(known, F.lit(False)), "unknown operation")
        .when(key.isNull(), "no key")
    )
    return parsed.select("value", *carry, reason.alias("reason")).filter("reason IS NOT NULL")


def set_aside(
    messages: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False, id_type: DataType | None = None
) -> StreamingQuery:
    """Append the dead letters of a topic to a table of their own, each once, next to :func:`ingest`."""
    carry = [c for c in ("topic", *POSITION, "timestamp") if c in messages.columns]
    return append_stream(dead_letters(messages, carry, id_type), path, checkpoint, fmt, once)


def only(changes: DataFrame, operations: Sequence[str] = (fixed.OP_CREATE,)) -> DataFrame:
    """Changes of the wanted kinds that name a row; what cannot be decoded is in :func:`dead_letters`."""
    return changes.filter(
        F.col("operation").isin(*operations) & F.col("activity_id").isNotNull()
    )


def typed(
    changes: DataFrame,
    extra: Sequence[str] = (),
    whole_seconds: bool = False,
    keep_encoded: bool = False,
) -> DataFrame:
    """Wire types to table types. ``whole_seconds`` drops fractions of a second;
    ``keep_encoded`` keeps the distance as it travelled in ``encoded_distance``."""
    columns: list[Column] = [
        F.col("activity_id"),
        F.col("employee_id"),
        micros_to_timestamp(F.col("start_datetime"), whole_seconds).alias("start_datetime"),
        F.col("sport_type"),
        connect_decimal(F.col("distance_meters")).alias("distance_meters"),
        micros_to_timestamp(F.col("end_datetime"), whole_seconds).alias("end_datetime"),
        F.col("comment"),
    ]
    if keep_encoded:
        columns.append(F.col("distance_meters").alias("encoded_distance"))
    return changes.select(*columns, *extra)


def created_activities(
    messages: DataFrame, whole_seconds: bool = False, id_type: DataType | None = None
) -> DataFrame:
    """Typed rows of the creations in a topic: the rows an ingest appends."""
    return typed(only(parse_envelopes(messages, id_type=id_type)), whole_seconds=whole_seconds)


def ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    once: bool = False,
    whole_seconds: bool = False,
    id_type: DataType | None = None,
) -> StreamingQuery:
    """Append the creations of a topic to a table; a restart goes on where it stopped."""
    return append_stream(
        created_activities(messages, whole_seconds, id_type), path, checkpoint, fmt, once
    )


# --- Applying changes to a table ------------------------------------------------


def latest_per_key(changes: DataFrame, key: str, order: Sequence[str] = POSITION) -> DataFrame:
    """The last change of every key.

    A maximum per key, taken in the map tasks first: they sort their own rows (and may
    spill), and pass on one row per key, so a key with very many changes does not
    gather in one task. ``order`` must be different for all changes of one key.
    """
    whole = F.struct(*changes.columns)
    newest = changes.groupBy(F.col(key).alias("_key")).agg(
        F.max_by(whole, F.struct(*order)).alias("_row")
    )
    return newest.select("_row.*")


def applied(
    table: DataFrame, changes: DataFrame, key: str = "activity_id", order: Sequence[str] = POSITION
) -> DataFrame:
    """Table after the changes: last change per key wins, deletes remove, NULL keys are ignored.

    ``changes`` has the table's columns, ``operation`` and the ``order`` columns.
    """
    known = changes.filter(F.col(key).isNotNull())
    # Which rows go needs the bare keys; only what comes needs the last changes.
    kept = table.join(known.select(key).distinct(), key, "left_anti")
    written = latest_per_key(known, key, order).filter(~F.col("operation").eqNullSafe(fixed.OP_DELETE))
    return kept.select(*table.columns).unionByName(written.select(*table.columns))


def applied_latest(table: DataFrame, last: DataFrame, key: str = "activity_id") -> DataFrame:
    """The same for changes that are already one per key."""
    kept = table.join(last.select(key), key, "left_anti")
    written = last.filter(~F.col("operation").eqNullSafe(fixed.OP_DELETE))
    return kept.select(*table.columns).unionByName(written.select(*table.columns))


def apply_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    operations: Sequence[str] = (fixed.OP_CREATE,),
    order: Sequence[str] = POSITION,
    catalog_table: str | None = None,
    once: bool = False,
    interval: str | None = None,
    id_type: DataType | None = None,
) -> StreamingQuery:
    """Keep a published table in step with a topic.

    A batch that is handed over twice gives the same table, so a restart neither
    loses nor repeats a change. Every batch rewrites the buckets that it touches, or all
    of a table without layout: give the table as many buckets as make one cheap to
    rewrite (:func:`start_table`), and an ``interval``. A ``catalog_table`` whose format has row-level
    updates takes the changes natively. If another writer publishes meanwhile, the
    query ends with ``CommitConflict`` and the next start applies the batch to what is there then.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        changes = typed(
            only(parse_envelopes(batch, order, id_type), operations), ("operation", *order)
        )
        last = latest_per_key(changes, "activity_id", order).persist()
        try:
            # Counted first, so that the planner knows the measured size of the batch
            # and need not shuffle a large table to meet a small batch.
            last.count()
            if catalog_table is not None:
                change_catalog(last, catalog_table, "activity_id", ACTIVITY_COLUMNS, fixed.OP_DELETE)
            else:
                session = batch.sparkSession
                snapshot = require_published(session, path)
                rewrite_published(
                    session, snapshot, last, ["activity_id"], lambda rows: applied_latest(rows, last)
                )
        finally:
            last.unpersist()

    return each_batch(messages, on_batch, checkpoint, once, interval)


def start_table(
    spark: SparkSession, path: str, like: DataFrame, buckets: int | None = None, key: str = "activity_id"
) -> int:
    """Publish an empty first version with the columns of ``like``, laid out by ``key`` in so many ``buckets``."""
    layout = None if buckets is None else Layout((key,), buckets)
    return publish(like.filter(F.lit(False)), path, layout=layout)
