"""Streaming reads and appends. The format is an argument: files can stand in for a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def broker_options(
    servers: str, topic: str, starting: str = "latest", per_trigger: int | None = None
) -> dict[str, str]:
    """Options of a topic read. ``starting`` matters on the first run only: later
    runs go on from the offsets in the checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    return read_stream(spark, "kafka", **broker_options(servers, topic, starting))


def _start(writer, path: str | None, once: bool) -> StreamingQuery:
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path is not None else writer.start()


def append_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False
) -> StreamingQuery:
    """Append to a table. ``once`` takes what is there now and ends; otherwise the
    query runs until it is stopped."""
    writer = (
        df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    )
    return _start(writer, path, once)


def show_stream(df: DataFrame, checkpoint: str | None = None, once: bool = False) -> StreamingQuery:
    """Print arriving rows in full, for looking at a topic."""
    writer = df.writeStream.format("console").outputMode("append").option("truncate", "false")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return _start(writer, None, once)


def each_batch(
    df: DataFrame, function, checkpoint: str, once: bool = False, interval: str | None = None
) -> StreamingQuery:
    """Hand every micro-batch to ``function(batch, batch_id)``; progress is recorded
    only after it returns, so a batch that failed is handed over again."""
    writer = df.writeStream.foreachBatch(function).option("checkpointLocation", checkpoint)
    if interval is not None and not once:
        writer = writer.trigger(processingTime=interval)
    return _start(writer, None, once)
