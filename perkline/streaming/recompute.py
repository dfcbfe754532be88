"""Recompute results whenever a table changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from perkline.sources.streams import each_batch, read_stream
from perkline.sources.tables import commits_path

INTERVAL = "10 seconds"


def version_stream(spark: SparkSession, path: str) -> DataFrame:
    """A published table's versions as a stream: one small row each, not the table's rows.

    The folder is given as a pattern, so that the stream may start before the first version.
    """
    commits = commits_path(path)
    return read_stream(spark, "json", f"{commits[:-1]}[{commits[-1]}]", "folder string, version int")


def _started_before(spark: SparkSession, checkpoint: str) -> bool:
    try:
        return not spark.read.text(f"{checkpoint}/metadata").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def recompute_on_change(
    changes: DataFrame,
    recompute: Callable[[SparkSession], None],
    checkpoint: str,
    adopt_current: bool = False,
    once: bool = False,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Run ``recompute`` once for each batch of changes.

    Progress is recorded only after ``recompute`` returned. If it raises, the query
    ends and the next start runs the same batch again, so no change is skipped; it
    may therefore run twice for one change and must replace its results, not add
    to them. Changes that arrive meanwhile are taken together by the next run.
    With ``adopt_current`` the very first start takes what is there at that moment
    as already done; if nothing is there yet, the first change is recomputed.
    """
    if adopt_current and not _started_before(changes.sparkSession, checkpoint):
        each_batch(changes, lambda batch, batch_id: None, checkpoint, once=True).awaitTermination()

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        recompute(batch.sparkSession)

    return each_batch(changes, on_batch, checkpoint, once, interval)
