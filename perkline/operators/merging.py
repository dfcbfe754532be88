"""Upserts and deletes.

``merged`` and ``without_keys`` say what the table looks like afterwards and are
plain DataFrames. ``merge_published``/``delete_published`` apply them to a
published table, of which only the buckets that hold a key of the source are read and
written where it is laid out by (some of) the keys; ``merge_catalog``/``delete_catalog`` hand
the same to a catalog table whose format has row-level updates and rewrites only the
files it touches. A version that another writer publishes meanwhile raises
``CommitConflict``: the result was not computed from it.

A source may be in use while it is read, so what is checked and merged is one
stored copy of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from perkline.operators.checks import require_unique
from perkline.session import shared_dir
from perkline.sources.tables import (
    Layout,
    Snapshot,
    publish,
    publish_buckets,
    published_version,
    require_published,
    touched_buckets,
)


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Table after: matched keys take the source's values, new keys are added, the rest stays.

    ``update`` limits which columns a match changes; unlisted ones keep the target's
    value, and new rows have NULL where the source lacks a column. ``source`` has
    one row per key. NULL keys match nothing.
    """
    keys = list(keys)
    if update is None:
        # Whole rows are replaced: target rows without a successor, plus the source.
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.select(*target.columns).unionByName(source.select(*target.columns))

    unknown = set(update) - set(source.columns)
    if unknown:
        raise ValueError(f"source lacks columns to update: {sorted(unknown)}")
    old, new = target.alias("old"), source.withColumn("_matched", F.lit(True)).alias("new")
    changed = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "left").select(
        *[
            F.when(F.col("new._matched"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            if c in update
            else F.col(f"old.{c}").alias(c)
            for c in target.columns
        ]
    )
    # Which keys were there already is asked from the target side: next to a small
    # source neither this nor the join above moves the target's rows.
    present = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    added = source.join(present, keys, "left_anti")
    added = added.select(
        *[
            F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    return changed.unionByName(added)


def without_keys(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table after deleting the keys in ``doomed``."""
    return target.join(doomed.select(*keys), list(keys), "left_anti").select(*target.columns)


def with_keys(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows such a delete would remove, for a look beforehand."""
    return target.join(doomed.select(*keys), list(keys), "left_semi").select(*target.columns)


def copied(source: DataFrame) -> DataFrame:
    """``source`` read once and stored: later reads find the same rows, whatever happens to the source."""
    path = shared_dir(source.sparkSession, "merge-source")
    source.write.parquet(path)
    return source.sparkSession.read.schema(source.schema).parquet(path)


def _by_bucket(snapshot: Snapshot, keys: Sequence[str]) -> bool:
    """Rows with equal keys lie in one bucket."""
    return snapshot.layout is not None and set(snapshot.layout.keys) <= set(keys)


def rewrite_published(
    spark: SparkSession,
    snapshot: Snapshot,
    changes: DataFrame,
    keys: Sequence[str],
    after: Callable[[DataFrame], DataFrame],
    check: Callable[[DataFrame], None] | None = None,
    notes: dict[str, object] | None = None,
) -> int:
    """Publish ``after(rows)``, which may differ from ``rows`` only where a key of ``changes`` is.

    ``rows`` are those of the buckets of these keys, or the whole table if its layout does not tell them.
    """
    if not _by_bucket(snapshot, keys):
        return publish(after(snapshot.read(spark)), snapshot.path, check=check, after=snapshot.version, notes=notes)
    # Types decide the hash, so the keys are asked in the types of the table.
    asked = changes.select(*[F.col(k).cast(snapshot.schema[k].dataType).alias(k) for k in snapshot.layout.keys])
    touched = touched_buckets(snapshot.layout, asked)
    return publish_buckets(snapshot, after(snapshot.read(spark, buckets=touched)), touched, check=check, notes=notes)


def merge_published(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> int:
    """Upsert into a published table and return its new version.

    Refuses a source with a repeated key, a table that was never published, and a
    result with a repeated key. Repeating the call with the same source changes nothing.
    A table that is laid out by key keeps its columns' types; a value that does not fit raises.
    """
    snapshot = require_published(spark, path)
    if _by_bucket(snapshot, keys):
        types = {f.name: f.dataType for f in snapshot.schema.fields}
        source = source.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in source.columns])
    source = copied(source)
    require_unique(source, keys, "merge source")
    return rewrite_published(
        spark,
        snapshot,
        source,
        keys,
        lambda rows: merged(rows, source, keys, update),
        check=lambda rows: require_unique(rows, keys, "merged table"),
    )


def load_or_merge_published(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    buckets: int | None = None,
) -> int:
    """The same, where the table may not exist yet: then the source is its first version, laid out
    by the keys if a number of ``buckets`` is given."""
    if published_version(spark, path) is not None:
        return merge_published(spark, path, source, keys, update)
    layout = None if buckets is None else Layout(tuple(keys), buckets)
    return publish(source, path, check=lambda rows: require_unique(rows, keys, "first load"), after=0, layout=layout)


def delete_published(
    spark: SparkSession, path: str, doomed: DataFrame, keys: Sequence[str]
) -> int:
    snapshot = require_published(spark, path)
    doomed = copied(doomed.select(*keys).distinct())
    return rewrite_published(spark, snapshot, doomed, keys, lambda rows: without_keys(rows, doomed, keys))


def _matching(source: DataFrame, table: str, keys: Sequence[str]):
    same = [F.col(f"source.{k}") == F.col(f"{table}.{k}") for k in keys]
    return source.alias("source").mergeInto(table, reduce(lambda a, b: a & b, same))


def merge_catalog(
    source: DataFrame, table: str, keys: Sequence[str], update: Sequence[str] | None = None
) -> None:
    """The same upsert as a native MERGE, for table formats that offer it."""
    source = copied(source)
    require_unique(source, keys, "merge source")
    merge = _matching(source, table, keys)
    if update is None:
        merge = merge.whenMatched().updateAll()
    else:
        merge = merge.whenMatched().update({c: F.col(f"source.{c}") for c in update})
    merge.whenNotMatched().insertAll().merge()


def delete_catalog(doomed: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Delete the keys in ``doomed`` natively."""
    doomed = doomed.select(*keys).distinct()
    _matching(doomed, table, keys).whenMatched().delete().merge()


def change_catalog(last: DataFrame, table: str, key: str, columns: Sequence[str], delete: str) -> None:
    """Apply changes that are one per key, natively: those with ``operation`` equal to ``delete`` remove
    their row, the others replace or add it."""
    gone = F.col("source.operation") == delete
    values = {c: F.col(f"source.{c}") for c in columns}
    merge = _matching(last, table, [key]).whenMatched(gone).delete()
    merge.whenMatched().update(values).whenNotMatched(~gone).insert(values).merge()
