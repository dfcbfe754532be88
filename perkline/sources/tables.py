"""Tables on shared storage.

Plain reads and writes take the format as an argument (``parquet``, ``delta``, …).
The *published* functions give a file format without a table log the one thing an
upsert needs: readers see the old rows or the new rows, never a mixture. Every
publication writes a new folder and then one small commit record that names it,
and the columns. The record appears under its version's name all at once and only if
no other writer took that version; a job that dies before leaves readers on the
previous version and later writers unhindered. What is computed from a version is
published *after* that version or not at all.

A table may be laid out in buckets by the hash of its key. Then a writer who knows
which keys change rewrites only the buckets that hold them; the record names for
each bucket the folder of the version that wrote it last.

Records exclude each other where a rename does not replace a file, as on HDFS and local
disks. On object stores whose rename replaces (``s3a``) let one writer at a time publish a table.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, NumericType, StructType


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    replace_schema: bool = False,
    **options: str,
) -> None:
    """Batch write. ``replace_schema`` lets a log-based format change its columns."""
    if replace_schema:
        options["overwriteSchema"] = "true"
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def commits_path(path: str) -> str:
    return f"{path}/commits"


class CommitConflict(RuntimeError):
    """Another writer published the version first. Nothing was changed; the job may be repeated."""


def file_system(spark: SparkSession, path: str):
    """The cluster's own file system interface for ``path``, and its path type."""
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return new_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), new_path


@dataclass(frozen=True)
class Layout:
    """Rows lie in ``count`` buckets by the hash of ``keys``."""

    keys: tuple[str, ...]
    count: int

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """One published version: its folder, or with a layout the folder of every bucket that has rows."""

    path: str
    version: int
    folder: str
    schema: StructType | None = None
    layout: Layout | None = None
    buckets: dict[int, str] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)

    def read(self, spark: SparkSession, fmt: str = "parquet", buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets. No other files are opened."""
        if self.layout is None:
            return spark.read.format(fmt).load(f"{self.path}/data/{self.folder}")
        wanted = sorted(self.buckets if buckets is None else set(buckets) & set(self.buckets))
        if not wanted:
            return spark.createDataFrame([], self.schema)
        places = [f"{self.path}/data/{self.buckets[b]}/{BUCKET}={b}" for b in wanted]
        return spark.read.format(fmt).schema(self.schema).load(places)


BUCKET = "_bucket"


def _records(spark: SparkSession, path: str) -> list[tuple[int, object]]:
    """Versions and the paths of their records, from file names alone."""
    fs, new_path = file_system(spark, path)
    found = fs.globStatus(new_path(f"{commits_path(path)}/[0-9]*.json")) or []
    return sorted(((int(r.getPath().getName().partition(".")[0]), r.getPath()) for r in found), key=lambda r: r[0])


def published_snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest version or the given one; None if there is none. No Spark job."""
    records = [r for r in _records(spark, path) if version is None or r[0] == version]
    if not records:
        return None
    fs, _ = file_system(spark, path)
    stream = fs.open(records[-1][1])
    try:
        record = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    layout, schema = record.get("layout"), record.get("schema")
    return Snapshot(
        path,
        record["version"],
        record["folder"],
        None if schema is None else StructType.fromJson(schema),
        None if layout is None else Layout(tuple(layout["keys"]), layout["count"]),
        {int(b): f for f, numbers in record.get("buckets", {}).items() for b in numbers},
        record.get("notes", {}),
    )


def _commit(spark: SparkSession, path: str, version: int, folder: str, **more: object) -> None:
    """Make the record appear whole, unless the version has one."""
    fs, new_path = file_system(spark, path)
    commits = commits_path(path)
    fs.mkdirs(new_path(commits))
    name = f"{version:012d}.json"
    # A name that starts with a dot is no record for any reader.
    draft, record = new_path(f"{commits}/.{uuid.uuid4().hex}"), new_path(f"{commits}/{name}")
    stream = fs.create(draft, False)
    try:
        text = json.dumps({"folder": folder, "version": version, **more})
        stream.write(bytearray(text + "\n", "utf-8"))
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":
            # A local rename would replace an existing record; a link does not.
            os.link(draft.toUri().getPath(), record.toUri().getPath())
        elif fs.exists(record) or not fs.rename(draft, record):
            raise FileExistsError(name)
    except FileExistsError:
        raise CommitConflict(f"version {version} of {path} was published by another writer") from None
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def published_version(spark: SparkSession, path: str) -> int | None:
    records = _records(spark, path)
    return records[-1][0] if records else None


def require_published(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    found = published_snapshot(spark, path, version)
    if found is None:
        what = "published version" if version is None else f"version {version}"
        raise FileNotFoundError(f"no {what} in {path}")
    return found


def read_published(
    spark: SparkSession, path: str, fmt: str = "parquet", version: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """The newest published version, or the given one. Its files are never rewritten.

    With a ``schema`` the rows come in its columns, as :func:`conformed` says: so a reader of today sees
    a version of long ago.
    """
    rows = require_published(spark, path, version).read(spark, fmt)
    return rows if schema is None else conformed(rows, schema)


# --- Columns that change ----------------------------------------------------------

#: Each type may become a later one of its line without losing a value.
WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("tinyint", "smallint", "int", "double"))
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


class SchemaConflict(ValueError):
    """A column's type cannot become the new one without losing values."""


def widens(old: DataType, new: DataType) -> bool:
    """Every value of ``old`` is one of ``new``."""
    if old == new:
        return True
    a, b = old.simpleString(), new.simpleString()
    if isinstance(new, DecimalType) and isinstance(old, NumericType):
        whole, scale = (old.precision - old.scale, old.scale) if isinstance(old, DecimalType) else (_DIGITS.get(a, 99), 0)
        return new.precision - new.scale >= whole and new.scale >= scale
    return any(a in line and b in line and line.index(a) < line.index(b) for line in WIDER)


def conformed(rows: DataFrame, schema: StructType) -> DataFrame:
    """``rows`` in the columns of ``schema``: missing ones are NULL, narrower ones are widened, others left out.

    A column that cannot be widened raises :class:`SchemaConflict` before anything is read.
    """
    old = {f.name: f.dataType for f in rows.schema.fields}
    columns = []
    for new in schema.fields:
        if new.name not in old:
            columns.append(F.lit(None).cast(new.dataType).alias(new.name))
            continue
        if not widens(old[new.name], new.dataType):
            raise SchemaConflict(f"{new.name}: {old[new.name].simpleString()} to {new.dataType.simpleString()}")
        columns.append(F.col(f"`{new.name}`").cast(new.dataType).alias(new.name))
    return rows.select(*columns)


def schema_changes(old: StructType, new: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, change, old type, new type)`` of every column that is added, dropped, widened or incompatible."""
    before, after = ({f.name: f.dataType for f in s.fields} for s in (old, new))
    found = []
    for name in dict.fromkeys([*before, *after]):
        a, b = before.get(name), after.get(name)
        if a is None or b is None:
            change = "added" if a is None else "dropped"
        elif a != b:
            change = "widened" if widens(a, b) else "incompatible"
        else:
            continue
        found.append((name, change, a and a.simpleString(), b and b.simpleString()))
    return found


# --- Publishing -------------------------------------------------------------------


def publish(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    check: Callable[[DataFrame], None] | None = None,
    after: int | None = None,
    layout: Layout | None = None,
    replace_schema: bool = False,
    notes: dict[str, object] | None = None,
    counters: dict[str, Column] | None = None,
    judge: Callable[[dict[str, object]], None] | None = None,
) -> int:
    """Replace the whole table by ``df``, which may be computed from the table itself.

    ``check`` looks at the written rows and raises to keep them from being published. ``after`` is the
    version ``df`` was computed from (0: none): if another one has appeared since,
    :class:`CommitConflict` is raised. A table with a layout keeps it unless another is given. Columns may be added,
    widened and dropped; any other change of a type is refused unless ``replace_schema`` is set. ``notes`` are
    kept in the record, such as the versions that ``df`` was made from.

    ``counters`` are aggregates taken by the write itself, while the rows pass: nothing is read again. ``judge`` gets their
    values and raises to keep the rows from being published; the record keeps them under ``counters`` in its notes.
    """
    spark = df.sparkSession
    old = published_snapshot(spark, path)
    if after is None:
        after = 0 if old is None else old.version
    _require_newest(path, old, after)
    if old is not None:
        layout = layout or old.layout
        if old.schema is not None and not replace_schema:
            broken = [c for c in schema_changes(old.schema, df.schema) if c[1] == "incompatible"]
            if broken:
                raise SchemaConflict(f"{path}: {broken}")
    version = after + 1
    folder = f"{version:08d}-{uuid.uuid4().hex}"
    seen = Observation() if counters else None
    if seen is not None:
        df = df.observe(seen, *[c.alias(name) for name, c in counters.items()])

    def counted() -> dict[str, object]:
        if seen is None:
            return dict(notes or {})
        if judge is not None:
            judge(seen.get)
        return {**(notes or {}), "counters": {n: v if isinstance(v, int | bool) else str(v) for n, v in seen.get.items()}}

    if layout is None:
        write_table(df, f"{path}/data/{folder}", "errorifexists", fmt, partition_by)
        notes = counted()
        if check is not None:
            check(spark.read.format(fmt).load(f"{path}/data/{folder}"))
        _commit(spark, path, version, folder, schema=df.schema.jsonValue(), notes=notes)
        return version
    if partition_by:
        raise ValueError("a table is laid out by key or partitioned by columns, not both")
    empty = Snapshot(path, after, folder, df.schema, layout)
    return _publish_buckets(empty, df, range(layout.count), folder, fmt, check, counted)


def publish_buckets(
    snapshot: Snapshot,
    df: DataFrame,
    touched: Sequence[int],
    fmt: str = "parquet",
    check: Callable[[DataFrame], None] | None = None,
    notes: dict[str, object] | None = None,
) -> int:
    """Replace the rows of some buckets of a version by ``df``, which has all rows they will have.

    The files of other buckets are neither read nor written: the new version names them again.
    """
    _require_newest(snapshot.path, published_snapshot(df.sparkSession, snapshot.path), snapshot.version)
    folder = f"{snapshot.version + 1:08d}-{uuid.uuid4().hex}"
    return _publish_buckets(snapshot, conformed(df, snapshot.schema), touched, folder, fmt, check, lambda: notes or {})


def _require_newest(path: str, newest: Snapshot | None, version: int) -> None:
    """Early, before anything is written; the commit makes sure of it."""
    now = 0 if newest is None else newest.version
    if now != version:
        raise CommitConflict(f"{path} is at version {now}, not {version}: another writer was faster")


def _publish_buckets(
    old: Snapshot,
    df: DataFrame,
    touched: Iterable[int],
    folder: str,
    fmt: str,
    check: Callable[[DataFrame], None] | None,
    counted: Callable[[], dict[str, object]],
) -> int:
    spark, path = df.sparkSession, old.path
    touched = set(touched)
    # Rows of a bucket meet in few tasks, so that a bucket is few files; the planner splits a large one.
    placed = df.withColumn(BUCKET, old.layout.bucket()).hint("rebalance", BUCKET)
    write_table(placed, f"{path}/data/{folder}", "errorifexists", fmt, (BUCKET,))
    notes = counted()
    fs, new_path = file_system(spark, path)
    found = fs.globStatus(new_path(f"{path}/data/{folder}/{BUCKET}=*")) or []
    written = {int(d.getPath().getName().partition("=")[2]) for d in found}
    if not written <= touched:
        raise ValueError(f"rows of other buckets than those to replace: {sorted(written - touched)[:10]}")
    buckets = {b: f for b, f in old.buckets.items() if b not in touched} | dict.fromkeys(written, folder)
    new = Snapshot(path, old.version + 1, folder, old.schema, old.layout, buckets)
    if check is not None:
        check(new.read(spark, fmt, written))
    named: dict[str, list[int]] = {}
    for bucket, place in sorted(buckets.items()):
        named.setdefault(place, []).append(bucket)
    layout = {"keys": list(old.layout.keys), "count": old.layout.count}
    schema = old.schema.jsonValue()
    _commit(spark, path, new.version, folder, schema=schema, layout=layout, buckets=named, notes=notes)
    return new.version


def changed_rows(spark: SparkSession, old: Snapshot | None, new: Snapshot) -> DataFrame:
    """What differs between two versions: the table's rows with ``_times``, how often a row came (above 0) or went (below).

    Buckets that both versions have from the same folder are not read.
    """
    if old is None:
        return new.read(spark).withColumn("_times", F.lit(1).cast("long"))
    wanted = None
    if old.layout is not None and old.layout == new.layout:
        wanted = [b for b in {*old.buckets, *new.buckets} if old.buckets.get(b) != new.buckets.get(b)]
    elif old.layout is None and new.layout is None and old.folder == new.folder:
        return new.read(spark).withColumn("_times", F.lit(1).cast("long")).filter(F.lit(False))
    came = new.read(spark, buckets=wanted if new.layout is not None else None)
    went = conformed(old.read(spark, buckets=wanted if old.layout is not None else None), came.schema)
    both = came.withColumn("_times", F.lit(1)).unionByName(went.withColumn("_times", F.lit(-1)))
    return both.groupBy(*came.columns).agg(F.sum("_times").alias("_times")).filter("_times != 0")


def touched_buckets(layout: Layout, keys: DataFrame) -> list[int]:
    """The buckets of some rows: at most ``layout.count`` numbers."""
    return sorted(r[0] for r in keys.select(layout.bucket().alias("b")).distinct().collect())
