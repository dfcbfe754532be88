"""Database tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Database:
    """Where a database is. ``options`` carries user, password, driver, fetchsize, …"""

    url: str
    options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Split:
    """Numeric, date or timestamp column whose range is read in parallel pieces."""

    column: str
    partitions: int
    lower: str | int | None = None
    upper: str | int | None = None


def read_options(db: Database, table: str, split: Split | None = None) -> dict[str, str]:
    options = {**db.options, "url": db.url, "dbtable": table}
    if split is not None:
        if split.lower is None or split.upper is None:
            raise ValueError("a split needs both bounds")
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def write_options(db: Database, table: str, batch_size: int = 10_000) -> dict[str, str]:
    return {**db.options, "url": db.url, "dbtable": table, "batchsize": str(batch_size)}


def read_database(
    spark: SparkSession, db: Database, table: str, split: Split | None = None
) -> DataFrame:
    """Read a table. With a ``split``, missing bounds are asked from the database.

    Rows outside the bounds are still read (by the first and last piece), so the
    bounds affect balance only. Filters and column choice are pushed down.
    """
    if split is not None and (split.lower is None or split.upper is None):
        whole = spark.read.format("jdbc").options(**read_options(db, table)).load()
        low, high = whole.agg(F.min(split.column), F.max(split.column)).first()
        # An empty table has no bounds and needs no split.
        split = None if low is None else Split(split.column, split.partitions, low, high)
    return spark.read.format("jdbc").options(**read_options(db, table, split)).load()


def append_database(df: DataFrame, db: Database, table: str, batch_size: int = 10_000) -> None:
    """Append rows. Each task writes in its own transaction, so a repeated task can
    repeat rows; keep this for small results such as metric history."""
    df.write.format("jdbc").options(**write_options(db, table, batch_size)).mode("append").save()
