"""Delimited files: person files in, report files out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | None = None, **options: str
) -> DataFrame:
    """One file or a folder of files with a header row.

    Without a schema every column is text: types are given by the ingest that
    follows, and no pass over the data is spent on guessing them.
    """
    reader = spark.read.options(header="true", encoding="UTF-8", mode="FAILFAST", **options)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


#: The whole line of a record that does not have the declared columns.
CORRUPT = "_corrupt_record"


def read_delimited_leniently(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, **options: str
) -> DataFrame:
    """The same, all columns as text, where a record with more or fewer cells than columns does not end the read.

    Such a record has its whole line in the column ``_corrupt_record``, which is NULL in good ones. ``columns`` are given for
    files without a header row.
    """
    header = "true" if columns is None else "false"
    if columns is None:
        columns = spark.read.options(header="true", encoding="UTF-8", **options).csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in (*columns, CORRUPT)])
    reader = spark.read.options(header=header, encoding="UTF-8", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
    return reader.schema(schema).csv(path)


def write_delimited(df: DataFrame, path: str) -> None:
    """A folder of part files, each with a header, written in parallel."""
    df.write.mode("overwrite").options(header="true", encoding="UTF-8").csv(path)


def write_report(df: DataFrame, folder: str, name: str, single_file: bool = False) -> str:
    """The part files of ``folder/name``, or one file ``folder/name.csv`` if the caller says so.

    The rows of a single file are written by all tasks as parts without header, then joined in the order of the parts
    by the file system: it puts their blocks together where it can (HDFS), else their bytes are copied one part after
    the other. The file appears whole, under its name at once. Only one of the two forms is there afterwards.
    Returns the path written.
    """
    parts, one = f"{folder}/{name}", f"{folder}/{name}.csv"
    spark = df.sparkSession
    if not single_file:
        write_delimited(df, parts)
        _remove(spark, one)
        return parts
    hidden = f"{folder}/.{name}-parts"
    df.write.mode("overwrite").options(header="false", encoding="UTF-8").csv(f"{hidden}/rows")
    # A row like others, so that names are quoted as values are.
    names = StructType([StructField(f"c{i}", StringType()) for i in range(len(df.columns))])
    header = spark.createDataFrame([tuple(df.columns)], names).coalesce(1)
    header.write.mode("overwrite").options(header="false", encoding="UTF-8").csv(f"{hidden}/header")
    _join_parts(spark, [f"{hidden}/header", f"{hidden}/rows"], f"{hidden}/joined", one)
    _remove(spark, hidden)
    _remove(spark, parts)
    return one


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _join_parts(spark: SparkSession, folders: Sequence[str], joined: str, target: str) -> None:
    """The part files of ``folders``, in order, as the file ``target``; ``joined`` is a name for it while it is made."""
    # The cluster's own file system interface, so that shared storage works too.
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(conf)
    files = []
    for folder in folders:
        found = [s for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
        files += [s.getPath() for s in sorted(found, key=lambda s: s.getPath().getName())]
    first, rest = files[0], files[1:]
    if rest and _can_concat(fs, jvm, first):
        sources = spark.sparkContext._gateway.new_array(path, len(rest))
        for i, file in enumerate(rest):
            sources[i] = file
        fs.concat(first, sources)
        made = first
    else:
        made = path(joined)
        out = fs.create(made, True)
        try:
            for file in files:
                part = fs.open(file)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                finally:
                    part.close()
        finally:
            out.close()
    fs.delete(path(target), False)
    if not fs.rename(made, path(target)):
        raise RuntimeError(f"could not move the report to {target}")


def _can_concat(fs, jvm, file) -> bool:
    return fs.hasPathCapability(file, jvm.org.apache.hadoop.fs.CommonPathCapabilities.FS_CONCAT)
