"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from perkline.session import shared_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet and read again: computed once, lineage cut.

    A lost executor repeats tasks of the write; readers see only the finished table.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table made by :func:`stored` whose readers are all stored themselves."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        discard_folder(df.sparkSession, folder)


def discard_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps.

    It does so when the driver's garbage collector finds their plans gone, which the few objects of
    a driver may not cause for hours, while the files fill the disks of the executors.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
