"""From raw documents to training shards: quality, near duplicates, benchmarks, mixture, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. Between stages the rows are written as Parquet to the shared folder, so a
lost executor repeats part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perkline.llm import decontamination, mixing, ngram_join, quality, sharding
from perkline.llm.storage import stored

N_SHARDS = 16


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that are common in a source are taken out of the others."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, Jaccard similarity of 0.8 or more."""
    return ngram_join.one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it (0 to 2 times, whole), in training order."""
    return mixing.training_order(mixing.curriculum(docs, whole=True), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds size, shard and slot; the shards have nearly equal bytes."""
    return sharding.shard_documents(docs, N_SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: SQL cannot express line frequencies, components and the mixture; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
