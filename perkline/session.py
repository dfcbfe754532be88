"""One place that builds a session and answers where shared files may go."""

from __future__ import annotations

import importlib.util
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

BASE_CONF = {
    # Results must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    # Run-time re-planning: small shuffle outputs are merged, joins turn into
    # broadcasts once a side is measured to be small, skewed partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    app_name: str = "perkline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the library's settings; ``conf`` wins over the defaults.

    ``shuffle_partitions`` is the number before adaptive merging. Leave it unset
    locally; on a cluster give about (bytes shuffled / 128 MB).
    """
    settings = dict(BASE_CONF)
    if importlib.util.find_spec("delta") is not None:
        settings.update(DELTA_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})

    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that all executors can reach.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="perkline-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
