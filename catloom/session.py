"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Needed for right results whatever the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value, as JSON readers usually do.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Let Spark re-plan: split hot join partitions, merge small ones, and broadcast
# a side only when its measured size is under the threshold.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **TUNING, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder on this machine:
    executors elsewhere could not see one.
    """
    import uuid

    key = "spark.checkpoint.dir"
    context = spark.sparkContext
    base = spark.conf.get(key, None) or context.getConf().get(key) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="catloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def open_files(spark: SparkSession, most: int = 8) -> Iterator[None]:
    """Writes into a few folders keep a file of each open, instead of sorting all rows by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of fewer splits than cores one partition per core.

    Meant for input about to be parsed. Large input has more splits than cores
    and passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
