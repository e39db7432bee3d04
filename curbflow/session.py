"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for; skewed join partitions are split at run time.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}
# On a cluster, shuffles start with many partitions and AQE merges the small ones.
INITIAL_PARTITIONS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sizing = {} if master and master.startswith("local") else INITIAL_PARTITIONS
    for key, value in {**CLUSTER_CONF, **sizing, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local master may fall back to a machine-local folder: on a cluster the executors
    would each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="curbflow-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Run-time settings of the session while the block runs; what was set before returns afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a parquet table, which survives executor loss and prunes columns."""
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
