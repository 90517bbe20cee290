"""Spark session defaults and the shared scratch location.

Everything that must survive the loss of an executor (cut lineage, staged
landing files, versioned tables) is written under the folder the cluster
names in ``spark.checkpoint.dir``.  A private folder is only created when that
setting is unset, which is the case in tests and on a laptop.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans name the whole path of what they scan; by default long ones are cut.
    "spark.sql.maxMetadataStringLength": "1000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # No broadcast from a static guess (compressed file size) and no hints: AQE
    # broadcasts at runtime from the measured size of a finished shuffle stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


# Settings for a large cluster (hundreds of executors, tens of TB per job): many
# initial shuffle partitions that AQE coalesces to ~256 MB each by measured size,
# larger scan splits, and skew handling for partitions far above the median.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.scheduler.mode": "FAIR",          # concurrent Silver/Gold jobs share the cluster
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "salesmart", extra: dict | None = None, cluster: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(CLUSTER_DEFAULTS if cluster else {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, with its scheme; a private one only in local mode."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="salesmart-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared folder (never reused across runs)."""
    return "/".join([shared_dir(spark), "salesmart", *parts, uuid.uuid4().hex])


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as Parquet under the shared folder and reading it back.

    One columnar write (Spark's committer makes it safe under task retries and
    lost executors) instead of an RDD checkpoint, which computes the plan twice
    and stores serialised rows.  Without dictionaries: looking keys up in them
    takes a quarter of the write, and zstd finds most of what they would save.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)
    return df.sparkSession.read.parquet(path)
