"""Spark session and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "peoplelake", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution, skew-join handling and UTC timestamps.

    Sizing knobs (shuffle partitions, memory) belong to the cluster, so they are only set when passed in ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one machine, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="peoplelake-")
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever the shared folder lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_root`; never reused. Jobs :func:`discard` what they have published."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
