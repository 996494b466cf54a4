"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "factorspark", memory: str = "20g") -> SparkSession:
    """Session for tests and local benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Bars are few but the windows over them are heavy: keep all cores busy after small shuffles.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for written tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which every executor of a cluster reaches. Without that setting
    a temporary folder is used where master and executors are one process, and anything else is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master or 'a cluster'}")
        base = tempfile.mkdtemp(prefix="factorspark-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}") if "://" not in base else (
        f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back: it is computed once, its lineage is
    cut, and it outlives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
