"""Session settings and the shared folder that long jobs write to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "trialspark", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC, ANSI, adaptive session. On a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="trialspark-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temp folder only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_dir()


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write to the shared folder and read back.

    The result outlives the executors that computed it and starts a new plan; unlike a checkpointed
    RDD, the written table has a known size, so a small one is joined without shuffling the other
    side. ``compression`` is the codec of the files, if not the session's.
    """
    path = run_dir(df.sparkSession, "step")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
