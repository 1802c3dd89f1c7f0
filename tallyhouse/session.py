"""Session settings and the shared folder for tables that a job writes on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str, **settings: str) -> SparkSession:
    """A session with the settings the jobs rely on. Master and sizing come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the session's ``spark.checkpoint.dir``.

    The executors of a cluster have to see the folder, so a machine-local one is made up only when the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tallyhouse-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read back.

    For a frame that is used several times and costs a shuffle or a database scan each time. The copy survives the loss
    of executors and its size is known to the planner.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
