"""Shared scratch folder for written intermediate tables.

A table written here outlives the executors that made it, so jobs that cut their lineage through it
survive executor loss.  The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder; a local session without one gets a temporary folder."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"sievebed-{application}-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path no earlier run has used, so that a re-run never overwrites what is still being read."""
    return f"{shared_folder(spark)}/sievebed/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again: what made them runs once."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
