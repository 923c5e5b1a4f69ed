"""The folder that the driver and all executors share, for intermediate tables and for stream states."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str = "work") -> str:
    """A new path under the session's spark.checkpoint.dir.

    Where that is unset, a local session gets a folder of its own, as in tests; on a cluster,
    executors would each write to their own disks, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="ledgerflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there and it is computed once."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
