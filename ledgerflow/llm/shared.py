"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.sources.workspace import work_folder


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage and is computed once."""
    path = work_folder(df.sparkSession, "ledgerflow")
    df.write.option("compression", compression).parquet(path)
    # shuffle files of plans that nothing refers to any more go when the JVM collects them
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB of rows (64 MB otherwise), so that Python workers stay small next to the JVM."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
