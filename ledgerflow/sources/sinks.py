"""Sinks: ordered text tables, partitioned extracts, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.privacy import safe_csv
from ledgerflow.sources import filetree


def write_csv(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str], gzip: bool = False, overwrite: bool = False) -> None:
    """Fixed columns in fixed order; cells safe for spreadsheets. Existing output stays unless overwrite is asked for."""
    out = safe_csv(df.select(*columns).orderBy(*order))
    writer = out.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).option("escape", '"')
    (writer.option("compression", "gzip") if gzip else writer).csv(path)


def write_months(df: DataFrame, path: str, month: str = "event_month") -> None:
    """A partition per month; months that are no longer there go with the overwrite.

    Rows are dealt by month and tasks of about one size: small months share one, a large one is split.
    """
    df.hint("rebalance", month).write.mode("overwrite").partitionBy(month).parquet(path)


def write_split(df: DataFrame, path: str, by: str) -> None:
    """One folder per value of a column."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_checked(df: DataFrame, path: str, overwrite: bool = False) -> int:
    """Write Parquet and count it again; an error if rows differ."""
    df = df.persist()
    try:
        df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
        expected, found = df.count(), df.sparkSession.read.parquet(path).count()
    finally:
        df.unpersist()
    if expected != found:
        raise ValueError(f"{path}: wrote {expected} rows, read {found}")
    return found


#: Files of more bytes do not come as a value of a row; their hash is taken while they are read.
LARGE = 1 << 30


def manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, bytes and sha256 of the files under a path, of any size.

    A large file passes through the hash in blocks, in one task (a hash over a file is a chain); for hashes that many
    tasks take, see ``filetree``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    small = files.where(F.col("length") <= LARGE).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > LARGE).select("path", F.col("length").alias("bytes"))
    return small.unionByName(large.mapInArrow(filetree.hashed_files, "path string, bytes long, sha256 string"))
