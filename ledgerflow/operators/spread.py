"""Joins that deal the rows of frequent keys over several tasks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fewer rows than LEAST are never a key's trouble; at most MOST keys can be frequent.
LEAST, MOST = 256, 20_000
#: Rows that a task gets at most on average where rows are dealt by their number.
PART_ROWS = 250_000


def parts(rows: DataFrame) -> int:
    """As many parts as the number of rows asks for, so that tasks do not grow with the table; counts the rows."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / PART_ROWS))


def dealt(rows: DataFrame, *on: str, count: DataFrame | None = None) -> DataFrame:
    """rows dealt by keys into as many parts as their number asks for.

    ``count`` is a table of as many rows that is cheaper to count.
    """
    return rows.repartition(parts(rows if count is None else count), *on)


def frequent(rows: DataFrame, *on: str, counts: DataFrame | None = None) -> DataFrame | None:
    """The keys of more than 1 / MOST of all rows (and more than LEAST), with the number of parts to deal each into.

    At most MOST rows, whatever the table: they pass through the driver. None if there is none.
    ``counts`` (the keys and their number of rows as n) saves counting where it is known.
    """
    if counts is None:
        counts = rows.where(" and ".join(f"`{c}` is not null" for c in on)).groupBy(*on).agg(F.count("*").alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    limit = max(LEAST, (total or 0) // MOST)
    if (most or 0) <= limit:
        return None
    keys = counts.where(F.col("n") > limit).select(*on, F.ceil(F.col("n") / limit).cast("int").alias("_parts"))
    return rows.sparkSession.createDataFrame(keys.collect(), keys.schema)


def deal(rows: DataFrame, table: DataFrame, on: list[str], by: list[Column], hot: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """rows and table with a further key ``_part``: rows of a frequent key are dealt by ``by``, table's rows copied to each part."""
    if hot is None:
        return rows.withColumn("_part", F.lit(0)), table.withColumn("_part", F.lit(0))
    small = F.broadcast(hot)  # at most MOST rows
    left = rows.join(small, on, "left").withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*by), F.col("_parts")).cast("int"))).drop("_parts")
    right = table.join(small, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left, right


def spread_join(rows: DataFrame, table: DataFrame, on: list[str], by: list[Column], how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """rows joined with table (one row per key); the rows of a frequent key are dealt by ``by``, table's row copied to each part."""
    if hot is None:
        return rows.join(table, on, how)
    left, right = deal(rows, table, on, by, hot)
    return left.join(right, [*on, "_part"], how).drop("_part")
