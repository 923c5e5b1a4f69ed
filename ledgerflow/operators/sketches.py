"""Sketches of snapshots and movements: kept by date, merged at will, read without the rows behind them.

Quantile sketches (KLL) answer medians of any merged groups within about 1.4 % of the rank at their usual size;
set sketches (theta) answer how many records two dates share within a stated error, and exactly as
long as a set has fewer members than the sketch has places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import rate

#: Places of a theta sketch as a power of two; three relative standard errors are 3 / sqrt(2 ** LOG_PLACES).
LOG_PLACES = 14
#: Size of a quantile sketch, and the error of its ranks (99 % of the time).
QUANTILE_SIZE, RANK_ERROR = 200, 0.0175


def quantile_sketches(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, n, least, most and sketch: one row per group, to be stored. Null values are left out."""
    v = F.col(value).cast("double")
    return rows.groupBy(*by).agg(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.kll_sketch_agg_double(v, QUANTILE_SIZE).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """n, least, most and quantiles of coarser groups of stored quantile_sketches; groups without values have null."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch").alias("sketch"))
    value = lambda share: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))))
    return merged.select(*by, "n", "least", "most", *[value(s).alias(name) for name, s in shares.items()])


def set_sketches(rows: DataFrame, by: Sequence[str], member: str, log_places: int = LOG_PLACES) -> DataFrame:
    """by and sketch: the set of members of each group, to be stored. Null members are left out."""
    return rows.groupBy(*by).agg(F.theta_sketch_agg(F.col(member).cast("string"), log_places).alias("sketch"))


def overlaps(sketches: DataFrame, date: str, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Retained, new and disappeared members between any two dates, with their rates, from stored set_sketches.

    A group that only one of the dates has counts as empty on the other. Works on a row for each date and group.
    """
    one = lambda day, name: sketches.where(F.col(date).cast("string") == day).groupBy(*by).agg(F.theta_union_agg("sketch", LOG_PLACES).alias(name))
    parts = []
    for before, after in pairs:
        if not before < after:
            raise ValueError(f"{before} is not before {after}")
        a, b = one(before, "a"), one(after, "b")
        both = a.join(b, list(by), "full_outer") if by else a.join(b)
        parts.append(both.select(F.lit(before).alias("before_date"), F.lit(after).alias("after_date"), *by, "a", "b"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    size = lambda c: F.coalesce(F.theta_sketch_estimate(c), F.lit(0).cast("long"))
    there = F.col("a").isNotNull() & F.col("b").isNotNull()
    only = lambda x, y: F.when(F.col(x).isNull(), 0).when(F.col(y).isNull(), size(F.col(x))).otherwise(size(F.theta_difference(x, y))).cast("long")
    counted = rows.select(
        "before_date", "after_date", *by, size(F.col("a")).alias("before_count"), size(F.col("b")).alias("after_count"),
        F.when(there, size(F.theta_intersection("a", "b"))).otherwise(0).cast("long").alias("retained"), only("b", "a").alias("new_records"), only("a", "b").alias("disappeared_records"),
    )
    union = F.col("retained") + F.col("new_records") + F.col("disappeared_records")
    return counted.withColumn("retention_rate", rate(F.col("retained"), F.col("before_count"))).withColumn("churn", rate(F.col("new_records") + F.col("disappeared_records"), union))


def within_error(estimate: Column, exact: Column, union: Column, log_places: int = LOG_PLACES) -> Column:
    """Is an estimate of a part of a union within three standard errors of the union's sketch (and of rounding)?"""
    return F.abs(estimate - exact) <= 3 * union / F.sqrt(F.lit(float(1 << log_places))) + 1
