"""Running totals and exact quantiles of groups of any size: ranges of the order, and prefix sums over ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.spread import parts
from ledgerflow.sources.workspace import cut


def running(rows: DataFrame, by: Sequence[str], order: Sequence[str], weight: Column | None = None) -> DataFrame:
    """rows with _before (the weights of those before in the group, by order) and _total (of the group).

    Rows are dealt into ranges of (by, order), as many as their number asks for, and summed within; a row for
    each range and group, as many as there are ranges and groups, carries the sums of earlier ranges over. So
    a group of any size is numbered by many tasks, none of which grows with the table. Null is a group of its
    own and comes first in the order; of rows alike in the order any may come first. Weights are whole numbers,
    1 if not given. rows are counted, sampled and dealt: better a stored table.
    """
    n = parts(rows)
    dealt = rows.withColumn("_weight", (F.lit(1) if weight is None else weight).cast("long")).repartitionByRange(n, *by, *order)
    rows = cut(dealt.withColumn("_range", F.spark_partition_id()), "ranges")  # written: ranges stay as they are
    rows = rows.withColumn("_part", F.struct("_range", *by))  # nulls in a struct are alike: window and join share one exchange
    earlier = Window.partitionBy(*[f"_part.{c}" for c in by]).orderBy("_part._range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*[f"_part.{c}" for c in by])
    sums = rows.groupBy("_part").agg(F.sum("_weight").alias("_sum"))
    sums = sums.select("_part", F.sum("_sum").over(earlier).alias("_carried"), F.sum("_sum").over(whole).alias("_total"))
    inside = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.repartition(n, "_part").withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    joined = rows.join(sums, "_part").withColumn("_before", F.coalesce("_carried", F.lit(0)) + F.col("_inside"))
    return joined.drop("_weight", "_range", "_part", "_carried", "_inside")


def positions(rows: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """rows numbered from 1 in their order over the whole table, null first, by as many tasks as there are ranges."""
    return running(cut(rows, "rows"), [], order).withColumn(name, F.col("_before") + 1).drop("_before", "_total")


def value_counts(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, value and n: how often each value occurs in each group; groups whose values are all null have one row without value."""
    return rows.groupBy(*by, value).agg(F.count("*").alias("n"))


def exact_quantiles(counts: DataFrame, by: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """One row per group with a column for each share: the exact quantile, between two values in proportion.

    counts: by, value and n, as value_counts gives them. Nothing is held but counts of different values, dealt
    over tasks by ranges; nulls are left out, and a group without values has null.
    """
    known = counts.withColumn("_n", F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0))
    placed = running(known, by, [value], F.col("_n"))
    out = []
    for name, share in shares.items():
        place = F.lit(float(share)) * (F.col("_total") - 1)
        at = F.floor(place)
        here = lambda k: F.max(F.when((F.col("_before") <= k) & (k < F.col("_before") + F.col("_n")), F.col(value)))
        out += [here(at).alias(f"_a_{name}"), here(F.least(at + 1, F.col("_total") - 1)).alias(f"_b_{name}"), F.max(place - at).alias(f"_f_{name}")]
    ends = placed.groupBy(*by).agg(*out)
    between = [(F.col(f"_a_{n}") + F.col(f"_f_{n}") * (F.col(f"_b_{n}") - F.col(f"_a_{n}"))).alias(n) for n in shares]
    return ends.select(*by, *between)
