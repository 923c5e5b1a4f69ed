"""Bitemporal cohorts: when things happened against when they were observed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_of


def cohorts(identified: DataFrame, latest: tuple[str, ...], date: str = "snapshot_date") -> DataFrame:
    """One row per identity ever seen: its latest values, first, last and number of observations, and whether it is still observed."""
    last = identified.agg(F.max(date).alias("last_snapshot"))
    kept = F.struct(*[F.col(c) for c in latest])
    out = identified.groupBy("record_identity").agg(
        F.min(date).alias("first_observed"),
        F.max(date).alias("last_observed"),
        F.countDistinct(date).alias("observations"),
        F.max_by(kept, F.col(date)).alias("row"),
    )
    # a single row with a single value
    out = out.join(F.broadcast(last))
    return out.select(
        "record_identity", "first_observed", "last_observed", "observations", (F.col("last_observed") == F.col("last_snapshot")).alias("currently_observed"), "row.*"
    )


def event_date(source: Column, hierarchy: dict[str, list[tuple[str, str, Column]]], otherwise: list[tuple[str, str, Column]]) -> Column:
    """struct of date, type, field and planned: the first date of the source's hierarchy that is there.

    A hierarchy lists (type, field, date); types that start with planned_ are plans.
    """

    def first(items: list[tuple[str, str, Column]]) -> Column:
        return F.coalesce(
            *[
                F.when(d.isNotNull(), F.struct(d.alias("date"), F.lit(t).alias("type"), F.lit(f).alias("field"), F.lit(t.startswith("planned_")).alias("planned")))
                for t, f, d in items
            ]
        )

    out = first(otherwise)
    for name, items in hierarchy.items():
        out = F.when(source == name, first(items)).otherwise(out)
    return out


def scoped(rows: DataFrame, event: str, planned: str, snapshot: Column, start: Column) -> DataFrame:
    """Adds scope: before_start, undated, event, plan (planned beyond the snapshot) or future_fault."""
    d, p = F.col(event), F.col(planned)
    scope = (
        F.when(d.isNull(), "undated")
        .when(d < start, "before_start")
        .when(d <= snapshot, "event")
        .when(p, "plan")
        .otherwise("future_fault")
    )
    return rows.withColumn("scope", scope).withColumn("event_month", month_of(d))


def monthly_index(events: DataFrame, month: str, source: str, kind: str) -> DataFrame:
    """Per month: number of rows, and counts by source and by type as sorted text."""
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")
    sources = events.groupBy(month, source).agg(F.count("*").alias("n")).groupBy(month).agg(F.sum("n").alias("rows"), F.map_from_entries(F.collect_list(F.struct(source, "n"))).alias("m"))
    kinds = events.groupBy(month, kind).agg(F.count("*").alias("n")).groupBy(month).agg(F.map_from_entries(F.collect_list(F.struct(kind, "n"))).alias("k"))
    return sources.join(kinds, month).select(month, "rows", listed("m").alias("by_source"), listed("k").alias("by_type"))


def dense_months(counts: DataFrame, month: str, value: str) -> DataFrame:
    """counts with a row of 0 for every month in between that has none."""
    first_day = lambda c: F.to_date(F.concat(c, F.lit("-01")))
    ends = counts.agg(F.min(month).alias("a"), F.max(month).alias("b"))
    spine = ends.select(F.explode(F.sequence(first_day("a"), first_day("b"), F.expr("interval 1 month"))).alias("d")).select(month_of(F.col("d")).alias(month))
    return spine.join(counts, month, "left").select(month, F.coalesce(value, F.lit(0)).alias(value))
