"""The catalog of snapshots and comparisons: which to compare, under which name, and whether they are sound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.dates import is_month_end, local_date, month_of, month_spine
from ledgerflow.functions.ids import hash_id


def described(snapshots: DataFrame, date: str = "snapshot_date", source: str = "source_name", key: str = "object_id") -> DataFrame:
    """One row per snapshot: records, sources, and a fingerprint of its rows that does not depend on their order."""
    row = hash_id(*[F.col(c) for c in sorted(snapshots.columns) if c != date])
    part = F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(38,0)")
    return snapshots.groupBy(date).agg(
        F.count("*").alias("record_count"), F.countDistinct(source).alias("source_count"), F.sum(part).alias("content_sum"), F.countDistinct(source, key).alias("keys")
    )


def latest(catalog: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """The row of the newest snapshot."""
    whole = F.struct(*catalog.columns)
    return catalog.agg(F.max_by(whole, F.col(date)).alias("r")).where("r is not null").select("r.*")


def with_contents(catalog: DataFrame, content: Column, date: str = "snapshot_date") -> DataFrame:
    """The snapshots with given contents, the newest first of each: date and how many hold them."""
    return catalog.where(content).agg(F.max(date).alias(date), F.count("*").alias("copies")).where("copies > 0")


def consecutive(catalog: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Each snapshot's date with that of the one before it. A catalog holds a row per snapshot, so one task orders it."""
    days = catalog.select(F.col(date).alias("after_date")).distinct()
    before = F.lag("after_date").over(Window.orderBy("after_date"))
    return days.withColumn("before_date", before).where("before_date is not null").select("before_date", "after_date")


def comparison_ids(pairs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """pairs (before_date, after_date as text) with comparison_id and conflict.

    The month names a comparison that ends at a month's end, or that stands under it already
    (existing: comparison_id, before_date, after_date); others are named by their day. A name
    that stands for other dates, or that several pairs claim, is a conflict: it must not be replaced.
    """
    month = F.substring("after_date", 1, 7)
    claimed = pairs.withColumn("month", month)
    if existing is None:
        existing = pairs.limit(0).select(F.lit("").alias("comparison_id"), "before_date", "after_date")
    held = existing.select("comparison_id", F.struct("before_date", "after_date").alias("held"))
    period = F.struct("before_date", "after_date")
    monthly = held.select(F.col("comparison_id").alias("month"), F.col("held").alias("of_month"))
    named = claimed.join(monthly, "month", "left")
    keeps = F.coalesce(F.col("of_month") == period, F.lit(False)) | is_month_end(F.to_date("after_date"))
    named = named.withColumn("comparison_id", F.when(keeps, F.col("month")).otherwise(F.col("after_date")))
    named = named.join(held, "comparison_id", "left").withColumn("claims", F.count("*").over(Window.partitionBy("comparison_id")))
    conflict = (F.col("held").isNotNull() & (F.col("held") != period)) | (F.col("claims") > 1)
    return named.select("before_date", "after_date", "comparison_id", conflict.alias("conflict"))


def tracker_index(catalog: DataFrame, comparisons: DataFrame, change_rows: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row per comparison: its records with any change and its alerts by severity, with the tracker's status and sizes.

    catalog: a row per snapshot. comparisons: before_date, after_date, comparison_id. Without any
    comparison there is one row with a null id.
    """
    pair = ["before_date", "after_date"]
    changed = change_rows.groupBy(*pair).agg(F.countDistinct("record_identity").alias("records_with_change"))
    severe = alerts.groupBy(*pair).agg(*[F.count_if(F.col("severity") == s).alias(f"{s}_alerts") for s in ("critical", "warning")])
    per = comparisons.join(changed, pair, "left").join(severe, pair, "left")
    n = catalog.agg(F.count("*").alias("snapshots"))
    status = F.when(F.col("snapshots") == 0, "empty").when(F.col("snapshots") == 1, "baseline_only").otherwise("longitudinal")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = n.join(per, F.lit(True), "left")  # one row on the left
    return out.select("comparison_id", *pair, zero("records_with_change"), zero("critical_alerts"), zero("warning_alerts"), status.alias("status"), "snapshots")


def integrity(
    rows: DataFrame,
    metadata: DataFrame,
    sources: Sequence[str],
    zone: str,
    blocked: Sequence[str] = (),
    least: int = 1,
    date: str = "snapshot_date",
    retrieved: str = "retrieved_at",
    source: str = "source_name",
    key: str = "object_id",
    properties: str = "properties",
) -> DataFrame:
    """One row per snapshot and check: passed.

    metadata (a row per snapshot): date, record_count, source_count, content_sum as ``described``
    gives them. Checked are the counts, the contents, the set of sources, that all rows were
    retrieved on the date in the zone, that keys are there and differ within their source, that
    no blocked property is stored (properties: a map), and a least number of rows. A snapshot
    that stands on one side only fails all of them.
    """
    names = F.array(*[F.lit(b.lower()) for b in blocked]) if blocked else F.array().cast("array<string>")
    leaks = F.exists(F.map_keys(properties), lambda k: F.array_contains(names, F.lower(k)))
    day = F.date_format(local_date(F.col(retrieved), zone), "yyyy-MM-dd")
    blank = F.coalesce(F.trim(F.col(key).cast("string")) == "", F.lit(True))
    facts = rows.groupBy(date).agg(
        F.count_if(~F.coalesce(day == F.col(date).cast("string"), F.lit(False))).alias("off_day"),
        F.count_if(blank).alias("blank_keys"),
        F.count_if(F.coalesce(leaks, F.lit(False))).alias("leaks"),
        F.count_if(~F.coalesce(F.col(source).isin(*sources), F.lit(False))).alias("foreign"),
    )
    plain = rows.withColumn(properties, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(properties)))))
    found = described(plain, date, source, key).join(facts, date)
    told = metadata.select(date, *[F.col(c).alias(f"m_{c}") for c in ("record_count", "source_count", "content_sum")])
    both = found.join(told, date, "full_outer")
    checks = {
        "record_count": F.col("record_count") == F.col("m_record_count"),
        "source_set": (F.col("source_count") == F.col("m_source_count")) & (F.col("source_count") == len(set(sources))) & (F.col("foreign") == 0),
        "contents": F.col("content_sum") == F.col("m_content_sum"),
        "retrieval_day": F.col("off_day") == 0,
        "object_keys": (F.col("blank_keys") == 0) & (F.col("keys") == F.col("record_count")),
        "scrubbed": F.col("leaks") == 0,
        "least_rows": F.col("record_count") >= least,
    }
    listed = F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in checks.items()])
    return both.select(F.col(date), F.explode(listed).alias("c")).select(date, "c.check", "c.passed")


def overdue_months(catalog: DataFrame, today: Column, first_required: str, date: str = "snapshot_date") -> DataFrame:
    """The month ends from the first required one to the last before today that no snapshot bears. Nothing if today is before the first."""
    spark = catalog.sparkSession
    last = F.date_sub(F.trunc(today, "month"), 1)
    first = F.to_date(F.lit(first_required))
    months = spark.range(1).select(F.explode(month_spine(first, F.greatest(first, last))).alias("m")).where(F.last_day("m") <= last)
    due = months.select(F.date_format(F.last_day("m"), "yyyy-MM-dd").alias("month_end"))
    have = catalog.select(F.col(date).cast("string").alias("month_end")).distinct()
    return due.join(have, "month_end", "left_anti").select("month_end", month_of(F.to_date("month_end")).alias("month"))
