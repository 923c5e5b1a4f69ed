"""Three observations of the orders, derived the same way in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATES = ("2026-08-31", "2026-09-30", "2026-10-31")
PAIRS = tuple(zip(DATES, DATES[1:], strict=False))
VALUES = ("source_name", "native_id", "status", "estimated_cost", "planned_end", "capital_phase")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of the source given by their priority; a few have no native id or share one."""
    k, key = F.col("k"), F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    rows = orders.where(key % 23 != k + 1)
    native = F.when(key % 97 == 0, "N/A").when(key % 89 == 0, F.concat(F.lit("GRP-"), (key % 5).cast("string"))).otherwise(F.concat(F.lit("ORD-"), key.cast("string")))
    cost = F.round("o_totalprice", 2).cast("decimal(18,2)") + F.when((k == 2) & (key % 7 == 0), 100).otherwise(0)
    day = F.date_add(F.col("o_orderdate").cast("date"), F.when((k >= 1) & (key % 11 == 0), 10).otherwise(0))
    return rows.select(
        F.element_at(F.array(*[F.lit(d) for d in DATES]), k + 1).alias("snapshot_date"),
        F.lower("o_orderpriority").alias("source_name"),
        native.alias("native_id"),
        F.concat(F.lit("G-"), key.cast("string")).alias("global_id"),
        key.cast("string").alias("object_id"),
        F.when((k >= 1) & (key % 5 == 0), "Issued").otherwise(F.col("o_orderstatus")).alias("status"),
        cost.cast("decimal(18,2)").cast("string").alias("estimated_cost"),
        F.date_format(day, "yyyy-MM-dd").alias("planned_end"),
        F.when((k == 2) & (key % 13 == 0), "Closeout").otherwise("Design").alias("capital_phase"),
        F.col("o_custkey").alias("customer"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"),
    )


_SQL = """
snap_raw AS (
  SELECT ['2026-08-31','2026-09-30','2026-10-31'][k + 1] AS snapshot_date, lower(o_orderpriority) AS source_name,
    CASE WHEN o_orderkey % 97 = 0 THEN 'N/A' WHEN o_orderkey % 89 = 0 THEN 'GRP-' || (o_orderkey % 5)::VARCHAR ELSE 'ORD-' || o_orderkey::VARCHAR END AS native_id,
    'G-' || o_orderkey::VARCHAR AS global_id, o_orderkey::VARCHAR AS object_id,
    CASE WHEN k >= 1 AND o_orderkey % 5 = 0 THEN 'Issued' ELSE o_orderstatus END AS status,
    (round(o_totalprice, 2)::DECIMAL(18,2) + CASE WHEN k = 2 AND o_orderkey % 7 = 0 THEN 100 ELSE 0 END)::DECIMAL(18,2)::VARCHAR AS estimated_cost,
    strftime(o_orderdate::DATE + CASE WHEN k >= 1 AND o_orderkey % 11 = 0 THEN 10 ELSE 0 END, '%Y-%m-%d') AS planned_end,
    CASE WHEN k = 2 AND o_orderkey % 13 = 0 THEN 'Closeout' ELSE 'Design' END AS capital_phase,
    o_custkey AS customer, strftime(o_orderdate, '%Y-%m-%d') AS event_date
  FROM orders, (VALUES (0), (1), (2)) t(k) WHERE o_orderkey % 23 <> k + 1),
snap_base AS (
  SELECT *, upper(source_name) || CASE WHEN native_id <> 'N/A' THEN '|NATIVE|' || native_id ELSE '|GLOBALID|' || global_id END AS base FROM snap_raw),
snap_dup AS (SELECT DISTINCT base FROM (SELECT base FROM snap_base GROUP BY base, snapshot_date HAVING count(*) > 1)),
snap AS (
  SELECT b.*, CASE WHEN d.base IS NULL THEN b.base ELSE b.base || '|GLOBALID|' || global_id END AS record_identity
  FROM snap_base b LEFT JOIN snap_dup d ON b.base = d.base),
pair AS (SELECT * FROM (VALUES ('2026-08-31','2026-09-30'), ('2026-09-30','2026-10-31')) p(before_date, after_date)),
both_sides AS (
  SELECT p.before_date, p.after_date, s.record_identity,
    max(CASE WHEN s.snapshot_date = p.before_date THEN 1 END) AS has_old, max(CASE WHEN s.snapshot_date = p.after_date THEN 1 END) AS has_new,
    {sides}
  FROM pair p JOIN snap s ON s.snapshot_date IN (p.before_date, p.after_date) GROUP BY ALL)"""

_SIDES = ", ".join(
    f"max(CASE WHEN s.snapshot_date = p.{when}_date THEN s.{v} END) AS {role}_{v}"
    for v in VALUES
    for role, when in (("old", "before"), ("new", "after"))
)

#: CTEs snap (identified rows), pair and both_sides (one row per pair and record).
CTE = "WITH " + _SQL.replace("{sides}", _SIDES)

_EVENTS = """,
kinds AS (SELECT * FROM (VALUES ('status_changed','status'), ('estimated_cost_changed','estimated_cost'), ('planned_date_changed','planned_end'), ('capital_project_phase_changed','capital_phase')) v(change_type, field)),
sides AS (
  SELECT b.*, v.change_type, v.field,
    CASE v.field WHEN 'status' THEN old_status WHEN 'estimated_cost' THEN old_estimated_cost WHEN 'planned_end' THEN old_planned_end ELSE old_capital_phase END AS old_raw,
    CASE v.field WHEN 'status' THEN new_status WHEN 'estimated_cost' THEN new_estimated_cost WHEN 'planned_end' THEN new_planned_end ELSE new_capital_phase END AS new_raw
  FROM both_sides b, kinds v WHERE has_old = 1 AND has_new = 1),
changes AS (
  SELECT before_date, after_date, record_identity, new_source_name AS source_name, new_native_id AS native_id, change_type, field AS changed_fields, old_raw, new_raw,
    CASE WHEN change_type = 'status_changed' AND lower(new_raw) LIKE '%issued%' THEN 'permit_issued' WHEN change_type = 'planned_date_changed' THEN 'expected_completion_changed' ELSE '' END AS semantic_type
  FROM sides WHERE old_raw IS DISTINCT FROM new_raw
  UNION ALL
  SELECT before_date, after_date, record_identity, coalesce(new_source_name, old_source_name), coalesce(new_native_id, old_native_id),
    CASE WHEN has_old IS NULL THEN 'new_record' ELSE 'record_disappeared' END, '', NULL, NULL, ''
  FROM both_sides WHERE has_old IS NULL OR has_new IS NULL)"""

#: The same with changes: one row per change (every type here reports one field).
CHANGES = CTE + _EVENTS

_RATES = """absolute_delta, round(absolute_delta / nullif(before_count, 0)::DOUBLE, 6) AS percentage_delta,
  before_count - disappeared_records AS retained_records, before_count + new_records AS union_size,
  round((before_count - disappeared_records) / nullif(before_count, 0)::DOUBLE, 6) AS retention_rate,
  round(disappeared_records / nullif(before_count, 0)::DOUBLE, 6) AS disappearance_rate,
  round((new_records + disappeared_records) / nullif(before_count + new_records, 0)::DOUBLE, 6) AS publication_churn"""


def health_sql(source: str) -> str:
    """CTE text: one row per pair and source expression, with counts and rates."""
    by = f"before_date, after_date{', ' + source if source else ''}"
    return f"""SELECT {by}, before_count, after_count, new_records, disappeared_records, {_RATES} FROM (
      SELECT {by}, count(has_old) AS before_count, count(has_new) AS after_count,
        count(*) FILTER (has_old IS NULL) AS new_records, count(*) FILTER (has_new IS NULL) AS disappeared_records,
        count(has_new) - count(has_old) AS absolute_delta
      FROM (SELECT *, coalesce(new_source_name, old_source_name) AS source_name FROM both_sides) GROUP BY {by})"""
