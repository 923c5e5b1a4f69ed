"""Queries on the catalog of snapshots, portal records and their children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import portal, tracking
from ledgerflow.plans import change_queries
from ledgerflow.plans.snapshots import CHANGES, CTE, snapshots, table
from ledgerflow.sources.workspace import cut

SOURCES = ("1-urgent", "2-high", "3-medium", "4-not specified", "5-low")


def snapshot_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots of the orders, and which is the newest."""
    catalog = tracking.described(snapshots(spark, sf_dir))
    newest = tracking.latest(catalog).select("snapshot_date", F.lit(True).alias("newest"))
    out = catalog.join(F.broadcast(newest), "snapshot_date", "left")  # one row
    return out.select("snapshot_date", "record_count", "source_count", "keys", F.coalesce("newest", F.lit(False)).alias("is_latest"))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot per month of the orders: at its end, or on the 15th in every fifth month; some months lack."""
    month = F.month("o_orderdate")
    day = F.when(month % 5 == 0, F.date_add(F.trunc("o_orderdate", "month"), 14)).otherwise(F.last_day("o_orderdate"))
    rows = table(spark, sf_dir, "orders").where((F.year("o_orderdate") * 12 + month) % 11 != 0)
    return rows.select(F.date_format(day, "yyyy-MM-dd").alias("snapshot_date")).distinct()


def comparison_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive snapshots, each pair's name, and whether the name stands for other dates."""
    pairs = tracking.consecutive(_days(spark, sf_dir))
    month = F.substring("after_date", 1, 7)
    known = pairs.where(F.substring("after_date", 6, 2).isin("01", "02", "05"))
    before = F.when(F.substring("after_date", 6, 2) == "02", "1900-01-01").otherwise(F.col("before_date"))
    return tracking.comparison_ids(pairs, known.select(month.alias("comparison_id"), before.alias("before_date"), "after_date"))


def tracker_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = tracking.described(snapshots(spark, sf_dir)).select("snapshot_date")
    named = tracking.comparison_ids(tracking.consecutive(catalog))
    changed = change_queries.change_rows(spark, sf_dir).select(F.col("before_snapshot_date").alias("before_date"), F.col("after_snapshot_date").alias("after_date"), "record_identity")
    return tracking.tracker_index(catalog, named, changed, change_queries.alerts(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str, faults: bool) -> DataFrame:
    """Snapshot rows with a time of retrieval and properties; with faults, each snapshot has one of its own."""
    rows = snapshots(spark, sf_dir)
    key, day = F.col("object_id").cast("long"), F.col("snapshot_date")
    hit = lambda which, n, rest: F.lit(faults) & (day == which) & (key % n == rest)
    at = F.when(hit("2026-09-30", 300, 1), "02:00:00").otherwise("16:00:00")
    plain = F.create_map(F.lit("STATUS"), F.col("status"))
    return rows.select(
        "snapshot_date",
        "source_name",
        F.when(~hit("2026-08-31", 500, 0), F.col("object_id")).alias("object_id"),
        F.to_timestamp(F.concat_ws(" ", day, at)).alias("retrieved_at"),
        F.when(hit("2026-10-31", 700, 2), F.map_concat(plain, F.create_map(F.lit("OwnerEmail"), F.lit("x")))).otherwise(plain).alias("properties"),
    )


def snapshot_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots with faults against the metadata of sound ones (one count is wrong there)."""
    sound = _stored(spark, sf_dir, False).withColumn("properties", F.to_json("properties"))
    told = tracking.described(sound)
    told = told.withColumn("record_count", F.col("record_count") + F.when(F.col("snapshot_date") == "2026-10-31", 1).otherwise(0))
    return tracking.integrity(_stored(spark, sf_dir, True), told, SOURCES, "America/New_York", ("owneremail",), 100)


def overdue_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.overdue_months(_days(spark, sf_dir), F.to_date(F.lit("2001-09-15")), "1995-01-31")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def portal_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as search rows, two of three with details whose labels differ."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    records = orders.select("o_orderkey", F.concat(F.lit("ORD-"), _text("o_orderkey")).alias("record_number"), F.col("o_orderstatus").alias("record_status"), F.lit("none yet").alias("description"))
    label = lambda test, a, b: F.when(test, a).otherwise(b)
    values = F.map_from_arrays(
        F.array(label(key % 2 == 0, "status", "record status"), F.lit("issue date"), label(key % 2 == 0, "job value", "valuation"), F.lit("project description"), F.lit("address")),
        F.array(
            F.when(key % 5 != 0, F.lower("o_orderpriority")),
            F.date_format("o_orderdate", "MM/dd/yyyy"),
            F.concat(F.lit("$"), F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string")),
            F.when(key % 7 == 0, "   ").otherwise(F.concat(F.lit(" Order  of "), _text("o_custkey"))),
            F.concat(_text("o_orderkey"), F.lit(" N MAIN ST, LAKETOWN FL "), F.lpad((key % 100000).cast("string"), 5, "3")),
        ),
    )
    details = orders.where(key % 3 != 0).select("o_orderkey", values.alias("values"))
    out = portal.enriched(records, details, "o_orderkey")
    return out.select("o_orderkey", "record_number", "record_status", "issued_date", F.col("valuation").cast("double").alias("valuation"), "description", "street_number", "street_name", "postal_code")


def _child_values(items: DataFrame) -> DataFrame:
    """Line items as nested rows under labels that differ; some have no number, and some of these no type."""
    part = F.col("l_partkey")
    values = F.map_from_arrays(
        F.array(F.lit("inspection number"), F.when(part % 2 == 0, "type").otherwise("inspection type"), F.lit("schedule date"), F.lit("result")),
        F.array(
            F.when(part % 10 != 0, F.concat_ws("-", "l_linenumber", "l_suppkey", "l_partkey")),
            F.when(part % 20 != 0, F.col("l_returnflag")),
            F.date_format("l_shipdate", "MM/dd/yyyy"),
            F.col("l_linestatus"),
        ),
    )
    return items.select(F.concat(F.lit("rec-"), _text("l_orderkey")).alias("record_id"), F.concat(F.lit("ord "), _text("l_orderkey")).alias("record_number"), values.alias("values"))


def portal_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = portal.children(_child_values(table(spark, sf_dir, "lineitem")), "record_id")
    return out.groupBy("record_id", "child_id").agg(F.count("*").alias("rows"), F.min("source_id").alias("source_id"), F.min("kind").alias("kind"), F.min("scheduled_date").alias("scheduled_date"))


_CHILD = ("record_id", "record_number", "source_id", "kind", "scheduled_date", "completed_date", "result_date", "result")


def child_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items stored under provisional parents and read again: moved to their orders' ids and merged."""
    rows = _child_values(table(spark, sf_dir, "lineitem"))
    named = portal.children(rows, "record_id")
    number = F.concat(F.lit("ord "), F.substring("record_id", 5, 20))
    base = cut(named.withColumn("record_number", number).select(*_CHILD), "children")  # both sides read it
    order = F.substring("record_id", 5, 20).cast("long")
    stored = base.withColumn("record_id", F.when(order % 3 == 0, F.concat(F.lit("tmp-"), F.col("record_number"))).otherwise(F.col("record_id"))).withColumn("result", F.lit("old"))
    fresh = base.withColumn("result", F.when(order % 2 == 0, "new"))
    span = lambda df, a, b: df.withColumn("first_observed", F.lit(a)).withColumn("last_observed", F.lit(b)).withColumn("child_id", F.lit(""))
    parents = table(spark, sf_dir, "orders").where("o_orderkey % 4 <> 1").select(F.concat(F.lit("rec-"), _text("o_orderkey")).alias("record_id"), F.concat(F.lit("ORD-"), _text("o_orderkey")).alias("record_number"))
    out = portal.upsert_children(span(stored, "1995-01-01", "1996-01-01"), span(fresh, "1995-06-01", "1997-01-01"), parents, "record_id", "record_number", "first_observed", "last_observed")
    return out.select("record_id", "child_id", "kind", "result", "first_observed", "last_observed")


def partition_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, and once more with what was seen a year later, merged exactly once."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("status"), F.lower("o_orderpriority").alias("category"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen")
    )
    later = orders.where("record_id % 3 = 0").select(
        "record_id", F.when(F.col("record_id") % 2 == 0, "LATE").alias("status"), F.lit(None).cast("string").alias("category"), F.date_format(F.add_months(F.to_date("seen"), 12), "yyyy-MM-dd").alias("seen")
    )
    parts = [df.where(F.substring("seen", 4, 1).cast("int") % 2 == odd) for df in (orders, later) for odd in (0, 1)]
    dated = [p.withColumn("first_observed", F.col("seen")).withColumn("last_observed", F.col("seen")) for p in parts]
    return portal.merged_partitions(dated, "record_id", "seen", "first_observed", "last_observed").drop("seen")


def child_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = portal.children(_child_values(table(spark, sf_dir, "lineitem")), "record_id")
    label = F.when(F.col("result") == "O", "prospective_snapshot").when(F.col("kind") == "R", "guess").otherwise("retrospective_event_history")
    rows = rows.select("child_id", F.when(F.col("kind") != "A", F.col("record_id")).alias("record_id"), "source_id", "kind", label.alias("temporal_label"))
    parents = table(spark, sf_dir, "orders").where("o_orderkey % 50 <> 0").select(F.concat(F.lit("rec-"), _text("o_orderkey")).alias("record_id"))
    words = ("retrospective_event_history", "prospective_snapshot", "unknown")
    return portal.child_checks(rows, parents, "record_id", ("child_id", "record_id", "source_id", "kind", "temporal_label"), words)


def child_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = portal.children(_child_values(table(spark, sf_dir, "lineitem")), "record_id")
    runs = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("attempted"))
    return portal.attempted(rows, runs.withColumn("complete", F.col("o_custkey") % 3 != 0), "record_id")


QUERIES = {
    f.__name__: f
    for f in (snapshot_catalog, comparison_names, tracker_index, snapshot_integrity, overdue_months, portal_details, portal_children, child_upsert, partition_merge, child_checks, child_progress)
}

_DAYS = """days AS (SELECT DISTINCT strftime(CASE WHEN month(o_orderdate) % 5 = 0 THEN date_trunc('month', o_orderdate)::DATE + 14 ELSE last_day(o_orderdate) END, '%Y-%m-%d') AS snapshot_date
  FROM orders WHERE (year(o_orderdate) * 12 + month(o_orderdate)) % 11 <> 0)"""
_CHILDREN = """c AS (SELECT l_orderkey, 'rec-' || l_orderkey AS record_id, CASE WHEN l_partkey % 10 <> 0 THEN concat_ws('-', l_linenumber, l_suppkey, l_partkey) END AS source_id,
    CASE WHEN l_partkey % 20 <> 0 THEN l_returnflag END AS kind, strftime(l_shipdate, '%Y-%m-%d') AS scheduled_date, l_linestatus AS result FROM lineitem)"""
_CHILD_ID = "CASE WHEN source_id IS NOT NULL THEN sha256('own|' || record_id || '|' || source_id) ELSE sha256('content|' || record_id || '|' || coalesce(kind, '') || '|' || scheduled_date || '||') END"

ORACLE_SQL = {
    "snapshot_catalog": CTE + """ SELECT snapshot_date, count(*) AS record_count, count(DISTINCT source_name) AS source_count, count(DISTINCT (source_name, object_id)) AS keys,
        snapshot_date = (SELECT max(snapshot_date) FROM snap) AS is_latest FROM snap GROUP BY snapshot_date""",
    "comparison_names": f"""WITH {_DAYS}, p AS (SELECT lag(snapshot_date) OVER (ORDER BY snapshot_date) AS before_date, snapshot_date AS after_date FROM days),
        n AS (SELECT before_date, after_date, CASE WHEN after_date = strftime(last_day(after_date::DATE), '%Y-%m-%d') OR after_date[6:7] = '05' THEN after_date[1:7] ELSE after_date END AS comparison_id FROM p WHERE before_date IS NOT NULL)
        SELECT before_date, after_date, comparison_id, (after_date[6:7] = '02') OR count(*) OVER (PARTITION BY comparison_id) > 1 AS conflict FROM n""",
    "tracker_index": CHANGES + change_queries.ALERTS_SQL + """ SELECT after_date[1:7] AS comparison_id, before_date, after_date,
        (SELECT count(DISTINCT record_identity) FROM changes c WHERE c.before_date = p.before_date AND c.after_date = p.after_date) AS records_with_change,
        (SELECT count(*) FROM alerts a WHERE a.before_date = p.before_date AND severity = 'critical') AS critical_alerts, (SELECT count(*) FROM alerts a WHERE a.before_date = p.before_date AND severity = 'warning') AS warning_alerts,
        'longitudinal' AS status, (SELECT count(DISTINCT snapshot_date) FROM snap) AS snapshots FROM pair p""",
    "snapshot_integrity": CTE + """, f AS (SELECT snapshot_date, count(*) AS n, count(DISTINCT source_name) AS sources,
          count(*) FILTER (snapshot_date = '2026-08-31' AND object_id::BIGINT % 500 = 0) AS blank, count(*) FILTER (snapshot_date = '2026-09-30' AND object_id::BIGINT % 300 = 1) AS off,
          count(*) FILTER (snapshot_date = '2026-10-31' AND object_id::BIGINT % 700 = 2) AS leaks FROM snap GROUP BY snapshot_date)
        SELECT snapshot_date, 'record_count' AS "check", snapshot_date <> '2026-10-31' AS passed FROM f UNION ALL SELECT snapshot_date, 'source_set', sources = 5 FROM f
        UNION ALL SELECT snapshot_date, 'contents', blank + off + leaks = 0 FROM f UNION ALL SELECT snapshot_date, 'retrieval_day', off = 0 FROM f UNION ALL SELECT snapshot_date, 'object_keys', blank = 0 FROM f
        UNION ALL SELECT snapshot_date, 'scrubbed', leaks = 0 FROM f UNION ALL SELECT snapshot_date, 'least_rows', n >= 100 FROM f""",
    "overdue_months": f"""WITH {_DAYS}, m AS (SELECT strftime(last_day(d), '%Y-%m-%d') AS month_end FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH))::DATE AS d))
        SELECT month_end, month_end[1:7] AS month FROM m WHERE month_end NOT IN (SELECT snapshot_date FROM days)""",
    "portal_details": """SELECT o_orderkey, 'ORD-' || o_orderkey AS record_number, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 THEN lower(o_orderpriority) ELSE o_orderstatus END AS record_status,
        CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS issued_date, CASE WHEN o_orderkey % 3 <> 0 THEN round(o_totalprice, 2)::DECIMAL(18,2)::DOUBLE END AS valuation,
        CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0 THEN 'Order of ' || o_custkey ELSE 'none yet' END AS description, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey::VARCHAR END AS street_number,
        CASE WHEN o_orderkey % 3 <> 0 THEN 'N MAIN ST' END AS street_name, CASE WHEN o_orderkey % 3 <> 0 THEN lpad((o_orderkey % 100000)::VARCHAR, 5, '3') END AS postal_code FROM orders""",
    "portal_children": f"""WITH {_CHILDREN}, i AS (SELECT *, {_CHILD_ID} AS child_id FROM c)
        SELECT record_id, child_id, count(*) AS rows, min(source_id) AS source_id, min(kind) AS kind, min(scheduled_date) AS scheduled_date FROM i GROUP BY record_id, child_id""",
    "child_upsert": f"""WITH {_CHILDREN}, s AS (SELECT CASE WHEN l_orderkey % 3 = 0 AND l_orderkey % 4 = 1 THEN 'tmp-ord ' || l_orderkey ELSE record_id END AS record_id, source_id, kind, scheduled_date, 'old' AS result, 0 AS fresh, '1995-01-01' AS a, '1996-01-01' AS b FROM c
          UNION ALL SELECT record_id, source_id, kind, scheduled_date, CASE WHEN l_orderkey % 2 = 0 THEN 'new' END, 1, '1995-06-01', '1997-01-01' FROM c),
        i AS (SELECT *, {_CHILD_ID} AS child_id FROM s WHERE source_id IS NOT NULL OR kind IS NOT NULL)
        SELECT record_id, child_id, min(kind) AS kind, coalesce(max(result) FILTER (fresh = 1), max(result)) AS result, min(a) AS first_observed, max(b) AS last_observed FROM i GROUP BY record_id, child_id""",
    "partition_merge": """WITH a AS (SELECT o_orderkey AS record_id, o_orderstatus AS status, lower(o_orderpriority) AS category, o_orderdate::DATE AS d FROM orders)
        SELECT record_id, CASE WHEN record_id % 6 = 0 THEN 'LATE' ELSE status END AS status, category, strftime(d, '%Y-%m-%d') AS first_observed,
          strftime(CASE WHEN record_id % 3 = 0 THEN (d + INTERVAL 12 MONTH)::DATE ELSE d END, '%Y-%m-%d') AS last_observed FROM a""",
    "child_checks": f"""WITH {_CHILDREN}, i AS (SELECT {_CHILD_ID} AS child_id, CASE WHEN kind <> 'A' THEN record_id END AS record_id, source_id, kind,
          CASE WHEN result = 'O' THEN 'p' WHEN kind = 'R' THEN 'guess' ELSE 'r' END AS label FROM c),
        f AS (SELECT 'columns_in_order' AS "check", 0::BIGINT AS faults UNION ALL SELECT 'child_ids', count(*) FROM (SELECT child_id FROM i GROUP BY child_id HAVING count(*) > 1)
          UNION ALL SELECT 'parent_there', count(*) FILTER (record_id IS NULL) FROM i
          UNION ALL SELECT 'parent_known', count(*) FROM i WHERE record_id IS NOT NULL AND record_id NOT IN (SELECT 'rec-' || o_orderkey FROM orders WHERE o_orderkey % 50 <> 0)
          UNION ALL SELECT 'labels', count(*) FILTER (label = 'guess') FROM i UNION ALL SELECT 'no_layout_rows', count(*) FILTER (source_id IS NULL AND kind IS NULL) FROM i)
        SELECT "check", faults = 0 AS passed, faults FROM f""",
    "child_progress": """SELECT (SELECT count(*) FROM lineitem) AS rows, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS parents_with_rows, (SELECT count(DISTINCT o_orderkey) FROM orders) AS parents_attempted,
        (SELECT count(DISTINCT o_custkey) FILTER (o_custkey % 3 <> 0) FROM orders) AS complete_runs, (SELECT count(DISTINCT o_custkey) FILTER (o_custkey % 3 = 0) FROM orders) AS incomplete_runs""",
}
