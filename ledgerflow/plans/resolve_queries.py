"""Queries on cohorts, merges, components, crosswalks and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import classify
from ledgerflow.functions.text import normalize_address, project_key, token
from ledgerflow.operators import cohort, identity, resolve
from ledgerflow.plans.snapshots import CTE, snapshots, table


def cohort_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = identity.with_identity(snapshots(spark, sf_dir))
    out = cohort.cohorts(seen, ("source_name", "status", "event_date", "planned_end"))
    return out.withColumn("event_month", F.substring("event_date", 1, 7))


def monthly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort_table(spark, sf_dir).groupBy("event_month").agg(F.count("*").alias("records"), F.count_if("currently_observed").alias("current"))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a shipping date, an order date and a plan, each missing for some."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.col("l_orderkey")
    day = lambda c: F.col(c).cast("date")
    return rows.select(
        "l_orderkey", "l_linenumber", F.lower("o_orderpriority").alias("source_name"),
        F.when(key % 5 != 0, day("l_shipdate")).alias("shipped"),
        F.when(key % 7 != 0, day("o_orderdate")).alias("ordered"),
        F.when(key % 3 == 0, F.date_add(day("l_shipdate"), 400)).alias("planned"),
    )


def _hierarchy() -> tuple:
    s, o, p = (("shipped", "l_shipdate", F.col("shipped")), ("ordered", "o_orderdate", F.col("ordered")), ("planned_delivery", "l_shipdate", F.col("planned")))
    return {"1-urgent": [s, o], "5-low": [p, s]}, [o, s, p]


def event_date_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = cohort.event_date(F.col("source_name"), *_hierarchy())
    rows = _dated(spark, sf_dir).withColumn("e", chosen).withColumn("d", F.col("e.date"))
    rows = rows.withColumn("p", F.coalesce("e.planned", F.lit(False)))
    rows = cohort.scoped(rows, "d", "p", F.to_date(F.lit("1998-06-30")), F.to_date(F.lit("1992-06-01")))
    return rows.groupBy("source_name", F.coalesce("e.type", F.lit("none")).alias("event_type"), "scope").agg(
        F.count("*").alias("n"), F.date_format(F.min("d"), "yyyy-MM-dd").alias("first"), F.date_format(F.max("d"), "yyyy-MM-dd").alias("last")
    )


def planned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose planned end lies behind a date, by month, as each snapshot has it."""
    base = snapshots(spark, sf_dir).select("snapshot_date", F.to_date("planned_end").alias("d"), F.lit(True).alias("plan"))
    out = cohort.scoped(base, "d", "plan", F.to_date(F.lit("1996-12-31")), F.to_date(F.lit("1993-01-01")))
    return out.groupBy("snapshot_date", "scope", "event_month").agg(F.count("*").alias("n"))


def monthly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = snapshots(spark, sf_dir).withColumn("month", F.substring("event_date", 1, 7))
    return cohort.monthly_index(seen, "month", "source_name", "status")


def dense_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by the month of their last order; few stopped early, so that months lack."""
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
    return cohort.dense_months(last.groupBy(F.date_format("d", "yyyy-MM").alias("month")).agg(F.count("*").alias("n")), "month", "n")


def year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months, years and the total in one pass."""
    rows = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return rows.rollup("year", "month").agg(F.count("*").alias("n"))


def temporal_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dated(spark, sf_dir)
    label = classify.temporal_label(F.col("shipped"), F.to_date(F.lit("1995-06-17")))
    labels = spark.createDataFrame([("retrospective",), ("prospective",), ("unknown",), ("conflicting",)], "label string")
    counted = rows.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    return labels.join(counted, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


def stage_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    status = F.element_at(F.array(*[F.lit(x) for x in ("Permit Issued", "Final Inspection", "Under Construction", "Withdrawn", "Review")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    out = part.withColumn("s", classify.stage(status, F.col("p_partkey") % 2 == 0))
    title = F.concat_ws(" ", F.when(F.col("p_partkey") % 4 == 0, "Demolition"), F.when(F.col("p_partkey") % 8 == 0, "and rebuild"), "p_name")
    kind = classify.activity_class(title, title, F.when(F.col("p_size") > 45, F.col("p_size").cast("double")))
    return out.groupBy("s.stage", "s.basis", "s.confidence", kind.alias("activity_class")).agg(F.count("*").alias("n"))


def evidence_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    grade = classify.evidence_grade(F.col("o_orderstatus") == "F", key % 3 == 0, key % 5 == 0, key % 7 == 0)
    return o.withColumn("g", grade).groupBy("g.grade", "g.basis").agg(F.count("*").alias("n"))


def normalize_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers in one schema."""
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source_name"), F.col("c_custkey").alias("id"), F.upper("c_name").alias("title"), F.col("c_nationkey").alias("place"), F.round("c_acctbal", 2).alias("amount"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("source_name"), F.col("s_suppkey").alias("id"), F.upper("s_name").alias("title"), F.col("s_nationkey").alias("place"), F.round("s_acctbal", 2).alias("amount"))
    return c.unionByName(s)


def neighbourhood_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("place"), "n_name")
    rows = normalize_union(spark, sf_dir).join(nation, "place", "left")
    return rows.groupBy(F.coalesce("n_name", F.lit("Unknown")).alias("neighbourhood"), "source_name").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_brand", "p_type").alias("title"),
        F.concat(F.lit("layer"), (F.col("p_partkey") % 3).cast("string")).alias("layer"), (F.col("p_partkey") % 50).alias("activity"),
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_name")).alias("name"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).otherwise("").alias("brand"), "p_size",
    )


def priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of one activity merged by the priority of their layers."""
    f = _features(spark, sf_dir)
    order = F.struct((3 - F.substring("layer", 6, 1).cast("int")).alias("p"), (-F.col("id")).alias("i"))
    return resolve.merged_by(f, "activity", order, ("name", "brand"), ("p_size",), ("layer",))


def last_nonblank_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("date").alias("day"), F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"), F.when(F.col("event_id") % 5 == 0, F.col("props")).alias("props"))
    out = resolve.last_nonblank(e, "user_id", ("event_type", "props"), ("day", "event_id"), "day")
    text = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return out.select("user_id", "event_type", "props", "component_count", text("first_observed"), text("last_observed"))


def dedup_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat("snapshot_date", F.lit("|"), token(F.when(F.col("native_id") != "N/A", F.col("native_id"))))
    out = resolve.dedup_audit(snapshots(spark, sf_dir), key, [F.desc("event_date"), F.col("object_id")])
    return out.select("snapshot_date", "object_id", "audit_key", "status")


def components_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.title_components(_features(spark, sf_dir), "id", project_key(F.col("title")), "layer")


def part_supplier_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the graph of all parts and suppliers that line items link."""
    items = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b")).distinct()
    return resolve.connected(items)


def part_supplier_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components of that graph: parts, suppliers and different links of each."""
    nodes = part_supplier_components(spark, sf_dir)
    links = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2).alias("node"), "l_suppkey").distinct().groupBy("node").agg(F.count("*").alias("links"))
    per = nodes.join(links, "node", "left").groupBy("component")  # a supplier has no links of its own here
    return per.agg(F.count_if(F.col("node") % 2 == 0).alias("parts"), F.count_if(F.col("node") % 2 == 1).alias("suppliers"), F.sum("links").alias("links"))


def _portal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    street = F.element_at(F.array(*[F.lit(x) for x in ("North Franklin Street", "Bay Avenue", "East Palm Road", "Harbor Drive")]), (key % 4 + 1).cast("int"))
    address = F.concat_ws(" ", (key % 240 + 100).cast("string"), street)
    day = F.date_add(F.to_date(F.lit("2026-01-01")), (key % 90).cast("int"))
    left = c.select(
        key.alias("id"), token(F.when(key % 4 == 0, F.concat(F.lit("rec "), key.cast("string")))).alias("number"), token(F.when(key % 6 == 1, F.concat(F.lit("P-"), (key % 40).cast("string")))).alias("parcel"),
        normalize_address(address).alias("address"), day.alias("day"),
    )
    typo = F.regexp_replace(F.regexp_replace(address, "Avenue", "Avenu"), "North", "N")
    right = c.select(
        (key + 1_000_000).alias("id"), token(F.when(key % 8 == 0, F.concat(F.lit("REC-"), key.cast("string")))).alias("number"), token(F.when(key % 10 == 4, F.concat(F.lit("P"), (key % 40).cast("string")))).alias("parcel"),
        normalize_address(typo).alias("address"), F.date_add(day, (key % 80).cast("int")).alias("day"),
    )
    return left, right


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.crosswalk(*_portal(spark, sf_dir))


def _integration(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    core = p.where("p_partkey % 4 <> 3").select(F.concat(F.lit("act-"), key.cast("string")).alias("activity_id"), F.when(key % 2 == 0, F.col("p_name")).alias("title"), F.lit("").alias("kind"))
    links = p.where("p_partkey % 4 <> 3").select((key + F.when(key % 5 == 0, 1).otherwise(0)).cast("string").alias("number"), F.concat(F.lit("act-"), key.cast("string")).alias("activity_id"))
    incoming = p.select(key.cast("string").alias("number"), F.upper("p_name").alias("title"), F.col("p_type").alias("kind"))
    return resolve.integrate(core, links, incoming, "activity_id", ("title", "kind"))


def integrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integration(spark, sf_dir)[0]


def integrate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integration(spark, sf_dir)[1]


def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.candidate_pairs(_features(spark, sf_dir), "id", {"same_title": F.col("title"), "same_brand_and_size": F.concat_ws("|", "brand", "p_size", "layer")})


def reconcile_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).where("k % 3 <> 0")
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).where("k % 4 <> 0")
    return resolve.reconcile(a, b, "k")


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.when(F.col("event_id") % 4 == 0, F.col("props")).alias("props"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("seen"), F.col("event_id") % 2 == 0)
    e = e.toDF("user_id", "event_type", "props", "seen", "first_half")
    nothing = e.limit(0).select("user_id", "event_type", "props", F.col("seen").alias("first_observed"), F.col("seen").alias("last_observed"))
    half = resolve.upsert(nothing, e.where("first_half"), "user_id", ("event_type", "props"), "seen")
    return resolve.upsert(half, e.where("not first_half"), "user_id", ("event_type", "props"), "seen")


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    reviews = labels.join(docs, "doc_id").select("doc_id", "lang", F.when(F.col("doc_id") % 3 == 0, "moved").otherwise(F.col("source")).alias("source"), "quality")
    return resolve.carry_forward(reviews, docs, "doc_id", ("lang", "source"), ("quality",))


def key_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.key_multiplicity(table(spark, sf_dir, "lineitem"), "l_partkey", ("l_suppkey", "l_returnflag", "l_linestatus"))


QUERIES = {
    f.__name__: f
    for f in (
        cohort_table, monthly_events, event_date_hierarchy, planned_events, monthly_index, dense_series, year_rollup, temporal_label, stage_class, evidence_grade,
        normalize_union, neighbourhood_summary, priority_merge, last_nonblank_merge, dedup_audit, components_aliases, part_supplier_components, part_supplier_graph, crosswalk, integrate,
        integrate_audit, candidate_pairs, reconcile_outer, upsert_latest, carry_forward, key_multiplicity,
    )
}

_COHORT = CTE + """, coh AS (
  SELECT record_identity, min(snapshot_date) AS first_observed, max(snapshot_date) AS last_observed, count(DISTINCT snapshot_date) AS observations,
    max(snapshot_date) = (SELECT max(snapshot_date) FROM snap) AS currently_observed, arg_max(source_name, snapshot_date) AS source_name, arg_max(status, snapshot_date) AS status,
    arg_max(event_date, snapshot_date) AS event_date, arg_max(planned_end, snapshot_date) AS planned_end, left(arg_max(event_date, snapshot_date), 7) AS event_month
  FROM snap GROUP BY record_identity)"""
_DATED = """WITH dated AS (
  SELECT lower(o_orderpriority) AS source_name, CASE WHEN l_orderkey % 5 <> 0 THEN l_shipdate::DATE END AS shipped, CASE WHEN l_orderkey % 7 <> 0 THEN o_orderdate::DATE END AS ordered,
    CASE WHEN l_orderkey % 3 = 0 THEN l_shipdate::DATE + 400 END AS planned FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_FEATURES = """WITH f AS (
  SELECT p_partkey AS id, p_brand || ' ' || p_type AS title, 'layer' || (p_partkey % 3)::VARCHAR AS layer, p_partkey % 50 AS activity,
    CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS name, CASE WHEN p_partkey % 3 <> 0 THEN p_brand ELSE '' END AS brand, p_size FROM part)"""
_PORTAL = """WITH c AS (
  SELECT c_custkey AS k, (c_custkey % 240 + 100)::VARCHAR AS house, ['N FRANKLIN ST', 'BAY AVE', 'E PALM RD', 'HARBOR DR'][c_custkey % 4 + 1] AS street,
    DATE '2026-01-01' + (c_custkey % 90)::INTEGER AS d FROM customer),
a AS (SELECT k AS id, CASE WHEN k % 4 = 0 THEN 'REC' || k END AS number, CASE WHEN k % 6 = 1 THEN 'P' || (k % 40) END AS parcel, house || ' ' || street AS address, d AS day FROM c),
b AS (SELECT k + 1000000 AS id, CASE WHEN k % 8 = 0 THEN 'REC' || k END AS number, CASE WHEN k % 10 = 4 THEN 'P' || (k % 40) END AS parcel,
  house || ' ' || replace(street, 'BAY AVE', 'BAY AVENU') AS address, d + (k % 80)::INTEGER AS day FROM c),
p AS (
  SELECT a.id AS l, b.id AS r, 1.0::DOUBLE AS score, 'exact_number' AS method FROM a JOIN b ON a.number = b.number
  UNION ALL SELECT a.id, b.id, 0.95, 'exact_parcel' FROM a JOIN b ON a.parcel = b.parcel
  UNION ALL SELECT a.id, b.id, 0.9, 'exact_address_compatible_date' FROM a JOIN b ON a.address = b.address AND abs(a.day - b.day) <= 45
  UNION ALL SELECT a.id, b.id, round(0.55 + 0.25 * likeness, 3), 'similar_address_candidate'
    FROM a JOIN b ON split_part(a.address, ' ', 1) = split_part(b.address, ' ', 1) AND a.address <> b.address AND abs(a.day - b.day) <= 45
      -- different addresses of one house begin alike here, so the shorter one is the only common block
      CROSS JOIN LATERAL (SELECT CASE WHEN starts_with(b.address, a.address) OR starts_with(a.address, b.address) THEN 2 * least(length(a.address), length(b.address)) / (length(a.address) + length(b.address))::DOUBLE END) x(likeness) WHERE likeness >= 0.84),
best AS (SELECT l, r, max(score) AS score, arg_max(method, (score, method)) AS method FROM p GROUP BY l, r),
top AS (SELECT l, count(*) AS targets, min(r) AS r, max(score) AS score, max(method) AS method FROM (SELECT *, max(score) OVER (PARTITION BY l) AS top FROM best) WHERE score = top GROUP BY l)"""
#: Labels that spread and jump in ten rounds over all links.
_COMPONENTS = (
    """WITH e AS (SELECT DISTINCT l_partkey * 2 AS a, l_suppkey * 2 + 1 AS b FROM lineitem), w AS MATERIALIZED (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e),
    l0 AS MATERIALIZED (SELECT u AS node, least(u, min(v)) AS c FROM w GROUP BY u), """
    + ", ".join(f"l{k} AS MATERIALIZED (SELECT u AS node, least(min(x.c), min(y.c)) AS c FROM w JOIN l{k - 1} x ON w.v = x.node JOIN l{k - 1} y ON w.u = y.node GROUP BY u)" for k in range(1, 11))
)
_INTEGRATION = """WITH core AS (SELECT 'act-' || p_partkey AS activity_id, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS title FROM part WHERE p_partkey % 4 <> 3),
links AS (SELECT (p_partkey + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END)::VARCHAR AS number, 'act-' || p_partkey AS activity_id FROM part WHERE p_partkey % 4 <> 3),
incoming AS (SELECT p_partkey::VARCHAR AS number, upper(p_name) AS title, p_type AS kind FROM part),
audit AS (SELECT i.*, t.targets, t.sole, CASE WHEN t.targets IS NULL THEN 'appended' WHEN t.targets = 1 THEN 'enriched' ELSE 'held' END AS outcome
  FROM incoming i LEFT JOIN (SELECT number, count(DISTINCT activity_id) AS targets, min(activity_id) AS sole FROM links GROUP BY number) t ON i.number = t.number)"""

ORACLE_SQL = {
    "cohort_table": _COHORT + " SELECT * FROM coh",
    "monthly_events": _COHORT + " SELECT event_month, count(*) AS records, count(*) FILTER (currently_observed) AS current FROM coh GROUP BY event_month",
    "event_date_hierarchy": _DATED + """, e AS (SELECT *, CASE source_name
          WHEN '1-urgent' THEN CASE WHEN shipped IS NOT NULL THEN 'shipped' WHEN ordered IS NOT NULL THEN 'ordered' ELSE 'none' END
          WHEN '5-low' THEN CASE WHEN planned IS NOT NULL THEN 'planned_delivery' WHEN shipped IS NOT NULL THEN 'shipped' ELSE 'none' END
          ELSE CASE WHEN ordered IS NOT NULL THEN 'ordered' WHEN shipped IS NOT NULL THEN 'shipped' WHEN planned IS NOT NULL THEN 'planned_delivery' ELSE 'none' END END AS event_type FROM dated),
        d AS (SELECT *, CASE event_type WHEN 'shipped' THEN shipped WHEN 'ordered' THEN ordered WHEN 'planned_delivery' THEN planned END AS d FROM e)
        SELECT source_name, event_type, CASE WHEN d IS NULL THEN 'undated' WHEN d < DATE '1992-06-01' THEN 'before_start' WHEN d <= DATE '1998-06-30' THEN 'event' WHEN event_type = 'planned_delivery' THEN 'plan' ELSE 'future_fault' END AS scope,
          count(*) AS n, strftime(min(d), '%Y-%m-%d') AS first, strftime(max(d), '%Y-%m-%d') AS last FROM d GROUP BY ALL""",
    "planned_events": CTE + """ SELECT CASE WHEN d < DATE '1993-01-01' THEN 'before_start' WHEN d <= DATE '1996-12-31' THEN 'event' ELSE 'plan' END AS scope, strftime(d, '%Y-%m') AS event_month, snapshot_date, count(*) AS n
        FROM (SELECT snapshot_date, planned_end::DATE AS d FROM snap_raw) GROUP BY ALL""",
    "monthly_index": CTE + """, s AS (SELECT left(event_date, 7) AS month, source_name, status FROM snap_raw)
        SELECT month, sum(n)::BIGINT AS rows, string_agg(source_name || '=' || n, ';' ORDER BY source_name) AS by_source,
          (SELECT string_agg(status || '=' || m, ';' ORDER BY status) FROM (SELECT status, count(*) AS m FROM s s2 WHERE s2.month = t.month GROUP BY status)) AS by_type
        FROM (SELECT month, source_name, count(*) AS n FROM s GROUP BY ALL) t GROUP BY month""",
    "dense_series": """WITH c AS (SELECT max(o_orderdate) AS d FROM orders GROUP BY o_custkey), b AS (SELECT date_trunc('month', d)::DATE AS m, count(*) AS n FROM c GROUP BY ALL)
        SELECT strftime(s.m, '%Y-%m') AS month, coalesce(b.n, 0) AS n FROM (SELECT unnest(generate_series((SELECT min(m) FROM b), (SELECT max(m) FROM b), INTERVAL 1 MONTH))::DATE AS m) s LEFT JOIN b ON s.m = b.m""",
    "year_rollup": "SELECT year, month, count(*) AS n FROM (SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y-%m') AS month FROM orders) GROUP BY ROLLUP (year, month)",
    "temporal_label": _DATED + """, n AS (SELECT CASE WHEN shipped IS NULL THEN 'unknown' WHEN shipped < DATE '1995-06-17' THEN 'retrospective' ELSE 'prospective' END AS label, count(*) AS n FROM dated GROUP BY ALL)
        SELECT l.label, coalesce(n, 0) AS n FROM (VALUES ('retrospective'), ('prospective'), ('unknown'), ('conflicting')) l(label) LEFT JOIN n ON l.label = n.label""",
    "stage_class": """WITH p AS (SELECT *, p_partkey % 5 AS s, lower(concat_ws(' ', CASE WHEN p_partkey % 4 = 0 THEN 'Demolition' END, CASE WHEN p_partkey % 8 = 0 THEN 'and rebuild' END, p_name)) AS title FROM part)
        SELECT CASE s WHEN 0 THEN 'permit_or_funding_approved' WHEN 1 THEN 'completed_or_closeout' WHEN 2 THEN 'construction_or_inspection' WHEN 3 THEN CASE WHEN p_partkey % 2 = 0 THEN 'planning_review' ELSE 'preconstruction_or_unknown' END ELSE CASE WHEN p_partkey % 2 = 0 THEN 'planning_review' ELSE 'preconstruction_or_unknown' END END AS stage,
          CASE s WHEN 0 THEN 'authorization_only' WHEN 1 THEN 'official_status' WHEN 2 THEN 'official_status' ELSE CASE WHEN p_partkey % 2 = 0 THEN 'application_only' ELSE 'official_record_only' END END AS basis,
          CASE WHEN s IN (1, 2) THEN 'medium' ELSE 'low' END AS confidence,
          CASE WHEN regexp_matches(title, '\\b(demo|demolition|demolish)\\b') AND NOT regexp_matches(title, '\\b(addition|rebuild)\\b') THEN 'demolition' WHEN p_size > 45 OR regexp_matches(title, '\\b(rebuild|addition|renovation)\\b') THEN 'building_construction' ELSE 'other_permitted_work' END AS activity_class,
          count(*) AS n FROM p GROUP BY ALL""".replace("WHEN 3 THEN CASE WHEN p_partkey % 2 = 0 THEN 'planning_review' ELSE 'preconstruction_or_unknown' END ELSE", "WHEN 3 THEN 'inactive' ELSE").replace("WHEN 2 THEN 'official_status' ELSE CASE", "WHEN 2 THEN 'official_status' WHEN 3 THEN 'official_status' ELSE CASE").replace("s IN (1, 2)", "s IN (1, 2, 3)"),
    "evidence_grade": """SELECT CASE WHEN o_orderstatus = 'F' THEN 'A' WHEN o_orderkey % 3 = 0 THEN 'B' WHEN o_orderkey % 5 = 0 THEN 'C' WHEN o_orderkey % 7 = 0 THEN 'D' ELSE 'U' END AS grade,
        CASE WHEN o_orderstatus = 'F' THEN 'completion_reported' WHEN o_orderkey % 3 = 0 THEN 'work_reported' WHEN o_orderkey % 5 = 0 THEN 'authorization_reported' WHEN o_orderkey % 7 = 0 THEN 'application_reported' ELSE 'record_only' END AS basis, count(*) AS n FROM orders GROUP BY ALL""",
    "normalize_union": """SELECT 'customer' AS source_name, c_custkey AS id, upper(c_name) AS title, c_nationkey AS place, round(c_acctbal, 2) AS amount FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, upper(s_name), s_nationkey, round(s_acctbal, 2) FROM supplier""",
    "neighbourhood_summary": """SELECT coalesce(n_name, 'Unknown') AS neighbourhood, source_name, count(*) AS n, round(sum(amount), 2) AS amount FROM (
        SELECT 'customer' AS source_name, c_nationkey AS place, round(c_acctbal, 2) AS amount FROM customer UNION ALL SELECT 'supplier', s_nationkey, round(s_acctbal, 2) FROM supplier) u
        LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) n ON place = n_nationkey GROUP BY ALL""",
    "priority_merge": _FEATURES + """ SELECT activity, arg_max(name, (3 - right(layer, 1)::INTEGER, -id)) FILTER (name <> '') AS name, arg_max(brand, (3 - right(layer, 1)::INTEGER, -id)) FILTER (brand <> '') AS brand,
        max(p_size) AS p_size, string_agg(DISTINCT layer, ';' ORDER BY layer) AS layer, count(*) AS component_count FROM f GROUP BY activity""",
    "last_nonblank_merge": """SELECT user_id, arg_max(event_type, (ts::DATE, event_id)) FILTER (event_id % 3 <> 0) AS event_type, arg_max(props, (ts::DATE, event_id)) FILTER (event_id % 5 = 0) AS props,
        count(*) AS component_count, strftime(min(ts), '%Y-%m-%d') AS first_observed, strftime(max(ts), '%Y-%m-%d') AS last_observed FROM events GROUP BY user_id""",
    "dedup_audit": CTE + """, k AS (SELECT *, CASE WHEN native_id <> 'N/A' THEN snapshot_date || '|' || regexp_replace(upper(native_id), '[^A-Z0-9]', '', 'g') END AS audit_key FROM snap_raw)
        SELECT snapshot_date, object_id, audit_key, CASE WHEN audit_key IS NULL THEN 'missing_key' WHEN row_number() OVER (PARTITION BY audit_key ORDER BY event_date DESC, object_id) = 1 THEN 'kept' ELSE 'duplicate' END AS status FROM k""",
    "components_aliases": _FEATURES + """, t AS (SELECT id, layer, trim(regexp_replace(upper(title), '[^A-Z0-9]+', ' ', 'g')) AS t FROM f), g AS (SELECT t, min(id) AS component FROM t GROUP BY t HAVING count(DISTINCT layer) >= 2)
        SELECT id, component, 'grp-' || left(sha1(component::VARCHAR), 16) AS alias_id FROM t JOIN g USING (t)""",
    "part_supplier_components": _COMPONENTS + " SELECT node, c AS component FROM l10",
    "part_supplier_graph": _COMPONENTS + ", n AS (SELECT a AS node, count(*) AS links FROM e GROUP BY a) SELECT c AS component, count(*) FILTER (l10.node % 2 = 0) AS parts, count(*) FILTER (l10.node % 2 = 1) AS suppliers, sum(links)::BIGINT AS links FROM l10 LEFT JOIN n USING (node) GROUP BY c",
    "crosswalk": _PORTAL + """ SELECT a.id, CASE WHEN targets = 1 THEN r END AS target_id, coalesce(targets, 0) AS targets,
        CASE WHEN r IS NULL THEN 'none' WHEN targets > 1 THEN method || '_ambiguous' ELSE method END AS method, round(coalesce(score, 0), 3) AS score,
        CASE WHEN r IS NULL THEN 'unmatched' WHEN targets > 1 OR score < 0.9 THEN 'candidate' ELSE 'matched' END AS status, coalesce(r IS NOT NULL AND (targets > 1 OR score < 0.9), false) AS review_required FROM a LEFT JOIN top ON a.id = l""",
    "integrate": _INTEGRATION + """, o AS (SELECT sole AS activity_id, arg_min(title, number) AS title, arg_min(kind, number) AS kind, count(*) AS added FROM audit WHERE outcome = 'enriched' GROUP BY sole)
        SELECT c.activity_id, coalesce(c.title, o.title) AS title, o.kind, 1 + coalesce(added, 0) AS component_count, 'core' AS origin FROM core c LEFT JOIN o USING (activity_id)
        UNION ALL SELECT 'new-' || left(sha1(number), 16), title, kind, 1, 'appended' FROM audit WHERE outcome = 'appended'""",
    "integrate_audit": _INTEGRATION + " SELECT number, outcome, coalesce(targets, 0) AS targets FROM audit",
    "candidate_pairs": _FEATURES + """, l AS (SELECT id, 'same_title' AS reason, title AS value FROM f UNION ALL SELECT id, 'same_brand_and_size', concat_ws('|', brand, p_size, layer) FROM f),
        s AS (SELECT * FROM l JOIN (SELECT reason, value FROM l GROUP BY ALL HAVING count(*) BETWEEN 2 AND 25) g USING (reason, value))
        SELECT x.id AS a, y.id AS b, string_agg(DISTINCT x.reason, ';' ORDER BY x.reason) AS reasons, false AS merge_applied FROM s x JOIN s y ON x.reason = y.reason AND x.value = y.value AND x.id < y.id GROUP BY ALL""",
    "reconcile_outer": """WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey % 3 <> 0 GROUP BY k), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_nationkey % 4 <> 0 GROUP BY k)
        SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' WHEN a.n > 1 OR b.n > 1 THEN 'ambiguous' ELSE 'matched' END AS status FROM a FULL JOIN b ON a.k = b.k""",
    "upsert_latest": """WITH e AS (SELECT user_id, event_type, CASE WHEN event_id % 4 = 0 THEN props END AS props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS seen, event_id % 2 AS half FROM events),
        h AS (SELECT user_id, half, arg_max(event_type, seen) AS event_type, arg_max(props, seen) AS props, min(seen) AS a, max(seen) AS b FROM e GROUP BY ALL)
        SELECT coalesce(x.user_id, y.user_id) AS user_id, coalesce(y.event_type, x.event_type) AS event_type, coalesce(y.props, x.props) AS props, least(x.a, y.a) AS first_observed, greatest(x.b, y.b) AS last_observed
        FROM (SELECT * FROM h WHERE half = 0) x FULL JOIN (SELECT * FROM h WHERE half = 1) y ON x.user_id = y.user_id""",
    "carry_forward": """SELECT d.doc_id, d.lang, d.source, CASE WHEN d.doc_id % 3 <> 0 THEN quality END AS quality, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN d.doc_id % 3 = 0 THEN 'changed' ELSE 'carried' END AS carried
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "key_multiplicity": """SELECT l_partkey, count(*) AS rows, concat_ws(';', CASE WHEN count(DISTINCT l_suppkey) > 1 THEN 'l_suppkey' END, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'l_returnflag' END, CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'l_linestatus' END) AS differing
        FROM lineitem GROUP BY l_partkey HAVING count(*) > 1""",
}
