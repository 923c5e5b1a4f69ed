"""Queries on what a release rests on: per-source schemas, ids rewritten and redirected, derived pairs, checks of many kinds, identity rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import classify, dates, ids
from ledgerflow.operators import analysis, audit, diff, identity, quality, resolve, spatial, tracking
from ledgerflow.plans import check_queries, resolve_queries
from ledgerflow.plans.change_queries import change_rows
from ledgerflow.plans.snapshots import CHANGES, VALUES, snapshots, table


def _text(c: str) -> Column:
    return F.col(c).cast("string")


# --- one schema for many sources ---------------------------------------------------------------

_SCHEMA = ("source_name", "native_id", "title", "status", "amount", "event_date")


def normalized_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, suppliers, parts and orders in one schema, each by a rule of its own; counts and sums per source and status."""
    none = F.lit(None).cast("string")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    rules = {
        "customer": ("c_custkey", F.upper("c_name"), F.lower("c_mktsegment"), F.col("c_acctbal"), none),
        "supplier": ("s_suppkey", F.upper("s_name"), none, F.col("s_acctbal"), none),
        "part": ("p_partkey", F.concat_ws(" ", "p_brand", "p_name"), F.lower("p_type"), F.col("p_retailprice"), none),
        "orders": ("o_orderkey", F.concat(F.lit("ORD-"), _text("o_orderkey")), F.col("o_orderstatus"), F.col("o_totalprice"), day("o_orderdate")),
    }
    branches = []
    for name, (key, title, status, amount, event) in rules.items():
        values = (F.lit(name), _text(key), title, status, F.round(amount, 2).cast("decimal(18,2)"), event)
        branches.append(table(spark, sf_dir, name).select(*[v.alias(c) for v, c in zip(values, _SCHEMA, strict=True)]))
    every = reduce(DataFrame.unionByName, branches)
    return every.groupBy("source_name", "status").agg(
        F.count("*").alias("rows"), F.countDistinct("native_id").alias("ids"), F.sum("amount").cast("double").alias("amount"), F.min("title").alias("first_title"), F.max("event_date").alias("last_event")
    )


def renamed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the ids of components in place of those of the parts that they join."""
    aliases = resolve_queries.components_aliases(spark, sf_dir).select(F.col("id").alias("part"), "alias_id")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), "l_quantity")
    return resolve.renamed(rows, aliases, "part").groupBy("part").agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))


def redirected_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders upserted under the id that their public number is known by; numbers are written in several ways."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    existing = orders.where(key % 3 != 0).select(F.concat(F.lit("id-"), _text("o_orderkey")).alias("record_id"), F.lit("old").alias("status"), F.lit("1995-01-01").alias("first_observed"), F.lit("1995-06-01").alias("last_observed"))
    known = orders.where(key % 3 != 0).select(F.concat(F.lit("ORD"), _text("o_orderkey")).alias("number"), F.concat(F.lit("id-"), _text("o_orderkey")).alias("record_id"))
    number = F.regexp_replace(F.upper(F.col("raw")), "[^A-Z0-9]", "")
    incoming = orders.select(F.concat(F.lit("tmp-"), _text("o_orderkey")).alias("record_id"), F.concat(F.lit(" ord-"), _text("o_orderkey")).alias("raw"), F.when(key % 2 == 0, F.col("o_orderstatus")).otherwise("").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen"))
    return resolve.upsert(existing, resolve.redirected(incoming, known, "record_id", number), "record_id", ("status",), "seen")


def integrate_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts integrated, and integrated again into the result: what was appended is met again under its id, and ids stay unique."""
    part = table(spark, sf_dir, "part")
    core = part.where("p_partkey % 4 = 0").select(F.concat(F.lit("act-"), _text("p_partkey")).alias("activity_id"), F.lit("").alias("title"))
    links = part.where("p_partkey % 4 = 0").select(_text("p_partkey").alias("number"), F.concat(F.lit("act-"), _text("p_partkey")).alias("activity_id"))
    incoming = part.select(_text("p_partkey").alias("number"), F.upper("p_name").alias("title"))
    once = resolve.integrate(core, links, incoming, "activity_id", ("title",))[0].select("activity_id", "title")
    twice, said = resolve.integrate(once, links, incoming, "activity_id", ("title",))
    checks = quality.unique(twice, ["activity_id"], "ids_unique").select("passed").withColumnRenamed("passed", "unique")
    return said.groupBy("outcome").agg(F.count("*").alias("rows")).join(F.broadcast(checks))  # one row


# --- changes -----------------------------------------------------------------------------------


def diff_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of all consecutive snapshots, the pairs taken from the catalog (a row per snapshot comes to the driver)."""
    catalog = tracking.described(snapshots(spark, sf_dir)).select("snapshot_date")
    pairs = [(r.before_date, r.after_date) for r in tracking.consecutive(catalog).orderBy("after_date").collect()]
    return diff.summary(change_rows(spark, sf_dir, pairs))


def planned_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A start and an end that move together are one change that lists both."""
    rows = identity.with_identity(snapshots(spark, sf_dir).withColumn("planned_start", F.date_format(F.date_sub("planned_end", 30), "yyyy-MM-dd")))
    late = F.when((F.col("snapshot_date") > "2026-08-31") & (F.col("object_id").cast("long") % 10 == 3), "2030-01-01")
    rows = rows.withColumn("planned_start", F.coalesce(late, "planned_start"))
    both = diff.paired(rows, [("2026-08-31", "2026-09-30")], (*VALUES, "planned_start"))
    out = diff.changes(both).where("change_type = 'planned_date_changed'")
    return out.groupBy("source_name", "changed_fields").agg(F.count("*").alias("changes"))


def link_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and malformed links of change rows, made of their ids."""
    n = F.conv(F.substring(F.sha1("record_identity"), 1, 4), 16, 10).cast("int")
    link = F.when(n % 5 == 0, " ").when(n % 5 == 1, "ftp://x/y").when(n % 5 == 2, "https://").otherwise(F.concat(F.lit("https://example.org/"), F.col("change_type")))
    return analysis.link_quality(change_rows(spark, sf_dir).withColumn("source_url", link))


# --- places ------------------------------------------------------------------------------------


def best_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each point the containing square, else the nearest corner, with the number of other candidates."""
    points, squares = check_queries._points(spark, sf_dir), check_queries._squares(spark, sf_dir)
    corners = squares.select("s_id", F.col("ring")[0][0].alias("s_lon"), F.col("ring")[0][1].alias("s_lat"))
    # squares of one point are equally good but for their id, so they are counted where they are found
    inside = spatial.contains(points, squares, 0.5).groupBy("p_id").agg(F.count("*").alias("n"), F.min("s_id").alias("s_id"))
    inside = inside.select("p_id", "s_id", "n", F.lit("containing").alias("method"), F.lit(0.0).alias("distance_m"))
    near = spatial.nearest(points, corners, 30000.0).select("p_id", "s_id", F.lit(1).cast("long").alias("n"), F.lit("nearest").alias("method"), F.round("distance_m", 1).alias("distance_m"))
    rank = F.when(F.col("method") == "containing", 1).otherwise(2)
    return spatial.prioritised(inside.unionByName(near), "p_id", "s_id", rank, F.col("distance_m"), F.col("n")).select("p_id", "s_id", "method", "distance_m", "alternatives")


# --- checks ------------------------------------------------------------------------------------


def release_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of ranges, coordinates, dates, coverage, classes and extracts over whole tables."""
    orders, items, part, customer = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part", "customer"))
    lon, lat = (F.col("c_custkey") % 361 - 180).cast("double"), F.when(F.col("c_custkey") % 50 == 0, F.lit(float("nan"))).otherwise((F.col("c_custkey") % 181 - 90).cast("double"))
    finite = ~F.isnan(lon) & ~F.isnan(lat)
    box = lon.between(-84, -81) & lat.between(26, 29)
    raw = F.when(F.col("o_orderkey") % 40 == 0, "1900-01-01").when(F.col("o_orderkey") % 41 == 0, "2020-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    day = dates.parse_date(raw, 1950, 2100)
    spans = items.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    title = F.concat_ws(" ", F.when(F.col("p_partkey") % 4 == 0, "Demolition"), "p_name")
    kind = classify.activity_class(title, title, F.lit(None).cast("double"))
    event = F.to_date("o_orderdate")
    past, plans = orders.where(event <= F.to_date(F.lit("1998-12-31"))), orders.where(event > F.to_date(F.lit("1998-12-31")))
    phases = [orders.where(F.col("o_orderkey") % 3 == k) for k in range(3)]
    return quality.together(
        [
            quality.rules(customer, {"finite_coordinates": finite, "inside_region": ~finite | box, "balance_range": quality.range_holds("c_acctbal", 0, 1e6)}),
            quality.rules(
                orders,
                {
                    "valid_dates": day.isNotNull(),
                    "no_sentinel_dates": raw != "1900-01-01",
                    "month_is_prefix": F.date_format("o_orderdate", "yyyy-MM-dd").startswith(F.date_format("o_orderdate", "yyyy-MM")),
                    "status_words": quality.words_hold("o_orderstatus", ("O", "F")),
                },
            ),
            quality.rule(spans, F.col("first") <= F.col("last"), "first_before_last"),
            quality.same_keys(orders.select(F.col("o_orderkey").alias("k")), items.select(F.col("l_orderkey").alias("k")), "k", "every_order_has_items"),
            quality.unique(orders, ["o_orderkey"], "orders_once"),
            quality.rule(part.withColumn("kind", kind), (F.col("kind") == "demolition") == (F.col("p_partkey") % 4 == 0), "class_fits_title"),
            quality.partition([past, plans], orders, "o_orderkey", "past_and_plans_make_all"),
            quality.rule(past, event <= F.to_date(F.lit("1998-12-31")), "no_plan_in_the_past"),
            quality.partition(phases, orders, "o_orderkey", "phases_make_all"),
            quality.disjoint(phases[0], phases[1], "o_orderkey", "phases_disjoint"),
        ]
    )


def design_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws of two studies of the orders: do probabilities, weights and quotas fit, and do the studies share rows?"""
    from ledgerflow.operators import sampling

    orders = table(spark, sf_dir, "orders")
    quota = {p: 20 for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")}
    first = sampling.stratified(orders, "o_orderkey", "o_orderpriority", quota, 42, "first")
    second = sampling.stratified(orders.join(first.select("o_orderkey"), "o_orderkey", "left_anti"), "o_orderkey", "o_orderpriority", quota, 42, "second")
    told = quality.sample_design(first, "o_orderpriority").unionByName(quality.sample_design(second, "o_orderpriority").withColumn("population", F.col("population") + 20))
    shared = quality.disjoint(first, second, "o_orderkey", "disjoint").select(F.col("passed").alias("disjoint"))
    return told.groupBy("o_orderpriority").agg(F.sum("drawn").alias("drawn"), F.max("population").alias("population"), F.bool_and("passed").alias("passed")).join(F.broadcast(shared))  # one row


# --- audits ------------------------------------------------------------------------------------


def tool_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.foreign_tools(table(spark, sf_dir, "events"), "user_id", "event_type", ["click", "view"])


def identity_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as pieces of evidence of some type and tier against the rules for them."""
    rules = spark.createDataFrame([("A", 2, True), ("N", 3, False)], "evidence_type string, least_tier int, needs_exact boolean")
    evidence = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("evidence_type"), (F.col("l_partkey") % 4 + 1).cast("int").alias("tier"), (F.col("l_suppkey") % 3 == 0).alias("exact"))
    return audit.identity_rules(evidence, rules, "l_orderkey").groupBy("evidence_type", "result").agg(F.count("*").alias("n"))


def claimed_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of the hash of a document's text or of its fields; some name the wrong one."""
    docs = table(spark, sf_dir, "documents").select(_text("doc_id").alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("file"), F.sha2(F.concat_ws("|", _text("doc_id"), F.coalesce("lang", F.lit(""))), 256).alias("fields"))
    n = F.col("path").cast("long")
    scope = F.when(n % 3 == 0, "fields").when(n % 7 == 0, "other").otherwise("file")
    claimed = F.when(n % 5 == 0, F.col("fields")).otherwise(F.col("file"))
    claims = docs.select(F.concat(F.lit("c"), F.col("path")).alias("claim_id"), scope.alias("scope"), F.col("path").alias("ref"), claimed.alias("claimed"))
    return audit.scoped_hashes(claims, docs.select("path", F.col("file").alias("sha256")), docs.select(F.col("path").alias("ref"), F.col("fields").alias("sha256")))


def primary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first date of a module's own order of fields, with its field and label against a boundary."""
    o = table(spark, sf_dir, "orders")
    key, base = F.col("o_orderkey"), F.to_date("o_orderdate")
    issued, opened, closed = F.when(key % 2 == 0, base), F.when(key % 3 == 0, F.date_add(base, 10)), F.when(key % 5 == 0, F.date_add(base, 20))
    building = dates.first_valid(("issued_date", issued), ("opened_date", opened), ("closed_date", closed))
    planning = dates.first_valid(("opened_date", opened), ("closed_date", closed), ("issued_date", issued))
    event = F.when(F.col("o_orderpriority") < "3", building).otherwise(planning)
    out = o.select(event.alias("e")).select("e.field", classify.temporal_label(F.col("e.date"), F.to_date(F.lit("1998-07-01"))).alias("label"), F.col("e.date").alias("d"))
    return out.groupBy("field", "label").agg(F.count("*").alias("n"), F.date_format(F.max("d"), "yyyy-MM-dd").alias("last"))


def stable_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of records from all parts of a composite key, or from the public number where one lacks."""
    key = F.col("o_orderkey")
    parts = [F.when(key % 3 != 0, _text("o_custkey")), F.col("o_orderstatus")]
    return table(spark, sf_dir, "orders").select("o_orderkey", ids.record_id(parts, F.concat(F.lit("ord "), _text("o_orderkey"))).alias("record_id"))


QUERIES = {
    f.__name__: f
    for f in (
        normalized_sources, renamed_ids, redirected_upsert, integrate_twice, diff_consecutive, planned_dates, link_quality, best_places, release_checks, design_checks, tool_audit,
        identity_evidence, claimed_hashes, primary_events, stable_children,
    )
}

ORACLE_SQL = {
    "normalized_sources": """WITH u AS (SELECT 'customer' AS source_name, c_custkey::VARCHAR AS k, upper(c_name) AS title, lower(c_mktsegment) AS status, c_acctbal AS a, NULL AS d FROM customer UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, upper(s_name), NULL, s_acctbal, NULL FROM supplier
          UNION ALL SELECT 'part', p_partkey::VARCHAR, p_brand || ' ' || p_name, lower(p_type), p_retailprice, NULL FROM part UNION ALL SELECT 'orders', o_orderkey::VARCHAR, 'ORD-' || o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') FROM orders)
        SELECT source_name, status, count(*) AS rows, count(DISTINCT k) AS ids, sum(round(a, 2)::DECIMAL(18,2))::DOUBLE AS amount, min(title) AS first_title, max(d) AS last_event FROM u GROUP BY ALL""",
    "renamed_ids": resolve_queries.ORACLE_SQL["components_aliases"].replace("SELECT id, component,", ", al AS (SELECT id, component,") + """) SELECT coalesce(alias_id, l_partkey::VARCHAR) AS part, count(*) AS rows, sum(l_quantity) AS quantity FROM lineitem LEFT JOIN al ON id = l_partkey GROUP BY ALL""",
    "redirected_upsert": """SELECT CASE WHEN o_orderkey % 3 <> 0 THEN 'id-' ELSE 'tmp-' END || o_orderkey AS record_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus WHEN o_orderkey % 3 <> 0 THEN 'old' END AS status,
        CASE WHEN o_orderkey % 3 <> 0 THEN least('1995-01-01', strftime(o_orderdate, '%Y-%m-%d')) ELSE strftime(o_orderdate, '%Y-%m-%d') END AS first_observed, CASE WHEN o_orderkey % 3 <> 0 THEN greatest('1995-06-01', strftime(o_orderdate, '%Y-%m-%d')) ELSE strftime(o_orderdate, '%Y-%m-%d') END AS last_observed FROM orders""",
    "integrate_twice": "SELECT CASE WHEN p_partkey % 4 = 0 THEN 'enriched' ELSE 'enriched_again' END AS outcome, count(*) AS rows, true AS \"unique\" FROM part GROUP BY ALL",
    "diff_consecutive": CHANGES + " SELECT before_date AS before_snapshot_date, after_date AS after_snapshot_date, source_name, change_type, semantic_type, count(*) AS change_rows, count(DISTINCT record_identity) AS records FROM changes GROUP BY ALL",
    "planned_dates": """WITH o AS (SELECT *, lower(o_orderpriority) AS source_name, o_orderkey % 11 = 0 AS moved, o_orderkey % 10 = 3 AS late, o_orderkey % 97 = 0 AS na, o_orderkey % 89 = 0 AS grp FROM orders WHERE o_orderkey % 23 NOT IN (1, 2))
        SELECT source_name, CASE WHEN moved THEN 'planned_start;planned_end' ELSE 'planned_start' END AS changed_fields, count(*) AS changes FROM o WHERE moved OR late GROUP BY ALL""",
    "link_quality": CHANGES + """, n AS (SELECT ('0x' || left(sha1(record_identity), 4))::INTEGER % 5 AS n FROM changes) SELECT count(*) FILTER (n = 0) AS blank_links, count(*) FILTER (n IN (1, 2)) AS malformed_links FROM n""",
    "best_places": check_queries.POINTS_SQL + """, inside AS (SELECT p_id, s_id FROM pt JOIN sq ON lon >= x AND lon < x + 0.5 AND lat >= y AND lat < y + 0.5),
        d AS (SELECT p_id, s_id, 6371000.0 * 2 * atan2(sqrt(a), sqrt(greatest(0, 1 - a))) AS m FROM (SELECT p_id, s_id, pow(sin(radians(y - lat) / 2), 2) + cos(radians(lat)) * cos(radians(y)) * pow(sin(radians(x - lon) / 2), 2) AS a FROM pt, sq)),
        near AS (SELECT p_id, arg_min(s_id, (m, s_id)) AS s_id, round(round(min(m), 3), 1) AS m FROM d WHERE m <= 30000 GROUP BY p_id),
        u AS (SELECT p_id, s_id, 1 AS r, 'containing' AS method, 0.0::DOUBLE AS m FROM inside UNION ALL SELECT p_id, s_id, 2, 'nearest', m FROM near)
        SELECT p_id, s_id, method, m AS distance_m, count(*) OVER (PARTITION BY p_id) - 1 AS alternatives FROM u QUALIFY row_number() OVER (PARTITION BY p_id ORDER BY r, m, s_id) = 1""",
    "release_checks": """WITH f AS (SELECT 'finite_coordinates' AS "check", count(*) FILTER (c_custkey % 50 = 0) AS faults FROM customer
        UNION ALL SELECT 'inside_region', count(*) FILTER (c_custkey % 50 <> 0 AND NOT (c_custkey % 361 - 180 BETWEEN -84 AND -81 AND c_custkey % 181 - 90 BETWEEN 26 AND 29)) FROM customer
        UNION ALL SELECT 'balance_range', count(*) FILTER (NOT (c_acctbal BETWEEN 0 AND 1e6)) FROM customer UNION ALL SELECT 'valid_dates', count(*) FILTER (o_orderkey % 40 = 0 OR o_orderkey % 41 = 0) FROM orders
        UNION ALL SELECT 'no_sentinel_dates', count(*) FILTER (o_orderkey % 40 = 0) FROM orders UNION ALL SELECT 'first_before_last', 0 UNION ALL SELECT 'month_is_prefix', count(*) FILTER (NOT starts_with(strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y-%m'))) FROM orders
        UNION ALL SELECT 'every_order_has_items', count(*) FROM (SELECT o_orderkey AS k FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON k = l WHERE k IS NULL OR l IS NULL
        UNION ALL SELECT 'orders_once', count(*) - count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'class_fits_title', count(*) FILTER (p_partkey % 4 = 0 AND regexp_matches(lower(p_name), '\\b(addition|remodel|renovation|alteration|repair|rebuild)\\b')) FROM part
        UNION ALL SELECT 'status_words', count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM orders UNION ALL SELECT 'past_and_plans_make_all', count(*) FILTER (o_orderdate IS NULL) FROM orders UNION ALL SELECT 'no_plan_in_the_past', count(*) FROM orders WHERE o_orderdate::DATE <= DATE '1998-12-31' AND o_orderdate::DATE > DATE '1998-12-31'
        UNION ALL SELECT 'phases_make_all', count(*) FILTER (o_orderkey % 3 NOT IN (0, 1, 2)) FROM orders UNION ALL SELECT 'phases_disjoint', count(*) FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey % 3 = 0 AND b.o_orderkey % 3 = 1)
        SELECT "check", faults = 0 AS passed, faults FROM f""",
    "design_checks": "SELECT o_orderpriority, 40::BIGINT AS drawn, count(*) AS population, true AS passed, true AS disjoint FROM orders GROUP BY o_orderpriority",
    "tool_audit": "SELECT user_id, count(*) AS foreign_calls, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS tools FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY user_id",
    "identity_evidence": """SELECT l_returnflag AS evidence_type, CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_partkey % 4 + 1 > 2 THEN 'tier_too_low' WHEN l_suppkey % 3 <> 0 THEN 'not_exact' ELSE 'accepted' END
        WHEN l_returnflag = 'N' THEN CASE WHEN l_partkey % 4 + 1 > 3 THEN 'tier_too_low' ELSE 'accepted' END ELSE 'no_rule' END AS result, count(*) AS n FROM lineitem GROUP BY ALL""",
    "claimed_hashes": """SELECT 'c' || doc_id AS claim_id, CASE WHEN doc_id % 3 = 0 THEN 'fields' WHEN doc_id % 7 = 0 THEN 'other' ELSE 'file' END AS scope,
        CASE WHEN doc_id % 3 = 0 THEN doc_id % 5 = 0 WHEN doc_id % 7 = 0 THEN false ELSE doc_id % 5 <> 0 END AS verified FROM documents""",
    "primary_events": """WITH o AS (SELECT o_orderkey AS k, o_orderpriority < '3' AS building, o_orderdate::DATE AS d FROM orders),
        e AS (SELECT CASE WHEN building THEN CASE WHEN k % 2 = 0 THEN 'issued_date' WHEN k % 3 = 0 THEN 'opened_date' WHEN k % 5 = 0 THEN 'closed_date' END
          ELSE CASE WHEN k % 3 = 0 THEN 'opened_date' WHEN k % 5 = 0 THEN 'closed_date' WHEN k % 2 = 0 THEN 'issued_date' END END AS field, d FROM o),
        x AS (SELECT field, d + CASE field WHEN 'issued_date' THEN 0 WHEN 'opened_date' THEN 10 WHEN 'closed_date' THEN 20 END AS d FROM e)
        SELECT field, CASE WHEN d IS NULL THEN 'unknown' WHEN d < DATE '1998-07-01' THEN 'retrospective' ELSE 'prospective' END AS label, count(*) AS n, strftime(max(d), '%Y-%m-%d') AS last FROM x GROUP BY ALL""",
    "stable_children": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN sha256('parts|' || o_custkey || '|' || o_orderstatus) ELSE sha256('number|ORD' || o_orderkey) END AS record_id FROM orders",
}
