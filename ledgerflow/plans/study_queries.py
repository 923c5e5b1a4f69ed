"""Queries on study frames, reviews, context tables, evidence and per-source fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import jsonmap, per_source
from ledgerflow.functions.classify import stage
from ledgerflow.functions.numbers import percent
from ledgerflow.operators import context, studies
from ledgerflow.plans.check_queries import quota_sql
from ledgerflow.plans.snapshots import table

# --- strata, frames, portfolios ---------------------------------------------------------------

_LAYERS = ("historic_preservation", "development_coordination", "capital_streets", "construction_inspections", "single_family_permits", "other_layer")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def layer_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as activities of one to three layers: rows per stratum; null has none."""
    key = F.col("p_partkey")
    layer = lambda n: F.element_at(F.array(*[F.lit(x) for x in _LAYERS]), (n % 6 + 1).cast("int"))
    listed = F.when(key % 4 == 0, F.concat_ws(";", layer(key), layer(key + 1), layer(key))).when(key % 9 == 0, "").otherwise(layer(key))
    rows = table(spark, sf_dir, "part").select(studies.layer_stratum(listed).alias("stratum"))
    return rows.groupBy("stratum").agg(F.count("*").alias("n"))


def link_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ("merged_existing_activity", "Ambiguous_candidates", "duplicate_suppressed", "appended_new_activity", "deduplicated")
    said = F.element_at(F.array(*[F.lit(w) for w in words], F.lit(None).cast("string")), (F.col("l_partkey") % 6 + 1).cast("int"))
    review = F.when(F.col("l_suppkey") % 7 == 0, "True").when(F.col("l_suppkey") % 7 == 1, "false")
    rows = table(spark, sf_dir, "lineitem").select(studies.link_stratum(said, review).alias("stratum"))
    return rows.groupBy("stratum").agg(F.count("*").alias("n"))


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus")).alias("module"), F.concat_ws("-", "o_orderpriority", (F.col("o_custkey") % 9).cast("string")).alias("kind"),
        F.add_months("o_orderdate", 300).alias("day"), F.when(F.col("o_custkey") % 5 == 0, "prospective_snapshot").otherwise("retrospective_event_history").alias("label"),
    )
    return studies.framed(orders, "module", "kind", F.col("day"), F.col("label"), below=60)


def study_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir).groupBy("sampling_stratum").agg(F.count("*").alias("n"))


def study_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A primary sample of the framed orders with its second review."""
    out = studies.study(_frame(spark, sf_dir), "o_orderkey", 300, 42, "frame")
    return out.select("o_orderkey", "sampling_stratum", "rank", "population", "quota", "second_review")


def risk_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difficult orders and controls of two components, numbered."""
    orders = table(spark, sf_dir, "orders")
    urgent, large = F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 200000
    both = studies.portfolio(orders, "o_orderkey", "urgency", urgent, 8, 7, 42).unionByName(studies.portfolio(orders, "o_orderkey", "size", large, 18, 12, 42))
    return studies.numbered_cases(both, "o_orderkey", "case", 42).select("case_id", "component", "risk_tier", "o_orderkey")


# --- reviews ----------------------------------------------------------------------------------


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as reviews of which some lack one thing or another."""
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    pick = lambda n, *words: F.element_at(F.array(*[F.lit(w) for w in words]), (n % len(words) + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(part % 11 != 0, "complete").otherwise("open").alias("review_status"),
        F.when(supplier % 9 != 0, "r1").alias("reviewer"),
        pick(part, "supported", "contradicted", "unclear", "guess", "supported").alias("class_result"),
        F.when(line > 1, "house").otherwise(" ").alias("reviewed_class"),
        F.when(part % 2 == 0, "not_applicable").otherwise(pick(line, "supported", "contradicted")).alias("link_result"),
        F.when(supplier % 13 != 0, "yes").otherwise("no").alias("manual_evidence_confirmed"),
        F.when(part % 3 == 0, "https://example.org/").alias("url"),
        F.when(line % 2 == 0, "doc").alias("document"),
        (part % 4 != 0).alias("linked"),
        F.concat_ws(";", F.when(part % 2 == 0, "name"), F.when(part % 3 == 0, "address"), F.when(part % 5 == 0, "name")).alias("methods"),
    )


def reviews_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = studies.review_complete(
        ("reviewer",), {"class_result": ("supported", "contradicted", "unclear"), "link_result": ("supported", "contradicted", "not_applicable")},
        {"class_result": (("supported", "contradicted"), "reviewed_class")}, {"link_result": F.col("linked")}, ("url", "document"),
    )
    return _reviews(spark, sf_dir).groupBy("class_result").agg(F.count("*").alias("reviews"), F.count_if(done).alias("complete"))


def claim_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two claims by the methods that led to them; a review with several methods counts for each."""
    return studies.claim_counts(_reviews(spark, sf_dir), ("class_result", "link_result"), ("review_status",), "methods")


def plan_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned cases and their outcomes in the tables they name; some name none or a row that is not there."""
    plan = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 5 == 0, "unknown").when(F.col("o_orderkey") % 2 == 0, "customers").otherwise("parts").alias("source_file"), (F.col("o_custkey") + 1).alias("sample_id"), "o_orderkey"
    )
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"), F.lower("c_mktsegment").alias("segment"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sample_id"), F.col("p_brand").alias("brand"))
    return studies.plan_outcomes(plan, {"customers": (customers, "segment"), "parts": (parts, "brand")}).select("o_orderkey", "source_file", "outcome", "found")


# --- context, events, evidence ----------------------------------------------------------------


def _budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    activities = table(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 6 != 0, F.col("s_nationkey")).alias("project"), F.concat(F.lit("a"), _text("s_suppkey")).alias("activity_id"), F.concat(F.lit("m"), (F.col("s_suppkey") % 3).cast("string")).alias("master_id"))
    budget = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 != 0, F.col("p_size")).alias("project"), "p_retailprice", "p_size", "p_brand")
    return context.context_rows(budget, activities, "project", "p_partkey")


def context_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _budget(spark, sf_dir).select("context_id", "p_partkey", "project", "activity_ids", "master_ids", "match_status")


def finance_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    estimate = F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice")).otherwise(0.0)
    funded = F.when(F.col("p_brand").endswith("1"), "Funded").when(F.col("p_brand").endswith("2"), "  ")
    out = context.finance_events(_budget(spark, sf_dir), "context_id", estimate, (F.col("p_size") - 25).cast("double"), funded, ("match_status",))
    return out.withColumn("amount", F.col("amount").cast("double"))


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows of an export with dates and an inspection."""
    day = lambda c, when: F.when(when, F.date_format(c, "yyyy-MM-dd"))
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("item"),
        day("l_shipdate", key % 2 == 0).alias("issued_date"), F.when(key % 5 == 0, " ").otherwise(day("l_shipdate", key % 3 == 0)).alias("closed_date"), day("l_shipdate", line > 2).alias("inspected"),
        F.element_at(F.array(F.lit("Passed"), F.lit("FAILED"), F.lit("Approved "), F.lit("Work complete"), F.lit("")), (F.col("l_partkey") % 5 + 1).cast("int")).alias("result"),
        F.when(F.col("l_suppkey") % 2 == 0, "Roof  check").when(F.col("l_suppkey") % 3 == 0, "Final walk").alias("kind"), F.when(F.col("l_suppkey") % 5 == 0, "Y").alias("final"),
    )
    out = context.staged_events(rows, "item", (("permit_issued", "issued_date"), ("permit_closed", "closed_date")), "inspected", F.col("result"), F.col("kind"), F.col("final"))
    return out.groupBy("event_type", "field", F.when(F.col("field") == "inspection", F.col("value")).alias("value")).agg(F.count("*").alias("events"), F.countDistinct("event_id").alias("ids"), F.min("event_date").alias("first"))


def match_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line items as matches of buildings: grades and what they rest on."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.when(F.col("l_quantity") > 45, "n/a").otherwise((F.lit(1990) + F.col("l_quantity").cast("int") % 12).cast("string")).alias("built"),
        F.when(F.col("l_linenumber") == 1, "high").when(F.col("l_linenumber") < 4, "medium").otherwise("low").alias("confidence"),
    )
    matches = context.rolled_up(items, "l_orderkey", "l_partkey", "l_suppkey", "built", "confidence").withColumnRenamed("l_orderkey", "o_orderkey")
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("permit_year"),
        F.element_at(F.array(*[F.lit(x) for x in ("Withdrawn", "In construction", "Closeout", "Review", "Issued")]), (key % 5 + 1).cast("int")).alias("status"),
        F.element_at(F.array(*[F.lit(x) for x in ("building_construction", "planning_application", "other")]), (key % 3 + 1).cast("int")).alias("kind"), (key % 7 == 0).alias("capital"),
    )
    graded = context.evidence(F.col("status"), F.col("kind"), F.col("permit_year"), F.col("last_year"), F.col("capital"), ("building_construction",), ("planning_application",))
    out = context.with_evidence(orders, matches, "o_orderkey", graded)
    return out.select("o_orderkey", "buildings", "folios", "first_year", "last_year", "best_confidence", "grade", "basis")


def truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    said = F.element_at(F.array(*[F.lit(x) for x in ("Withdrawn", "Under construction", "Approved", "Filed", "Expired")]), (key % 5 + 1).cast("int"))
    planning = key % 4 == 0
    out = context.truth(table(spark, sf_dir, "orders"), "o_orderkey", said, stage(said, planning)["stage"], planning, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return out.groupBy("grade", "basis", "started", "completed", "cancelled").agg(F.count("*").alias("n"), F.max("verified_on").alias("last_verified"))


def singleton_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, links = context.singletons(table(spark, sf_dir, "customer"), "c_custkey", "c_name")
    return projects.join(links, "master_id").select("master_id", "project_name", "c_custkey", "status", "method", "review_status")


def benchmark_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders per year against all line items shipped in it, and against a year without any."""
    year = F.year("l_shipdate").alias("year")
    official = table(spark, sf_dir, "lineitem").groupBy(year).agg(F.count("*").alias("total"))
    official = official.unionByName(official.groupBy().agg((F.max("year") + 1).alias("year"), F.lit(0).cast("long").alias("total")))
    return context.benchmark(table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'"), F.year("o_orderdate"), official)


def amount_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported amounts of parts; some are off by more than half a cent, some belong to no part."""
    part = table(spark, sf_dir, "part")
    off = F.when(F.col("p_partkey") % 17 == 0, 0.01).when(F.col("p_partkey") % 19 == 0, 0.002).otherwise(0.0)
    key = F.when(F.col("p_partkey") % 29 == 0, -1 - F.col("p_partkey")).otherwise(F.col("p_partkey")).alias("p_partkey")
    price = part.select(key, F.lit("price").alias("kind"), (F.col("p_retailprice") + off).alias("amount"))
    size = part.select(key, F.lit("size").alias("kind"), F.col("p_size").cast("double").alias("amount"))
    return context.amount_faults(price.unionByName(size), part, "p_partkey", "kind", {"price": "p_retailprice", "size": "p_size"}, "amount").groupBy("kind").agg(F.count("*").alias("faults"))


def activity_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the number of their places, whether they wait for verification, and located rows of some classes."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("kind"), (key % 3 == 0).cast("int").alias("candidate"), F.when(key % 4 == 0, 1).alias("realized"))
    places = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_suppkey") % 4 != 0, _text("l_suppkey")).alias("geometry"),
        F.when(F.col("l_partkey") % 2 == 0, 27.9).alias("latitude"), F.when(F.col("l_partkey") % 3 != 0, -82.4).alias("longitude"),
    )
    counted = context.location_counts(orders, places, "o_orderkey", "geometry")
    queue = context.verification_queue(orders, "candidate", "realized").select("o_orderkey", F.lit(True).alias("queued"))
    near = context.spatially_relevant(places, orders, "o_orderkey", "kind", ("F", "P")).groupBy("o_orderkey").agg(F.count("*").alias("relevant"))
    out = counted.join(queue, "o_orderkey", "left").join(near, "o_orderkey", "left")
    return out.select("o_orderkey", "location_count", F.coalesce("queued", F.lit(False)).alias("queued"), F.coalesce("relevant", F.lit(0).cast("long")).alias("relevant"))


def history_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a history, with the segment of their customer today; every seventh customer is gone."""
    current = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    out = context.with_current(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), current, "o_custkey", ("c_mktsegment",))
    return out.groupBy("c_mktsegment").agg(F.count("*").alias("orders"))


def frequent_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 most frequent parts among line items, with their share."""
    items = table(spark, sf_dir, "lineitem")
    counted = items.groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(15)
    total = items.agg(F.count("*").alias("total"))
    return counted.join(F.broadcast(total)).select("l_partkey", "n", percent(F.col("n"), F.col("total")).alias("percent"))  # one row


# --- per-source fields ------------------------------------------------------------------------

#: Names of this library's own for the fields that each source keeps its values in.
_NATIVE = {"1-urgent": "filing_no", "2-high": "permit_ref"}
_TRACKED = {
    "1-urgent": {"status": ("state_now",), "project_name": ("label_a", "label_b")},
    "2-high": {"status": ("review_state", "step_state")},
    "3-medium": {"project_name": ("plan_title",), "estimated_cost": ("plan_cost",)},
}


def _properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with properties as JSON, under names that depend on the source (in any case)."""
    status, key = F.col("o_orderstatus"), _text("o_orderkey")
    named = F.to_json(
        F.struct(
            key.alias("Filing_No"), F.concat(F.lit("H"), key).alias("PERMIT_REF"), F.concat(F.lit("p "), key).alias("own_no"), status.alias("State_Now"), F.lit("Name ").alias("Label_A"),
            F.when(F.col("o_custkey") % 2 == 0, "other").alias("LABEL_B"), status.alias("Review_State"), F.lower("o_orderpriority").alias("step_state"), F.lit(" ").alias("plan_title"),
            F.round("o_totalprice", 0).cast("long").cast("string").alias("plan_cost"),
        )
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.lower("o_orderpriority").alias("source_name"), jsonmap.lower_keys(jsonmap.json_map(named)).alias("m"))


def native_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _properties(spark, sf_dir).select("o_orderkey", per_source.native_id(F.col("source_name"), F.col("m"), _NATIVE, "own_no").alias("native_id"))


def tracked_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = per_source.tracked_values(F.col("source_name"), F.col("m"), _TRACKED)
    return _properties(spark, sf_dir).select("o_orderkey", found.alias("t")).select("o_orderkey", "t.estimated_cost", "t.project_name", "t.status")


QUERIES = {
    f.__name__: f
    for f in (
        layer_strata, link_strata, study_frame, study_sample, risk_portfolio, reviews_complete, claim_methods, plan_outcomes, context_rows, finance_events, staged_events, match_evidence,
        truth_table, singleton_projects, benchmark_ratio, amount_faults, activity_locations, history_enriched, frequent_parts, native_ids, tracked_by_source,
    )
}

_RANK = "sha256('42|{c}|{p}||' || o_orderkey)"
_REVIEWS = """r AS (SELECT l_orderkey, CASE WHEN l_partkey % 11 <> 0 THEN 'complete' ELSE 'open' END AS review_status, l_suppkey % 9 <> 0 AS reviewer,
    ['supported','contradicted','unclear','guess','supported'][l_partkey % 5 + 1] AS class_result, l_linenumber > 1 AS reviewed, CASE WHEN l_partkey % 2 = 0 THEN 'not_applicable' WHEN l_linenumber % 2 = 0 THEN 'supported' ELSE 'contradicted' END AS link_result,
    l_suppkey % 13 <> 0 AS confirmed, l_partkey % 3 = 0 OR l_linenumber % 2 = 0 AS located, l_partkey % 4 <> 0 AS linked, list_distinct(list_filter([CASE WHEN l_partkey % 2 = 0 THEN 'name' END, CASE WHEN l_partkey % 3 = 0 THEN 'address' END, CASE WHEN l_partkey % 5 = 0 THEN 'name' END], lambda x: x IS NOT NULL)) AS methods FROM lineitem)"""
_WILSON = """round(s / nullif(n, 0)::DOUBLE, 6) AS precision,
    round(greatest(0, (s/n::DOUBLE + z*z/(2*n) - z*sqrt((s/n::DOUBLE)*(1-s/n::DOUBLE)/n + z*z/(4.0*n*n))) / (1 + z*z/n)), 6) AS lower, round(least(1, (s/n::DOUBLE + z*z/(2*n) + z*sqrt((s/n::DOUBLE)*(1-s/n::DOUBLE)/n + z*z/(4.0*n*n))) / (1 + z*z/n)), 6) AS upper"""
_CONTEXT = """acts AS (SELECT s_nationkey AS project, string_agg(DISTINCT 'a' || s_suppkey, ';' ORDER BY 'a' || s_suppkey) AS activity_ids, string_agg(DISTINCT 'm' || (s_suppkey % 3), ';' ORDER BY 'm' || (s_suppkey % 3)) AS master_ids
    FROM supplier WHERE s_suppkey % 6 <> 0 GROUP BY s_nationkey),
  ctx AS (SELECT 'ctx-' || left(sha1(p_size || '|' || p_partkey), 16) AS context_id, p_partkey, p_size AS project, p_size, p_retailprice, p_brand, coalesce(activity_ids, '') AS activity_ids, coalesce(master_ids, '') AS master_ids,
    CASE WHEN activity_ids IS NULL THEN 'budget_book_only' ELSE 'matched_core_activity' END AS match_status FROM part LEFT JOIN acts ON p_size = acts.project WHERE p_partkey % 10 <> 0)"""

_FRAME = """o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS module, o_orderpriority || '-' || (o_custkey % 9) AS kind, year(o_orderdate + INTERVAL 300 MONTH) AS y, o_custkey % 5 = 0 AS late FROM orders),
        f AS (SELECT *, count(*) OVER (PARTITION BY module, kind) AS n FROM o),
        u AS MATERIALIZED (SELECT o_orderkey, concat_ws('|', coalesce(module, 'unknown_module'), CASE WHEN late THEN 'prospective' ELSE 'retrospective' END, (2020 + floor((y - 2020) / 3) * 3)::INTEGER || '_' || (2022 + floor((y - 2020) / 3) * 3)::INTEGER,
          CASE WHEN n < 60 THEN 'relatively_rare_type' ELSE 'common_type' END) AS stratum FROM f)"""


def _drawn(name: str, rows: str, purpose: str, target: int, least: int) -> str:
    token = f"sha256(concat_ws('|', '42', 'frame', '{purpose}', stratum, o_orderkey::VARCHAR))"
    return f"""n_{name} AS (SELECT stratum AS k, count(*) AS n FROM {rows} GROUP BY stratum), {quota_sql(f"q_{name}", f"n_{name}", str(target), least)},
        {name} AS MATERIALIZED (SELECT o_orderkey, stratum, rank, n AS population, q AS quota FROM (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY {token}, o_orderkey))::INTEGER AS rank FROM {rows}) JOIN q_{name} ON stratum = k WHERE rank <= q)"""


ORACLE_SQL = {
    "study_sample": f"WITH {_FRAME}, {_drawn('a', 'u', 'primary', 300, 2)}, c AS (SELECT o_orderkey, stratum FROM a), {_drawn('b', 'c', 'second_review', 75, 0)}"
        + " SELECT o_orderkey, stratum AS sampling_stratum, rank, population, quota, o_orderkey IN (SELECT o_orderkey FROM b) AS second_review FROM a",
    "layer_strata": """WITH l AS (SELECT p_partkey, ['historic_preservation','development_coordination','capital_streets','construction_inspections','single_family_permits','other_layer'] AS a FROM part)
        SELECT CASE WHEN p_partkey % 4 = 0 THEN 'cross_source_merge' WHEN p_partkey % 9 = 0 THEN NULL ELSE ['historic_preservation','planning','capital_project','permit','permit',NULL][p_partkey % 6 + 1] END AS stratum, count(*) AS n FROM l GROUP BY ALL""",
    "link_strata": """SELECT CASE WHEN l_suppkey % 7 = 0 OR l_partkey % 6 = 1 THEN 'ambiguous_or_multi_candidate' WHEN l_partkey % 6 IN (2, 4) THEN 'duplicate_suppression' WHEN l_partkey % 6 = 0 THEN 'matched_existing'
        ELSE 'retained_unmatched' END AS stratum, count(*) AS n FROM lineitem GROUP BY ALL""",
    "study_frame": f"WITH {_FRAME} SELECT stratum AS sampling_stratum, count(*) AS n FROM u GROUP BY stratum",
    "risk_portfolio": "WITH " + ", ".join(
        f"""h{i} AS (SELECT '{c}' AS component, 'elevated' AS risk_tier, o_orderkey FROM orders WHERE {cond} ORDER BY {_RANK.format(c=c, p='difficult')}, o_orderkey LIMIT {a}),
        k{i} AS (SELECT '{c}' AS component, 'control' AS risk_tier, o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM h{i}) ORDER BY {_RANK.format(c=c, p='control')}, o_orderkey LIMIT {b})"""
        for i, (c, cond, a, b) in enumerate((("urgency", "o_orderpriority = '1-URGENT'", 8, 7), ("size", "o_totalprice > 200000", 18, 12))))
        + f""", u AS (SELECT * FROM h0 UNION ALL SELECT * FROM k0 UNION ALL SELECT * FROM h1 UNION ALL SELECT * FROM k1)
        SELECT 'case-' || lpad((row_number() OVER (ORDER BY component, {_RANK.format(c='portfolio', p='order')}, o_orderkey))::VARCHAR, 3, '0') AS case_id, component, risk_tier, o_orderkey FROM u""",
    "reviews_complete": f"""WITH {_REVIEWS} SELECT class_result, count(*) AS reviews, count(*) FILTER (review_status = 'complete' AND reviewer AND class_result <> 'guess' AND (class_result = 'unclear' OR reviewed)
        AND (link_result <> 'not_applicable') = linked AND confirmed AND located) AS complete FROM r GROUP BY class_result""",
    "claim_methods": f"""WITH {_REVIEWS}, m AS (SELECT review_status, unnest(methods) AS method, class_result, link_result FROM r), u AS (SELECT 'class_result' AS claim, review_status, method, class_result AS x FROM m UNION ALL SELECT 'link_result', review_status, method, link_result FROM m),
        c AS (SELECT claim, review_status, method, count(*) FILTER (x = 'supported') AS s, nullif(count(*) FILTER (x IN ('supported', 'contradicted')), 0) AS n, 1.959963984540054 AS z FROM u GROUP BY ALL)
        SELECT claim, review_status, method, s AS supported, coalesce(n, 0) AS decided, {_WILSON} FROM c""",
    "plan_outcomes": """WITH p AS (SELECT o_orderkey, o_custkey + 1 AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' WHEN o_orderkey % 2 = 0 THEN 'customers' ELSE 'parts' END AS source_file FROM orders)
        SELECT o_orderkey, source_file, CASE source_file WHEN 'customers' THEN lower(c_mktsegment) WHEN 'parts' THEN p_brand END AS outcome,
          CASE source_file WHEN 'customers' THEN c_custkey IS NOT NULL WHEN 'parts' THEN p_partkey IS NOT NULL ELSE false END AS found FROM p LEFT JOIN customer ON k = c_custkey LEFT JOIN part ON k = p_partkey""",
    "context_rows": f"WITH {_CONTEXT} SELECT context_id, p_partkey, project, activity_ids, master_ids, match_status FROM ctx",
    "finance_events": f"""WITH {_CONTEXT}, e AS (SELECT context_id, match_status, 'capital_estimate_reported' AS event_type, round(p_retailprice, 2)::DECIMAL(18,2) AS amount, 'reported_level' AS direction FROM ctx WHERE p_size % 3 <> 0 AND p_retailprice > 0
          UNION ALL SELECT context_id, match_status, 'capital_actual_cost_reported', (p_size - 25)::DECIMAL(18,2), 'reported_level' FROM ctx WHERE p_size > 25
          UNION ALL SELECT context_id, match_status, 'funded_status_reported', NULL, 'not_applicable' FROM ctx WHERE p_brand LIKE '%1')
        SELECT 'fin-' || left(sha1(context_id || '|' || event_type || '|' || coalesce(amount::VARCHAR, '')), 16) AS event_id, context_id, match_status, event_type, amount::DOUBLE AS amount, direction FROM e""",
    "staged_events": """WITH r AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS item, strftime(l_shipdate, '%Y-%m-%d') AS d, l_orderkey AS k, l_linenumber AS line, l_partkey % 5 AS p,
          CASE WHEN l_suppkey % 2 = 0 THEN 'Roof check' WHEN l_suppkey % 3 = 0 THEN 'Final walk' END AS kind, l_suppkey % 5 = 0 OR (l_suppkey % 2 <> 0 AND l_suppkey % 3 = 0) AS last FROM lineitem),
        e AS (SELECT item, 'permit_issued' AS event_type, d, 'issued_date' AS field, NULL AS value FROM r WHERE k % 2 = 0 UNION ALL SELECT item, 'permit_closed', d, 'closed_date', NULL FROM r WHERE k % 3 = 0 AND k % 5 <> 0
          UNION ALL SELECT item, CASE WHEN p = 1 THEN 'inspection_failed' WHEN last THEN 'final_inspection_passed' ELSE 'inspection_passed' END, d, 'inspection', concat_ws('; ', kind, ['Passed','FAILED','Approved','Work complete'][p + 1]) FROM r WHERE line > 2 AND p < 4)
        SELECT event_type, field, value, count(*) AS events, count(DISTINCT (item, d)) AS ids, min(d) AS first FROM e GROUP BY ALL""",
    "match_evidence": """WITH m AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS buildings, string_agg(DISTINCT l_partkey::VARCHAR, ';' ORDER BY l_partkey::VARCHAR) AS folios,
          min(CASE WHEN l_quantity <= 45 THEN 1990 + l_quantity::INTEGER % 12 END) AS first_year, max(CASE WHEN l_quantity <= 45 THEN 1990 + l_quantity::INTEGER % 12 END) AS last_year,
          CASE WHEN bool_or(l_linenumber = 1) THEN 'high' WHEN bool_or(l_linenumber < 4) THEN 'medium' ELSE 'low' END AS best_confidence FROM lineitem GROUP BY l_orderkey),
        g AS (SELECT o_orderkey, buildings, folios, first_year, last_year, best_confidence, CASE WHEN o_orderkey % 5 = 0 THEN 'X inactive_official_status' WHEN last_year >= year(o_orderdate) - 1 AND o_orderkey % 3 = 0 THEN 'D permit_plus_current_footprint_year_built_supporting_only'
          WHEN o_orderkey % 7 = 0 AND o_orderkey % 5 = 2 THEN 'D city_capital_project_closeout_status_supporting_only' WHEN o_orderkey % 7 = 0 AND o_orderkey % 5 = 1 THEN 'C city_capital_project_construction_status'
          WHEN o_orderkey % 3 = 1 THEN 'P planning_application_only' ELSE 'U insufficient_completion_evidence' END AS g FROM orders LEFT JOIN m ON l_orderkey = o_orderkey)
        SELECT o_orderkey, buildings, folios, first_year, last_year, best_confidence, g[1:1] AS grade, g[3:] AS basis FROM g""",
    "truth_table": """WITH t AS (SELECT o_orderdate, o_orderkey % 4 = 0 AS planning, CASE WHEN o_orderkey % 5 IN (0, 4) THEN ['X','inactive_official_status','unknown','yes'] WHEN o_orderkey % 5 = 1 THEN ['C','official_construction_or_inspection_status','yes','unknown']
          WHEN o_orderkey % 4 = 0 THEN ['P','planning_application_only','not_applicable','unknown'] WHEN o_orderkey % 5 = 2 THEN ['D','permit_or_funding_approved_only','unknown','unknown'] ELSE ['U','insufficient_completion_evidence','unknown','unknown'] END AS v FROM orders)
        SELECT v[1] AS grade, v[2] AS basis, v[3] AS started, CASE WHEN planning THEN 'not_applicable' ELSE 'unknown' END AS completed, v[4] AS cancelled, count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d') AS last_verified FROM t GROUP BY ALL""",
    "singleton_projects": "SELECT 'mp-' || left(sha1(c_custkey::VARCHAR), 16) AS master_id, c_name AS project_name, c_custkey, 'provisional_singleton' AS status, 'no_safe_cross_activity_merge' AS method, 'needs_review' AS review_status FROM customer",
    "benchmark_ratio": """WITH t AS (SELECT year(l_shipdate)::INTEGER AS year, count(*) AS total FROM lineitem GROUP BY ALL), o AS (SELECT * FROM t UNION ALL SELECT (max(year) + 1)::INTEGER, 0 FROM t), f AS (SELECT year(o_orderdate) AS year, count(*) AS found FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
        SELECT o.year, total, coalesce(found, 0) AS found, round(round(coalesce(found, 0) / nullif(total, 0)::DOUBLE, 6), 4) AS diagnostic_ratio FROM o LEFT JOIN f ON o.year = f.year""",
    "amount_faults": """SELECT kind, count(*) AS faults FROM (SELECT 'price' AS kind FROM part WHERE p_partkey % 29 = 0 OR p_partkey % 17 = 0 UNION ALL SELECT 'size' FROM part WHERE p_partkey % 29 = 0) GROUP BY kind""",
    "activity_locations": """WITH n AS (SELECT l_orderkey, count(DISTINCT CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey END) AS places, count(*) FILTER (l_partkey % 2 = 0 AND l_partkey % 3 <> 0) AS located FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderkey, coalesce(places, 0) AS location_count, o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 AS queued, CASE WHEN o_orderstatus IN ('F', 'P') THEN coalesce(located, 0) ELSE 0 END AS relevant FROM orders LEFT JOIN n ON l_orderkey = o_orderkey""",
    "history_enriched": "SELECT c_mktsegment, count(*) AS orders FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 7 <> 0 GROUP BY c_mktsegment",
    "frequent_parts": "SELECT l_partkey, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 1) AS percent FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 15",
    "native_ids": "SELECT o_orderkey, CASE lower(o_orderpriority) WHEN '1-urgent' THEN o_orderkey::VARCHAR WHEN '2-high' THEN 'H' || o_orderkey ELSE 'p ' || o_orderkey END AS native_id FROM orders",
    "tracked_by_source": """SELECT o_orderkey, CASE WHEN o_orderpriority = '3-MEDIUM' THEN round(o_totalprice, 0)::BIGINT::VARCHAR END AS estimated_cost, CASE WHEN o_orderpriority = '1-URGENT' THEN CASE WHEN o_custkey % 2 = 0 THEN 'Name | other' ELSE 'Name' END END AS project_name,
        CASE o_orderpriority WHEN '1-URGENT' THEN o_orderstatus WHEN '2-HIGH' THEN o_orderstatus || ' | ' || lower(o_orderpriority) END AS status FROM orders""",
}
