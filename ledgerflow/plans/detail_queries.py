"""Queries on preferred records, categories, ordered output, usage limits, semantic rules and guarded sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.text import token
from ledgerflow.operators import analysis, audit, privacy, quality, ranges, resolve, sampling
from ledgerflow.plans import change_queries, resolve_queries
from ledgerflow.plans.snapshots import CHANGES, table
from ledgerflow.sources import sinks
from ledgerflow.sources.workspace import work_folder


def preferred_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of 40 numbers in each module; some without number, link or text."""
    e = table(spark, sf_dir, "events")
    key = F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = e.select(
        "event_id", F.col("event_type").alias("module"), F.when(key % 11 != 0, F.concat(F.lit("no. "), (F.col("user_id") % 40).cast("string"))).alias("number"), F.when(key % 3 == 0, F.concat(F.lit("https://example.org/"), key.cast("string"))).otherwise("").alias("link"),
        F.when(key % 5 == 0, F.concat(F.lit("text "), (key % 13).cast("string"))).alias("description"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("retrieved"), day.alias("first_observed"), day.alias("last_observed"),
    )
    return resolve.preferred(rows, "module", token(F.col("number")), ("module", "number", "link", "description"), "link", "retrieved", "event_id", "first_observed", "last_observed")


#: Six kinds of documents that a benchmark draws from, in order, with their quotas: condition in Spark and in SQL alike.
_CATEGORIES = {
    "conflicting_labels": ("quality = 1 and toxic = 1", 10),
    "several_sources": ("doc_id % 10 = 3", 20),
    "missing_evidence": ("quality is null", 15),
    "mixed_language": ("lang is null or lang <> 'en' and n_chars < 400", 15),
    "long_reading": ("n_chars > 2000", 10),
    "easy_lookup": ("quality = 1 and lang = 'en'", 30),
}


def category_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases drawn by six categories, each with all categories it belongs to."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").dropDuplicates(["doc_id"]), "doc_id", "left")
    categories = {name: F.expr(condition) for name, (condition, _) in _CATEGORIES.items()}
    rows = rows.withColumn("matched", F.array_join(sampling.matched_categories(categories), ";"))
    drawn = sampling.by_category(rows, "doc_id", categories, {name: quota for name, (_, quota) in _CATEGORIES.items()}, 7, "benchmark")
    return drawn.select("doc_id", "category", "matched")


def _cases_sql() -> str:
    matched = ", ".join(f"CASE WHEN {c} THEN '{name}' END" for name, (c, _) in _CATEGORIES.items())
    steps, taken = [], []
    for k, (name, (condition, quota)) in enumerate(_CATEGORIES.items()):
        free = " AND ".join(f"doc_id NOT IN (SELECT doc_id FROM c{i})" for i in taken) or "true"
        steps.append(f"c{k} AS MATERIALIZED (SELECT doc_id, matched, '{name}' AS category FROM d WHERE ({condition}) AND {free} ORDER BY sha256(concat_ws('|', '7', 'benchmark', '{name}', '{name}', doc_id::VARCHAR)), doc_id LIMIT {quota})")
        taken.append(k)
    union = " UNION ALL ".join(f"SELECT doc_id, category, matched FROM c{k}" for k in taken)
    return f"WITH l AS (SELECT DISTINCT ON (doc_id) doc_id, quality, toxic FROM labels), d AS (SELECT *, concat_ws(';', {matched}) AS matched FROM (SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN l USING (doc_id))), {', '.join(steps)} {union}"


def ordered_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes in the order of their file, numbered by many tasks."""
    rows = change_queries.change_rows(spark, sf_dir).select("before_snapshot_date", "source_name", "record_identity", "change_type", "changed_fields")
    return ranges.positions(rows, ["before_snapshot_date", "source_name", "record_identity", "change_type", "changed_fields"])


def notable_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve orders with the largest totals, as a report lists them."""
    first = table(spark, sf_dir, "orders").select("o_orderkey", F.round("o_totalprice", 2).alias("total")).orderBy(F.desc("total"), "o_orderkey").limit(12)
    return ranges.positions(first.withColumn("_size", -F.col("total")), ["_size", "o_orderkey"]).drop("_size")


def ordered_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of each comparison, the gravest first, then by code and source."""
    rows = change_queries.alerts(spark, sf_dir).select("before_date", "after_date", "severity", "alert_code", "source_name").withColumn("_calm", -analysis.severity_rank(F.col("severity")))
    return ranges.positions(rows, ["before_date", "after_date", "_calm", "alert_code", "source_name"]).drop("_calm")


def usage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as runs: bytes read and written as tokens, turns as seconds; which exceed their limits."""
    t = table(spark, sf_dir, "conversations")
    size = F.octet_length("text")
    calls = t.select("conv_id", F.when(F.col("role") == "user", size).alias("input_tokens"), F.when(F.col("role") == "assistant", size).alias("output_tokens"), (F.col("conv_id") % 100).cast("string").alias("seconds"))
    return audit.usage_limits(calls, "conv_id", {"input_tokens": 1500, "output_tokens": 1200, "seconds": 90}, once=("seconds",))


def semantic_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on claims, grades, events and proposals; some rows break each."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    grade = F.element_at(F.array(*[F.lit(g) for g in ("C", "D", "A1", "U", "B2")]), (key % 5 + 1).cast("int"))
    truth = o.select(F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("completed"), F.when(key % 50 != 0, grade).alias("grade"))
    events = o.select(F.when(key % 30 == 0, "certificate_of_occupancy_issued").when(key % 31 == 0, F.lit(None)).otherwise("permit_issued").alias("event_type"))
    pairs = resolve_queries.candidate_pairs(spark, sf_dir).withColumn("review_status", F.when(F.col("a") % 17 == 0, "accepted").otherwise("pending_human_review"))
    return quality.together([quality.claim_rules(truth, "completed", "grade"), quality.event_rules(events, "event_type"), quality.proposal_rules(pairs, "merge_applied", "review_status", "pending_human_review")])


def frozen_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample that is written once, refused the second time, and replaced by force: what is stored after each."""
    work = work_folder(spark, "frozen")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    said = [("first", sinks.write_checked(n, f"{work}/sample"))]
    try:
        said.append(("again", sinks.write_checked(n.where("n_regionkey = 1"), f"{work}/sample")))
    except Exception as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
        said.append(("refused", spark.read.parquet(f"{work}/sample").count()))
    said.append(("forced", sinks.write_checked(n.where("n_regionkey = 1"), f"{work}/sample", overwrite=True)))
    return spark.createDataFrame(said, "step string, rows long")


def blocked_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the tables that their names forbid to publish, under names of an export, with how many cells they fill."""
    tables = {"customer": {"c_name": "Owner_Name", "c_acctbal": "balance"}, "supplier": {"s_name": "Contact_Name"}, "orders": {"o_custkey": "mailing_id"}}
    parts = []
    for name, renamed in tables.items():
        df = table(spark, sf_dir, name).withColumnsRenamed(renamed)
        counts = df.agg(*[F.count(c).alias(c) for c in privacy.blocked_columns(df)])
        parts += [counts.select(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col(c).alias("filled")) for c in counts.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {f.__name__: f for f in (preferred_records, category_cases, ordered_changes, notable_costs, ordered_alerts, usage_audit, semantic_rules, frozen_outputs, blocked_columns)}

ORACLE_SQL = {
    "preferred_records": """WITH e AS (SELECT event_id, event_type AS module, CASE WHEN event_id % 11 <> 0 THEN 'no. ' || (user_id % 40) END AS number, CASE WHEN event_id % 3 = 0 THEN 'https://example.org/' || event_id ELSE '' END AS link,
          CASE WHEN event_id % 5 = 0 THEN 'text ' || (event_id % 13) END AS description, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS retrieved, strftime(ts, '%Y-%m-%d') AS d FROM events),
        k AS (SELECT *, (link <> '', 1 + (number IS NOT NULL)::INT + (link <> '')::INT + (description IS NOT NULL)::INT, retrieved, event_id::VARCHAR) AS r FROM e),
        g AS (SELECT arg_max(event_id, r) AS event_id, arg_max(module, r) AS module, arg_max(number, r) AS number, coalesce(arg_max(nullif(link, ''), r), arg_min(nullif(link, ''), (retrieved, event_id::VARCHAR))) AS link,
          coalesce(arg_max_null(description, r), arg_min(description, (retrieved, event_id::VARCHAR))) AS description, arg_max(retrieved, r) AS retrieved, min(d) AS first_observed, max(d) AS last_observed, count(*) AS merged_records
          FROM k WHERE number IS NOT NULL GROUP BY k.module, k.number)
        SELECT * FROM g UNION ALL SELECT event_id, module, number, link, description, retrieved, d, d, 1 FROM k WHERE number IS NULL""",
    "category_cases": _cases_sql(),
    "ordered_changes": CHANGES + """ SELECT before_date AS before_snapshot_date, source_name, record_identity, change_type, changed_fields, row_number() OVER (ORDER BY before_date, source_name, record_identity, change_type, changed_fields) AS position FROM changes""",
    "notable_costs": "SELECT o_orderkey, round(o_totalprice, 2) AS total, row_number() OVER (ORDER BY round(o_totalprice, 2) DESC, o_orderkey) AS position FROM orders QUALIFY position <= 12",
    "ordered_alerts": CHANGES + change_queries.ALERTS_SQL + """ SELECT before_date, after_date, severity, alert_code, source_name, row_number() OVER (ORDER BY before_date, after_date, CASE severity WHEN 'critical' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END, alert_code, source_name NULLS FIRST) AS position FROM alerts""",
    "usage_audit": """WITH u AS (SELECT conv_id, count(*) AS calls, sum(octet_length(encode(text))) FILTER (role = 'user')::DOUBLE AS input_tokens, sum(octet_length(encode(text))) FILTER (role = 'assistant')::DOUBLE AS output_tokens, (conv_id % 100)::DOUBLE AS seconds FROM conversations GROUP BY conv_id),
        x AS (SELECT *, concat_ws(';', CASE WHEN input_tokens > 1500 THEN 'input_tokens' END, CASE WHEN output_tokens > 1200 THEN 'output_tokens' END, CASE WHEN seconds > 90 THEN 'seconds' END) AS exceeded FROM u) SELECT *, exceeded = '' AS within_limits FROM x""",
    "semantic_rules": "WITH " + resolve_queries.ORACLE_SQL["candidate_pairs"].strip().removeprefix("WITH ").replace(" SELECT x.id AS a", ", p AS (SELECT x.id AS a", 1).replace("        , p AS", ", p AS") + """),
        t AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS completed, CASE WHEN o_orderkey % 50 <> 0 THEN ['C', 'D', 'A1', 'U', 'B2'][o_orderkey % 5 + 1] END AS grade FROM orders)
        SELECT *, faults = 0 AS passed FROM (SELECT 'no_completion_without_grade' AS "check", count(*) FILTER (completed = 'yes' AND coalesce(grade NOT IN ('A1', 'A2', 'A3', 'B1', 'B2'), true)) AS faults FROM t
        UNION ALL SELECT 'derived_grades_only', count(*) FILTER (coalesce(grade NOT IN ('C', 'D', 'P', 'X', 'U'), true)) FROM t
        UNION ALL SELECT 'no_forbidden_events', count(*) FILTER (o_orderkey % 30 = 0 OR o_orderkey % 31 = 0) FROM orders
        UNION ALL SELECT 'proposals_never_merged', count(*) FILTER (a % 17 = 0) FROM p)""",
    "frozen_outputs": "SELECT 'first' AS step, count(*) AS rows FROM nation UNION ALL SELECT 'refused', count(*) FROM nation UNION ALL SELECT 'forced', count(*) FILTER (n_regionkey = 1) FROM nation",
    "blocked_columns": "SELECT 'customer' AS \"table\", 'Owner_Name' AS \"column\", count(c_name) AS filled FROM customer UNION ALL SELECT 'orders', 'mailing_id', count(o_custkey) FROM orders UNION ALL SELECT 'supplier', 'Contact_Name', count(s_name) FROM supplier",
}
