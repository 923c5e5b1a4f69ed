"""Queries on changes between observations and their analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.dates import interval_kind
from ledgerflow.operators import analysis, diff, identity, sketches
from ledgerflow.operators.spread import dealt
from ledgerflow.plans.snapshots import CHANGES, CTE, DATES, PAIRS, VALUES, health_sql, snapshots, table
from ledgerflow.sources import archive
from ledgerflow.sources.workspace import cut, work_folder

#: Small tables of the tests have small sources, so alerts use lower minima than the defaults.
LIMITS = analysis.Thresholds(critical_drop_min=10, critical_disappearance_min=10, warning_net_pct=0.002, warning_net_min=2, warning_churn=0.05, mass_refresh=0.15, mass_refresh_min=10, info_net_pct=0.0005)


def paired(spark: SparkSession, sf_dir: str, pairs=PAIRS) -> DataFrame:  # noqa: ANN001
    return diff.paired(identity.with_identity(snapshots(spark, sf_dir)), pairs, VALUES)


def _changes(both: DataFrame) -> DataFrame:
    issued = F.lower(F.coalesce("new.status", F.lit(""))).contains("issued")
    labels = {"status_changed": F.when(issued, "permit_issued").otherwise(""), "planned_date_changed": F.lit("expected_completion_changed")}
    return diff.changes(both, semantic=labels)


def change_rows(spark: SparkSession, sf_dir: str, pairs=PAIRS) -> DataFrame:  # noqa: ANN001
    return _changes(paired(spark, sf_dir, pairs))


_SHOWN = ("change_id", "comparison_month", "before_snapshot_date", "after_snapshot_date", "change_type", "semantic_type", "source_name", "record_identity", "source_record_id", "changed_fields", "old_value", "new_value")


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First against last observation."""
    return change_rows(spark, sf_dir, [(DATES[0], DATES[2])]).select(*_SHOWN)


def diff_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_rows(spark, sf_dir).select(*_SHOWN)


def diff_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest pair of observations, from snapshots that were dealt into buckets of their identity when written."""
    path = work_folder(spark, "buckets")
    name = f"snapshots_{path.rpartition('-')[2]}"
    stored = archive.write_bucketed(identity.with_identity(snapshots(spark, sf_dir)), name, path, "record_identity", 16)
    return _changes(diff.paired(stored, PAIRS[-1:], VALUES)).select(*_SHOWN)


def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.summary(change_rows(spark, sf_dir))


def diff_source_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ["new_record", "record_disappeared", "status_changed", "estimated_cost_changed", "planned_date_changed", "capital_project_phase_changed"]
    counted = change_rows(spark, sf_dir).groupBy("after_snapshot_date", "source_name").pivot("change_type", kinds).count()
    return counted.na.fill(0, kinds)


def diff_residual_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of events that differ between a user's successive events, as maps."""
    from pyspark.sql import Window

    from ledgerflow.functions.jsonmap import changed_keys, json_map

    events = table(spark, sf_dir, "events")
    props = F.map_concat(json_map(F.col("props")), F.create_map(F.lit("type"), F.col("event_type"), F.lit("editdate"), F.col("event_id").cast("string")))
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = events.select("event_id", "user_id", "ts", props.alias("new")).withColumn("old", F.lag("new").over(order))
    keys = changed_keys(F.col("old"), F.col("new"), list(diff.VOLATILE))
    return rows.where("old is not null").select("event_id", F.array_join(keys, ";").alias("changed_fields"))


def change_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.drilldown(change_rows(spark, sf_dir))


def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.source_health(paired(spark, sf_dir))


def overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.overall(source_health(spark, sf_dir))


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.field_rows(paired(spark, sf_dir))


def _assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.assessed(paired(spark, sf_dir), LIMITS)


def field_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _assessed(spark, sf_dir).where("field is not null")
    return out.select("before_date", "after_date", "source_name", "field", "identities", "change_rows", "retained_records", "affected_rate", "mass_refresh")


def top_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.top_patterns(fields(spark, sf_dir))


def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.transitions(fields(spark, sf_dir), "status")


def phase_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.transitions(fields(spark, sf_dir), "capital_phase")


_MOVED = ("before_date", "after_date", "source_name", "record_identity", "field", "classification", "difference")


def planned_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.date_movements(fields(spark, sf_dir)).select(*_MOVED)


def cost_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.cost_movements(fields(spark, sf_dir)).select(*_MOVED)


def movement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.movement_summary(analysis.movements(fields(spark, sf_dir)))


def movement_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of movements over all months from sketches kept by month, and whether their true rank is within the sketches' error."""
    by = ["field", "classification"]
    moves = cut(analysis.movements(fields(spark, sf_dir)), "moves")
    kept = cut(sketches.quantile_sketches(moves, analysis.MOVEMENT, "difference"), "sketches")
    told = sketches.merged_quantiles(kept, by, {"median": 0.5})
    ranks = moves.where("difference is not null").join(told.select(*by, "median"), by).groupBy(*by)  # a row for each field and class
    share = ranks.agg(F.avg((F.col("difference") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("difference") <= F.col("median")).cast("double")).alias("up_to"))
    error = sketches.RANK_ERROR
    close = F.coalesce((F.col("below") <= 0.5 + error) & (F.col("up_to") >= 0.5 - error), F.col("n") == 0)
    return told.join(share, by, "left").select(*by, F.col("n").alias("events"), F.round("least", 6).alias("least"), F.round("most", 6).alias("most"), close.alias("median_within_error"))


def sketched_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention and churn of any two observations by source, from a stored sketch for each date: within the stated error of the exact table?"""
    pairs = [*PAIRS, (DATES[0], DATES[2])]
    rows = identity.with_identity(snapshots(spark, sf_dir))
    kept = cut(sketches.set_sketches(rows, ["snapshot_date", "source_name"], "record_identity"), "sketches")
    told = sketches.overlaps(kept, "snapshot_date", pairs, ["source_name"])
    names = ("before_count", "after_count", "retained", "new_records", "disappeared_records")
    # the record's source may change between dates, so both sides are counted by the source they have
    sides = dealt(rows.select("source_name", "record_identity", "snapshot_date"), "record_identity", count=snapshots(spark, sf_dir)).distinct()
    exact = analysis.exact_overlap(sides, pairs)
    both = told.join(exact.toDF("before_date", "after_date", "source_name", *[f"x_{n}" for n in names]), ["before_date", "after_date", "source_name"])
    union = F.col("x_retained") + F.col("x_new_records") + F.col("x_disappeared_records")
    sound = F.lit(True)
    for n in names:
        sound = sound & sketches.within_error(F.col(n), F.col(f"x_{n}"), union)
    return both.select("before_date", "after_date", "source_name", *[F.col(f"x_{n}").alias(n) for n in names], sound.alias("within_error"))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.alert_rows(_assessed(spark, sf_dir))


def alert_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.alert_levels(source_health(spark, sf_dir), alerts(spark, sf_dir))


def excluding_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals without the sources that lost more than a fixed share of their records."""
    strict = analysis.Thresholds(critical_disappearance=0.044, critical_disappearance_min=1)
    health = source_health(spark, sf_dir)
    return analysis.without_critical(health, analysis.source_alerts(health, strict))


def trend_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.eligibility(_assessed(spark, sf_dir), LIMITS)


def interval_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of distinct order months' ends and how it would count."""
    days = table(spark, sf_dir, "orders").select(F.last_day(F.col("o_orderdate").cast("date")).alias("day")).distinct()
    from pyspark.sql import Window

    pairs = days.withColumn("next", F.lead("day").over(Window.partitionBy(F.year("day")).orderBy("day"))).where("next is not null")
    kind = interval_kind(F.col("day"), F.col("next"), "1995-01-31", "1995-06-30")
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return pairs.select(text("day").alias("before_date"), text("next").alias("after_date"), kind.alias("kind"))


def identity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.identity_quality(identity.with_identity(snapshots(spark, sf_dir)))


def change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.history(change_rows(spark, sf_dir), trend_eligibility(spark, sf_dir), "source_name", include_flagged=True)


_FULL = CHANGES.replace("('2026-08-31','2026-09-30'), ('2026-09-30','2026-10-31')", "('2026-08-31','2026-10-31')")


def _diff_sql(cte: str) -> str:
    return (
        cte
        + """ SELECT 'chg-' || left(sha1(concat_ws('|', before_date, after_date, change_type, semantic_type, record_identity, changed_fields)), 16) AS change_id,
        left(after_date, 7) AS comparison_month, before_date AS before_snapshot_date, after_date AS after_snapshot_date, change_type, semantic_type, source_name, record_identity,
        native_id AS source_record_id, changed_fields,
        CASE WHEN changed_fields = '' THEN '' ELSE '{"' || changed_fields || '":"' || old_raw || '"}' END AS old_value,
        CASE WHEN changed_fields = '' THEN '' ELSE '{"' || changed_fields || '":"' || new_raw || '"}' END AS new_value FROM changes"""
    )


_KINDS = ("new_record", "record_disappeared", "status_changed", "estimated_cost_changed", "planned_date_changed", "capital_project_phase_changed")
_MOVES = """, moves AS (
  SELECT before_date, after_date, source_name, record_identity, changed_fields AS field,
    CASE WHEN d > 0 THEN 'moved_later' WHEN d < 0 THEN 'moved_earlier' ELSE 'unchanged_after_normalization' END AS classification, d::DOUBLE AS difference
  FROM (SELECT *, date_diff('day', old_raw::DATE, new_raw::DATE) AS d FROM changes WHERE changed_fields = 'planned_end')),
costs AS (
  SELECT before_date, after_date, source_name, record_identity, changed_fields AS field,
    CASE WHEN d > 0 THEN 'increase' WHEN d < 0 THEN 'decrease' ELSE 'formatting_only_or_equivalent' END AS classification, d::DOUBLE AS difference
  FROM (SELECT *, new_raw::DECIMAL(18,2) - old_raw::DECIMAL(18,2) AS d FROM changes WHERE changed_fields = 'estimated_cost'))"""
_HEALTH = f", health AS ({health_sql('source_name')})"
_FIELDS = f"""{_HEALTH}, conc AS (
  SELECT c.*, h.retained_records, round(identities / nullif(retained_records, 0)::DOUBLE, 6) AS affected_rate,
    coalesce(round(identities / nullif(retained_records, 0)::DOUBLE, 6) >= {LIMITS.mass_refresh} AND identities >= {LIMITS.mass_refresh_min}, false) AS mass_refresh
  FROM (SELECT before_date, after_date, source_name, changed_fields AS field, count(DISTINCT record_identity) AS identities, count(*) AS change_rows
        FROM changes WHERE changed_fields <> '' GROUP BY ALL) c JOIN health h USING (before_date, after_date, source_name))"""
ALERTS_SQL = f"""{_FIELDS}, flags AS (
  SELECT *, round(greatest(0, -absolute_delta) / nullif(before_count, 0)::DOUBLE, 6) AS drop_pct FROM health),
flags2 AS (SELECT *, coalesce(drop_pct >= 0.5 AND -absolute_delta >= {LIMITS.critical_drop_min}, false) AS collapse,
    coalesce(disappearance_rate >= 0.5 AND disappeared_records >= {LIMITS.critical_disappearance_min}, false) AS vanish,
    coalesce(abs(percentage_delta) >= {LIMITS.warning_net_pct} AND abs(absolute_delta) >= {LIMITS.warning_net_min}, false) AS big,
    coalesce(publication_churn >= {LIMITS.warning_churn} AND union_size >= {LIMITS.warning_net_min}, false) AS restless FROM flags),
alerts AS (
  SELECT before_date, after_date, source_name, 'source_count_collapse' AS alert_code, 'critical' AS severity, 'source_drop_pct' AS metric_name, drop_pct AS metric_value, 0.5::DOUBLE AS threshold, -absolute_delta AS records, true AS prevents_trend FROM flags2 WHERE collapse
  UNION ALL SELECT before_date, after_date, source_name, 'critical_disappearance_rate', 'critical', 'disappearance_rate', disappearance_rate, 0.5, disappeared_records, true FROM flags2 WHERE vanish
  UNION ALL SELECT before_date, after_date, source_name, 'large_source_net_change', 'warning', 'percentage_delta', percentage_delta, {LIMITS.warning_net_pct}, abs(absolute_delta), false FROM flags2 WHERE big AND NOT collapse AND NOT vanish
  UNION ALL SELECT before_date, after_date, source_name, 'high_publication_churn', 'warning', 'publication_churn', publication_churn, {LIMITS.warning_churn}, new_records + disappeared_records, false FROM flags2 WHERE restless
  UNION ALL SELECT before_date, after_date, source_name, 'notable_source_net_change', 'informational', 'percentage_delta', percentage_delta, {LIMITS.info_net_pct}, abs(absolute_delta), false FROM flags2
    WHERE abs(percentage_delta) >= {LIMITS.info_net_pct} AND NOT collapse AND NOT vanish AND NOT big AND NOT restless
  UNION ALL SELECT before_date, after_date, source_name, 'mass_field_refresh', 'warning', 'affected_rate', affected_rate, {LIMITS.mass_refresh}, identities, false FROM conc WHERE mass_refresh
  UNION ALL SELECT before_date, after_date, '', 'noncanonical_interval', 'warning', 'canonical_monthly_comparison', 0, 1, date_diff('day', before_date::DATE, after_date::DATE), true FROM pair WHERE before_date < '2026-09-30'),
levels AS (SELECT before_date, after_date, source_name, max(CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END) AS worst FROM alerts GROUP BY ALL),
trend AS (
  SELECT before_date, after_date, CASE WHEN before_date >= '2026-09-30' THEN 'month_end_to_month_end' ELSE 'manual_interval' END AS interval_kind,
    CASE coalesce(max(worst), 0) WHEN 3 THEN 'critical' WHEN 2 THEN 'review' ELSE 'healthy' END AS comparison_status,
    before_date >= '2026-09-30' AND coalesce(max(worst), 0) < 3 AS usable_for_trend,
    coalesce((SELECT string_agg(DISTINCT alert_code, ';' ORDER BY alert_code) FROM alerts a WHERE a.before_date = p.before_date AND a.prevents_trend), '') AS exclusion_reasons
  FROM pair p LEFT JOIN levels USING (before_date, after_date) GROUP BY before_date, after_date)"""
_TRANSITION = " SELECT before_date, after_date, source_name, old_raw AS old, new_raw AS new, count(DISTINCT record_identity) AS records FROM changes WHERE changed_fields = '{f}' GROUP BY ALL"

QUERIES = {
    f.__name__: f
    for f in (
        snapshot_diff, diff_all_pairs, diff_bucketed, diff_summary, diff_source_pivot, diff_residual_fields, change_drilldown, source_health, overall_metrics, field_concentration,
        top_patterns, status_transitions, phase_transitions, planned_movements, cost_changes, movement_summary, movement_sketches, sketched_overlap, alerts, alert_levels, excluding_critical,
        trend_eligibility, interval_kinds, identity_quality, change_history,
    )
}

ORACLE_SQL = {
    "snapshot_diff": _diff_sql(_FULL),
    "diff_all_pairs": _diff_sql(CHANGES),
    "diff_bucketed": f"SELECT * FROM ({_diff_sql(CHANGES)}) WHERE after_snapshot_date = '{DATES[2]}'",
    "diff_summary": CHANGES + " SELECT before_date AS before_snapshot_date, after_date AS after_snapshot_date, source_name, change_type, semantic_type, count(*) AS change_rows, count(DISTINCT record_identity) AS records FROM changes GROUP BY ALL",
    "diff_source_pivot": CHANGES + " SELECT after_date AS after_snapshot_date, source_name, " + ", ".join(f"count(*) FILTER (change_type = '{k}') AS {k}" for k in _KINDS) + " FROM changes GROUP BY ALL",
    "diff_residual_fields": """WITH e AS (SELECT event_id, event_type, regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS k, user_id, ts FROM events),
        p AS (SELECT *, lag(event_id) OVER w AS before, lag(event_type) OVER w AS old_type, lag(k) OVER w AS old_k FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        SELECT event_id, concat_ws(';', CASE WHEN k <> old_k THEN 'k' END, CASE WHEN event_type <> old_type THEN 'type' END) AS changed_fields FROM p WHERE before IS NOT NULL""",
    "change_drilldown": CHANGES + """ SELECT 'chg-' || left(sha1(concat_ws('|', before_date, after_date, change_type, semantic_type, record_identity, changed_fields)), 16) AS change_id,
        change_type, source_name, record_identity, nullif(changed_fields, '') AS field, old_raw AS old_display, new_raw AS new_display FROM changes""",
    "source_health": CTE + _HEALTH + " SELECT * FROM health",
    "overall_metrics": CTE + " " + health_sql(""),
    "field_concentration": CHANGES + _FIELDS + " SELECT * FROM conc",
    "top_patterns": CHANGES + """, n AS (SELECT before_date, after_date, source_name, changed_fields AS field, old_raw AS old, new_raw AS new, count(*) AS change_rows FROM changes WHERE changed_fields <> '' GROUP BY ALL)
        SELECT *, (row_number() OVER (PARTITION BY before_date, after_date, source_name, field ORDER BY change_rows DESC, old, new))::INTEGER AS rank FROM n QUALIFY rank <= 10""",
    "status_transitions": CHANGES + _TRANSITION.replace("{f}", "status"),
    "phase_transitions": CHANGES + _TRANSITION.replace("{f}", "capital_phase"),
    "planned_movements": CHANGES + _MOVES + " SELECT * FROM moves",
    "cost_changes": CHANGES + _MOVES + " SELECT * FROM costs",
    "movement_summary": CHANGES + _MOVES + """ SELECT before_date, after_date, source_name, field, classification, count(*) AS events, round(min(difference), 6) AS least,
        round(median(difference), 6) AS median, round(max(difference), 6) AS most FROM (SELECT * FROM moves UNION ALL SELECT * FROM costs) GROUP BY ALL""",
    "movement_sketches": CHANGES + _MOVES + """ SELECT field, classification, count(difference) AS events, round(min(difference), 6) AS least, round(max(difference), 6) AS most, true AS median_within_error
        FROM (SELECT * FROM moves UNION ALL SELECT * FROM costs) GROUP BY ALL""",
    "sketched_overlap": CTE + """, o AS (SELECT DISTINCT source_name, record_identity, snapshot_date AS d FROM snap), p AS (SELECT * FROM pair UNION ALL VALUES ('2026-08-31', '2026-10-31')),
        s AS (SELECT before_date, after_date, source_name, record_identity, bool_or(d = before_date) AS a, bool_or(d = after_date) AS b FROM p JOIN o ON d IN (before_date, after_date) GROUP BY ALL)
        SELECT before_date, after_date, source_name, count(*) FILTER (a) AS before_count, count(*) FILTER (b) AS after_count, count(*) FILTER (a AND b) AS retained, count(*) FILTER (NOT a) AS new_records, count(*) FILTER (NOT b) AS disappeared_records, true AS within_error FROM s GROUP BY ALL""",
    "alerts": CHANGES + ALERTS_SQL + " SELECT * FROM alerts",
    "alert_levels": CHANGES + ALERTS_SQL + " SELECT before_date, after_date, source_name, CASE coalesce(worst, 0) WHEN 3 THEN 'critical' WHEN 2 THEN 'review' ELSE 'healthy' END AS alert_level FROM health LEFT JOIN levels USING (before_date, after_date, source_name)",
    "excluding_critical": CTE + f", health AS ({health_sql('source_name')}), calm AS (SELECT before_date, after_date, source_name FROM health WHERE NOT (coalesce(disappearance_rate >= 0.044 AND disappeared_records >= 1, false)))"
        + " " + health_sql("").replace("FROM both_sides)", "FROM both_sides) JOIN calm USING (before_date, after_date, source_name)"),
    "trend_eligibility": CHANGES + ALERTS_SQL + " SELECT * FROM trend",
    "interval_kinds": """WITH d AS (SELECT DISTINCT last_day(o_orderdate) AS day FROM orders), n AS (SELECT day, lead(day) OVER (PARTITION BY year(day) ORDER BY day) AS next FROM d)
        SELECT strftime(day, '%Y-%m-%d') AS before_date, strftime(next, '%Y-%m-%d') AS after_date,
          CASE WHEN day = DATE '1995-01-31' THEN 'baseline_followup' WHEN day >= DATE '1995-06-30' AND month(next) - month(day) = 1 THEN 'month_end_to_month_end' ELSE 'manual_interval' END AS kind
        FROM n WHERE next IS NOT NULL""",
    "identity_quality": CTE + """, n AS (SELECT snapshot_date, source_name, nullif(native_id, 'N/A') AS native, count(*) AS n, count(DISTINCT record_identity) AS identities FROM snap GROUP BY ALL)
        SELECT snapshot_date, count(*) FILTER (native IS NOT NULL AND n > 1) AS repeated_native_groups, coalesce(sum(n) FILTER (native IS NOT NULL AND n > 1), 0)::BIGINT AS repeated_native_rows,
          coalesce(sum(n) FILTER (native IS NULL), 0)::BIGINT AS placeholder_ids, sum(n - identities)::BIGINT AS repeated_identities FROM n GROUP BY snapshot_date""",
    "change_history": CHANGES + " SELECT before_date, after_date, source_name, count(*) AS change_rows FROM changes GROUP BY ALL",
}
