"""Analysis of changes: source health, field concentration, transitions, alerts, trend eligibility."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.classify import cost_movement, date_movement
from ledgerflow.functions.dates import interval_kind, parse_date
from ledgerflow.functions.numbers import money, rate
from ledgerflow.functions.text import clean, display_value
from ledgerflow.functions.urls import valid_url
from ledgerflow.operators.diff import TRACKED, Tracked, changed_fields
from ledgerflow.operators.identity import is_placeholder
from ledgerflow.operators.ranges import exact_quantiles, value_counts
from ledgerflow.sources.workspace import cut


@dataclass(frozen=True)
class Thresholds:
    critical_drop_pct: float = 0.5
    critical_drop_min: int = 100
    critical_disappearance: float = 0.5
    critical_disappearance_min: int = 100
    warning_net_pct: float = 0.2
    warning_net_min: int = 25
    warning_churn: float = 0.3
    mass_refresh: float = 0.75
    mass_refresh_min: int = 25
    info_net_pct: float = 0.05
    flag_noncanonical: bool = True
    baseline: str = "2026-08-23"
    canonical_start: str = "2026-09-30"


SEVERITY = {"informational": 1, "warning": 2, "critical": 3}
COUNTS = ("before_count", "after_count", "new_records", "disappeared_records")


def _counts() -> list[Column]:
    old, new = F.col("old").isNotNull(), F.col("new").isNotNull()
    return [
        F.count_if(old).alias("before_count"),
        F.count_if(new).alias("after_count"),
        F.count_if(new & ~old).alias("new_records"),
        F.count_if(old & ~new).alias("disappeared_records"),
    ]


def _ratios(df: DataFrame) -> DataFrame:
    c = F.col
    return (
        df.withColumn("absolute_delta", c("after_count") - c("before_count"))
        .withColumn("percentage_delta", rate(c("absolute_delta"), c("before_count")))
        .withColumn("retained_records", c("before_count") - c("disappeared_records"))
        .withColumn("union_size", c("before_count") + c("new_records"))
        .withColumn("retention_rate", rate(c("retained_records"), c("before_count")))
        .withColumn("disappearance_rate", rate(c("disappeared_records"), c("before_count")))
        .withColumn("publication_churn", rate(c("new_records") + c("disappeared_records"), c("union_size")))
    )


def source_health(both: DataFrame) -> DataFrame:
    """Counts and rates per pair of dates and source, from paired records."""
    source = F.coalesce("new.source_name", "old.source_name").alias("source_name")
    return _ratios(both.groupBy("before_date", "after_date", source).agg(*_counts()))


def overall(health: DataFrame) -> DataFrame:
    """The same over all sources of each pair."""
    return _ratios(health.groupBy("before_date", "after_date").agg(*[F.sum(c).alias(c) for c in COUNTS]))


def field_rows(change_rows: DataFrame) -> DataFrame:
    """One row per change and field, with old_raw and new_raw."""
    out = change_rows.where("changed_fields <> ''").withColumn("field", F.explode(F.split("changed_fields", ";")))
    value = lambda c: F.element_at(F.from_json(c, "map<string,string>"), F.col("field"))
    return out.select(
        F.col("before_snapshot_date").alias("before_date"), F.col("after_snapshot_date").alias("after_date"),
        "change_type", "source_name", "record_identity", "field", value("old_value").alias("old_raw"), value("new_value").alias("new_raw"),
    )


def field_concentration(fields: DataFrame, health: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """How many retained records each field changed in, and whether it looks like a mass refresh."""
    by = ["before_date", "after_date", "source_name"]
    counted = fields.groupBy(*by, "field").agg(F.countDistinct("record_identity").alias("identities"), F.count("*").alias("change_rows"))
    out = counted.join(health.select(*by, "retained_records"), by)
    affected = rate(F.col("identities"), F.col("retained_records"))
    mass = F.coalesce((affected >= t.mass_refresh) & (F.col("identities") >= t.mass_refresh_min), F.lit(False))
    return out.withColumn("affected_rate", affected).withColumn("mass_refresh", mass)


def top_patterns(fields: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent old -> new values per source and field."""
    counted = fields.groupBy("before_date", "after_date", "source_name", "field", display_value(F.col("old_raw")).alias("old"), display_value(F.col("new_raw")).alias("new")).agg(
        F.count("*").alias("change_rows")
    )
    order = Window.partitionBy("before_date", "after_date", "source_name", "field").orderBy(F.desc("change_rows"), "old", "new")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def transitions(fields: DataFrame, field: str) -> DataFrame:
    return (
        fields.where(F.col("field") == field)
        .groupBy("before_date", "after_date", "source_name", display_value(F.col("old_raw")).alias("old"), display_value(F.col("new_raw")).alias("new"))
        .agg(F.countDistinct("record_identity").alias("records"))
    )


def date_movements(fields: DataFrame, names: tuple[str, ...] = ("planned_start", "planned_end")) -> DataFrame:
    old, new = parse_date(F.col("old_raw")), parse_date(F.col("new_raw"))
    out = fields.where(F.col("field").isin(*names)).withColumn("old_day", old).withColumn("new_day", new)
    kind = date_movement(F.col("old_raw"), F.col("new_raw"), F.col("old_day"), F.col("new_day"))
    return out.withColumn("classification", kind).withColumn("difference", F.datediff("new_day", "old_day").cast("double"))


def cost_movements(fields: DataFrame, names: tuple[str, ...] = ("estimated_cost", "actual_cost")) -> DataFrame:
    out = fields.where(F.col("field").isin(*names)).withColumn("old_cost", money(F.col("old_raw"))).withColumn("new_cost", money(F.col("new_raw")))
    kind = cost_movement(F.col("old_raw"), F.col("new_raw"), F.col("old_cost"), F.col("new_cost"))
    return out.withColumn("classification", kind).withColumn("difference", (F.col("new_cost") - F.col("old_cost")).cast("double"))


def movements(fields: DataFrame, days: tuple[str, ...] = ("planned_start", "planned_end"), costs: tuple[str, ...] = ("estimated_cost", "actual_cost")) -> DataFrame:
    """Dates and costs that moved, in one pass: classification, and difference in days or money."""
    old, new = F.col("old_raw"), F.col("new_raw")
    out = fields.where(F.col("field").isin(*days, *costs)).withColumns({"old_day": parse_date(old), "new_day": parse_date(new), "old_cost": money(old), "new_cost": money(new)})
    is_day = F.col("field").isin(*days)
    kind = F.when(is_day, date_movement(old, new, F.col("old_day"), F.col("new_day"))).otherwise(cost_movement(old, new, F.col("old_cost"), F.col("new_cost")))
    moved = F.when(is_day, F.datediff("new_day", "old_day").cast("double")).otherwise((F.col("new_cost") - F.col("old_cost")).cast("double"))
    return out.withColumn("classification", kind).withColumn("difference", moved)


MOVEMENT = ("before_date", "after_date", "source_name", "field", "classification")


def movement_summary(moves: DataFrame) -> DataFrame:
    """Number, least, median and largest difference per pair, source, field and class.

    All come from counts of the different differences (days, or amounts to the cent); the median is exact
    and found by ranges of these, so that no group's values meet in one task.
    """
    counts = cut(value_counts(moves, MOVEMENT, "difference"), "counts")
    ends = counts.groupBy(*MOVEMENT).agg(F.sum("n").alias("events"), F.round(F.min("difference"), 6).alias("least"), F.round(F.max("difference"), 6).alias("most"))
    median = exact_quantiles(counts, MOVEMENT, "difference", {"median": 0.5}).toDF(*[f"_{c}" for c in MOVEMENT], "median")
    same = F.lit(True)
    for c in MOVEMENT:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return ends.join(median, same).select(*MOVEMENT, "events", "least", F.round("median", 6).alias("median"), "most")


def exact_overlap(members: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """before_count, after_count, retained, new and disappeared records per pair and source, counted.

    members: source_name, record_identity and snapshot_date, each once.
    """
    dates = F.array(*[F.struct(F.lit(a).alias("before_date"), F.lit(b).alias("after_date")) for a, b in pairs])
    day = F.col("snapshot_date").cast("string")
    rows = members.withColumn("p", F.explode(dates)).where((day == F.col("p.before_date")) | (day == F.col("p.after_date")))
    per = rows.groupBy("p", "source_name", "record_identity").agg(F.bool_or(day == F.col("p.before_date")).alias("a"), F.bool_or(day == F.col("p.after_date")).alias("b"))
    a, b = F.col("a"), F.col("b")
    counts = [F.count_if(a).alias("before_count"), F.count_if(b).alias("after_count"), F.count_if(a & b).alias("retained"), F.count_if(~a).alias("new_records"), F.count_if(~b).alias("disappeared_records")]
    return per.groupBy("p", "source_name").agg(*counts).select("p.before_date", "p.after_date", "source_name", "before_count", "after_count", "retained", "new_records", "disappeared_records")


def identity_quality(identified: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Per snapshot: repeated native ids (groups and rows), placeholder ids, repeated identities."""
    placeholder = is_placeholder(F.col("native_id"))
    native = identified.withColumn("native", F.when(~placeholder, F.upper(clean(F.col("native_id")))))
    by_native = native.groupBy(date, "source_name", "native").agg(F.count("*").alias("n"), F.countDistinct("record_identity").alias("identities"))
    repeated = F.col("native").isNotNull() & (F.col("n") > 1)
    return by_native.groupBy(date).agg(
        F.count_if(repeated).alias("repeated_native_groups"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("repeated_native_rows"),
        F.coalesce(F.sum(F.when(F.col("native").isNull(), F.col("n"))), F.lit(0)).alias("placeholder_ids"),
        F.sum(F.col("n") - F.col("identities")).alias("repeated_identities"),
    )


def link_quality(change_rows: DataFrame, url: str = "source_url") -> DataFrame:
    blank = clean(F.col(url)).isNull()
    return change_rows.agg(F.count_if(blank).alias("blank_links"), F.count_if(~blank & ~valid_url(F.col(url))).alias("malformed_links"))


_ALERT_COLUMNS = ("alert_code", "severity", "metric_name", "metric_value", "threshold", "records", "prevents_trend")


def _alert(code: str, severity: str, metric: str, value: Column, threshold: float, records: Column, prevents: bool, when: Column) -> Column:
    row = F.struct(
        F.lit(code).alias("alert_code"), F.lit(severity).alias("severity"), F.lit(metric).alias("metric_name"), value.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold"), records.cast("long").alias("records"), F.lit(prevents).alias("prevents_trend"),
    )
    return F.when(F.coalesce(when, F.lit(False)), row)


def _of_source(t: Thresholds, failed: Column | None = None) -> Column:
    """The alerts of a row of source health, as an array. ``failed`` marks sources with a documented collection fault.

    A large net change is a warning only without a critical reason, and a notable one is
    mentioned only if nothing else was.
    """
    c = F.col
    failed = F.lit(False) if failed is None else failed
    delta, pct, churn = c("absolute_delta"), F.abs(c("percentage_delta")), c("publication_churn")
    drop = rate(F.greatest(F.lit(0), -delta), c("before_count"))
    collapse = (drop >= t.critical_drop_pct) & (-delta >= t.critical_drop_min)
    vanish = (c("disappearance_rate") >= t.critical_disappearance) & (c("disappeared_records") >= t.critical_disappearance_min)
    serious = failed | F.coalesce(collapse, F.lit(False)) | F.coalesce(vanish, F.lit(False))
    large = (pct >= t.warning_net_pct) & (F.abs(delta) >= t.warning_net_min) & ~serious
    restless = (churn >= t.warning_churn) & (c("union_size") >= t.warning_net_min)
    quiet = ~serious & ~F.coalesce(large, F.lit(False)) & ~F.coalesce(restless, F.lit(False))
    moved = c("new_records") + c("disappeared_records")
    return F.array_compact(
        F.array(
            _alert("collection_integrity_failure", "critical", "collection_integrity_passed", F.lit(0.0), 1.0, c("after_count"), True, failed),
            _alert("source_count_collapse", "critical", "source_drop_pct", drop, t.critical_drop_pct, -delta, True, collapse),
            _alert("critical_disappearance_rate", "critical", "disappearance_rate", c("disappearance_rate"), t.critical_disappearance, c("disappeared_records"), True, vanish),
            _alert("large_source_net_change", "warning", "percentage_delta", c("percentage_delta"), t.warning_net_pct, F.abs(delta), False, large),
            _alert("high_publication_churn", "warning", "publication_churn", churn, t.warning_churn, moved, False, restless),
            _alert("notable_source_net_change", "informational", "percentage_delta", c("percentage_delta"), t.info_net_pct, F.abs(delta), False, (pct >= t.info_net_pct) & quiet),
        )
    )


def source_alerts(health: DataFrame, t: Thresholds = Thresholds(), failed: Column | None = None) -> DataFrame:
    """Threshold alerts per source."""
    return health.select("before_date", "after_date", "source_name", F.explode(_of_source(t, failed)).alias("a")).select("before_date", "after_date", "source_name", "a.*")


def _of_field(t: Thresholds) -> Column:
    return _alert("mass_field_refresh", "warning", "affected_rate", F.col("affected_rate"), t.mass_refresh, F.col("identities"), False, F.col("mass_refresh"))


def _of_interval(t: Thresholds) -> Column:
    before, after = F.to_date("before_date"), F.to_date("after_date")
    odd = (interval_kind(before, after, t.baseline, t.canonical_start) != "month_end_to_month_end") & F.lit(t.flag_noncanonical)
    return _alert("noncanonical_interval", "warning", "canonical_monthly_comparison", F.lit(0.0), 1.0, F.datediff(after, before), True, odd)


def field_alerts(concentration: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    rows = concentration.where("mass_refresh")
    return rows.select("before_date", "after_date", "source_name", _of_field(t).alias("a")).select("before_date", "after_date", "source_name", "a.*")


def interval_alerts(health: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One alert for each pair of dates that is no month-end comparison."""
    rows = health.select("before_date", "after_date").distinct()
    out = rows.select("before_date", "after_date", F.lit("").alias("source_name"), _of_interval(t).alias("a")).where("a is not null")
    return out.select("before_date", "after_date", "source_name", "a.*")


def assessed(both: DataFrame, t: Thresholds = Thresholds(), tracked: Sequence[Tracked] = TRACKED) -> DataFrame:
    """Everything that alerts need, from one aggregation of paired records.

    One row per pair and source (field null) with its counts and rates, and one per field that
    changed there (identities, change_rows, affected_rate, mass_refresh); both with their alerts
    as an array. The alert on a pair's interval stands at its first source. What follows the
    aggregation works on a row per pair, source and field.
    """
    source = F.coalesce("new.source_name", "old.source_name").alias("source_name")
    names = F.concat(F.array(F.lit(None).cast("string")), F.transform(changed_fields(both, tracked), lambda f: f["name"]))
    rows = both.select("before_date", "after_date", source, "record_identity", "old", "new", F.explode(names).alias("field"))
    counted = _ratios(rows.groupBy("before_date", "after_date", "source_name", "field").agg(*_counts(), F.count("record_identity").alias("identities"), F.count("*").alias("change_rows")))
    whole = F.col("field").isNull()
    mine = Window.partitionBy("before_date", "after_date", "source_name")
    pair = Window.partitionBy("before_date", "after_date").orderBy("source_name", "field")
    retained = F.max(F.when(whole, F.col("retained_records"))).over(mine)
    out = counted.withColumn("retained_records", retained).withColumn("affected_rate", rate(F.col("identities"), F.col("retained_records")))
    mass = ~whole & F.coalesce((F.col("affected_rate") >= t.mass_refresh) & (F.col("identities") >= t.mass_refresh_min), F.lit(False))
    out = out.withColumn("mass_refresh", mass).withColumn("first", F.row_number().over(pair) == 1)
    placed = lambda alerts, where: F.transform(alerts, lambda a: F.struct(where.alias("source_name"), *[a[c].alias(c) for c in _ALERT_COLUMNS]))
    own = F.when(whole, _of_source(t)).otherwise(F.array_compact(F.array(_of_field(t))))
    of_pair = F.when(F.col("first"), F.array_compact(F.array(_of_interval(t)))).otherwise(F.filter(F.array(_of_interval(t)), lambda a: F.lit(False)))
    return out.withColumn("alerts", F.concat(placed(own, F.col("source_name")), placed(of_pair, F.lit("")))).drop("first")


def alert_rows(checked: DataFrame) -> DataFrame:
    """The alerts of ``assessed`` rows, one per row."""
    return checked.select("before_date", "after_date", F.explode("alerts").alias("a")).select("before_date", "after_date", "a.*")


def eligibility(checked: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """trend_eligibility from ``assessed`` rows, in one aggregation per pair of dates."""
    worst = F.max(F.array_max(F.transform("alerts", lambda a: severity_rank(a["severity"])))).alias("worst")
    codes = F.transform(F.filter("alerts", lambda a: a["prevents_trend"]), lambda a: a["alert_code"])
    per = checked.groupBy("before_date", "after_date").agg(worst, F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(codes)))), ";").alias("exclusion_reasons"))
    return _statuses(per, t)


def all_alerts(health: DataFrame, concentration: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    return source_alerts(health, t).unionByName(field_alerts(concentration, t)).unionByName(interval_alerts(health, t))


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "critical", 3).when(severity == "warning", 2).when(severity == "informational", 1).otherwise(0)


def alert_levels(health: DataFrame, alerts: DataFrame) -> DataFrame:
    """critical, review or healthy per source."""
    by = ["before_date", "after_date", "source_name"]
    worst = alerts.groupBy(*by).agg(F.max(severity_rank(F.col("severity"))).alias("worst"))
    level = F.when(F.col("worst") == 3, "critical").when(F.col("worst") == 2, "review").otherwise("healthy")
    return health.select(*by).join(worst, by, "left").select(*by, level.alias("alert_level"))


def without_critical(health: DataFrame, alerts: DataFrame) -> DataFrame:
    """Totals without the sources that have a critical alert."""
    by = ["before_date", "after_date", "source_name"]
    return overall(health.join(alerts.where("severity = 'critical'").select(*by).distinct(), by, "left_anti"))


def _statuses(worst: DataFrame, t: Thresholds) -> DataFrame:
    kind = interval_kind(F.to_date("before_date"), F.to_date("after_date"), t.baseline, t.canonical_start)
    rank = F.coalesce("worst", F.lit(0))
    return worst.select(
        "before_date", "after_date", kind.alias("interval_kind"),
        F.when(rank == 3, "critical").when(rank == 2, "review").otherwise("healthy").alias("comparison_status"),
        ((kind == "month_end_to_month_end") & (rank < 3)).alias("usable_for_trend"),
        F.coalesce("exclusion_reasons", F.lit("")).alias("exclusion_reasons"),
    )


def trend_eligibility(health: DataFrame, alerts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Status of each comparison and whether it may enter a trend."""
    by = ["before_date", "after_date"]
    worst = alerts.groupBy(*by).agg(
        F.max(severity_rank(F.col("severity"))).alias("worst"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("prevents_trend"), F.col("alert_code")))), ";").alias("exclusion_reasons"),
    )
    return _statuses(health.select(*by).distinct().join(worst, by, "left"), t)


def history(change_rows: DataFrame, trend: DataFrame, by: str = "change_type", include_flagged: bool = False) -> DataFrame:
    """Changes per comparison and type or source; only comparisons fit for trends, unless asked for all."""
    keys = [F.col("before_snapshot_date").alias("before_date"), F.col("after_snapshot_date").alias("after_date")]
    counted = change_rows.groupBy(*keys, F.col(by)).agg(F.count("*").alias("change_rows"))
    fit = trend if include_flagged else trend.where("usable_for_trend")
    return counted.join(fit.select("before_date", "after_date"), ["before_date", "after_date"], "left_semi")
