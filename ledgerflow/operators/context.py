"""Tables derived from projects, budgets and exports: context rows, staged events, evidence and benchmarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.classify import first_match, inspection_outcome
from ledgerflow.functions.ids import short_id
from ledgerflow.functions.numbers import rate
from ledgerflow.functions.text import clean


def context_rows(budget: DataFrame, activities: DataFrame, project: str, key: str, activity: str = "activity_id", master: str = "master_id") -> DataFrame:
    """Budget rows with the activities and master projects of their project id, as sorted lists kept as text.

    Rows without a project id are left out. match_status tells rows of known activities from
    those of the budget alone. The activities are grouped by project before the join.
    """
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(clean(F.col(c).cast("string")))), ";")
    known = activities.where(F.col(project).isNotNull()).groupBy(project).agg(listed(activity).alias("activity_ids"), listed(master).alias("master_ids"))
    out = budget.where(clean(F.col(project).cast("string")).isNotNull()).join(known, project, "left")
    out = out.withColumn("match_status", F.when(F.col("activity_ids").isNull(), "budget_book_only").otherwise("matched_core_activity"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return out.withColumn("activity_ids", blank("activity_ids")).withColumn("master_ids", blank("master_ids")).withColumn("context_id", short_id("ctx", F.col(project), F.col(key)))


def finance_events(rows: DataFrame, key: str, estimate: Column, actual: Column, funded: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One row per reported estimate, actual cost (positive amounts only) and funding label of a context row."""
    spec = lambda kind, amount, direction, here: F.when(here, F.struct(F.lit(kind).alias("event_type"), amount.cast("decimal(18,2)").alias("amount"), F.lit(direction).alias("direction")))
    found = F.array(
        spec("capital_estimate_reported", estimate, "reported_level", estimate > 0),
        spec("capital_actual_cost_reported", actual, "reported_level", actual > 0),
        spec("funded_status_reported", F.lit(None), "not_applicable", clean(funded).isNotNull()),
    )
    out = rows.select(key, *keep, F.explode(F.array_compact(found)).alias("e"))
    return out.select(short_id("fin", F.col(key), F.col("e.event_type"), F.col("e.amount")).alias("event_id"), key, *keep, "e.event_type", "e.amount", "e.direction")


def staged_events(rows: DataFrame, key: str, dated: Sequence[tuple[str, str]], inspected: str, result: Column, kind: Column, final: Column) -> DataFrame:
    """Lifecycle candidates from fields that say so: (event type, column) pairs, and the outcome of an inspection.

    A passed inspection is a final one where the indicator or its type says so. Blank values give nothing.
    """
    day = lambda c: clean(F.col(c).cast("string"))
    items = [F.when(day(c).isNotNull(), F.struct(F.lit(t).alias("event_type"), day(c).alias("event_date"), F.lit(c).alias("field"), day(c).alias("value"))) for t, c in dated]
    outcome = inspection_outcome(result)
    passed = outcome.isin("passed", "final") | F.lower(result).contains("complete")
    last = F.coalesce(F.lower(final).isin("yes", "y", "true", "1"), F.lit(False)) | F.coalesce(F.lower(kind).contains("final"), F.lit(False))
    named = F.when(F.coalesce(passed, F.lit(False)) & last, "final_inspection_passed").when(F.coalesce(passed, F.lit(False)), "inspection_passed").otherwise("inspection_failed")
    told = F.concat_ws("; ", clean(kind), clean(result))
    items.append(F.when(day(inspected).isNotNull() & clean(result).isNotNull(), F.struct(named.alias("event_type"), day(inspected).alias("event_date"), F.lit("inspection").alias("field"), told.alias("value"))))
    out = rows.select(F.col(key).alias("k"), F.explode(F.array_compact(F.array(*items))).alias("e"))
    return out.select(short_id("evt", F.col("k"), F.col("e.event_type"), F.col("e.event_date"), F.col("e.value")).alias("event_id"), F.col("k").alias(key), "e.event_type", "e.event_date", "e.field", "e.value")


def rolled_up(matches: DataFrame, key: str, folio: str, building: str, year: str, confidence: str) -> DataFrame:
    """Matches of each activity as one row: folios, number of buildings, first and last year, best confidence."""
    has = lambda word: F.coalesce(F.bool_or(F.col(confidence) == word), F.lit(False))
    return matches.groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_set(clean(F.col(folio).cast("string")))), ";").alias("folios"),
        F.countDistinct(building).alias("buildings"),
        F.min(F.col(year).try_cast("int")).alias("first_year"),
        F.max(F.col(year).try_cast("int")).alias("last_year"),
        F.when(has("high"), "high").when(has("medium"), "medium").otherwise("low").alias("best_confidence"),
    )


#: Words of a status, each as it may stand within it.
INACTIVE, CLOSED_OUT, UNDER_WAY = ("cancel", "withdraw", "deny", "expire"), ("closeout",), ("construction",)
#: Grade and basis of each state of evidence, the first that holds counts.
EVIDENCE = {
    "inactive": ("X", "inactive_official_status"),
    "built": ("D", "permit_plus_current_footprint_year_built_supporting_only"),
    "closed_out": ("D", "city_capital_project_closeout_status_supporting_only"),
    "under_way": ("C", "city_capital_project_construction_status"),
    "planning": ("P", "planning_application_only"),
    "otherwise": ("U", "insufficient_completion_evidence"),
}


def _says(status: Column, words: Sequence[str]) -> Column:
    """Does any of the words stand in a status?"""
    text = F.lower(F.coalesce(status, F.lit("")))
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: text.contains(w))


def evidence(status: Column, kind: Column, permit_year: Column, last_year: Column, capital: Column, building: Sequence[str], planning: Sequence[str]) -> Column:
    """struct of grade and basis of an activity with its matches; no grade says that work was completed."""
    said = lambda words: _says(status, words)
    sure = lambda c: F.coalesce(c, F.lit(False))
    holds = {
        "inactive": said(INACTIVE),
        "built": sure((last_year >= permit_year - 1) & kind.isin(*building)),
        "closed_out": sure(capital) & said(CLOSED_OUT),
        "under_way": sure(capital) & said(UNDER_WAY),
        "planning": sure(kind.isin(*planning)),
        "otherwise": F.lit(True),
    }
    named = lambda name: F.struct(*[F.lit(v).alias(n) for v, n in zip(EVIDENCE[name], ("grade", "basis"), strict=True)])
    return first_match([(holds[name], named(name)) for name in EVIDENCE], F.lit(None).cast("struct<grade:string,basis:string>"))


def with_evidence(activities: DataFrame, matches: DataFrame, key: str, graded: Column) -> DataFrame:
    """activities with their rolled-up matches (null where there is none) and grade and basis; ``graded`` may use both."""
    return activities.join(matches, key, "left").withColumn("_g", graded).select("*", "_g.grade", "_g.basis").drop("_g")


def truth(rows: DataFrame, key: str, status: Column, stage: Column, planning: Column, seen: Column) -> DataFrame:
    """What is known of each activity in words: started and cancelled, and what no status can tell."""
    text = F.lower(F.coalesce(status, F.lit("")))
    words = lambda *some: first_match([(text.contains(w), F.lit(True)) for w in some], F.lit(False))
    names = ("grade", "basis", "started", "cancelled")
    known = lambda *v: F.struct(*[F.lit(x).alias(n) for x, n in zip(v, names, strict=True)])
    rules = [
        (words("cancel", "withdraw", "denied", "expired"), known("X", "inactive_official_status", "unknown", "yes")),
        (words("construction") | (stage == "construction_or_inspection"), known("C", "official_construction_or_inspection_status", "yes", "unknown")),
        (planning, known("P", "planning_application_only", "not_applicable", "unknown")),
        ((stage == "permit_or_funding_approved") | words("issued", "approved"), known("D", "permit_or_funding_approved_only", "unknown", "unknown")),
    ]
    open_ = F.when(planning, "not_applicable").otherwise("unknown")
    out = rows.withColumn("t", first_match(rules, known("U", "insufficient_completion_evidence", "unknown", "unknown")))
    return out.select(key, F.col("t.grade"), F.col("t.basis"), F.col("t.started"), open_.alias("completed"), F.col("t.cancelled"), seen.alias("verified_on"))


def singletons(activities: DataFrame, key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(projects, links): each activity as a provisional project of its own, until a review says otherwise."""
    master = short_id("mp", F.col(key))
    projects = activities.select(master.alias("master_id"), clean(F.col(name)).alias("project_name"), F.lit(1).alias("activities"), F.lit("provisional_singleton").alias("status"))
    links = activities.select(master.alias("master_id"), F.col(key), F.lit("no_safe_cross_activity_merge").alias("method"), F.lit("needs_review").alias("review_status"))
    return projects, links


def benchmark(rows: DataFrame, year: Column, official: DataFrame) -> DataFrame:
    """official (year, total) with the rows found for each year and their ratio, which is no coverage rate."""
    n = rows.groupBy(year.alias("year")).agg(F.count("*").alias("found"))
    out = official.join(n, "year", "left").withColumn("found", F.coalesce("found", F.lit(0).cast("long")))
    return out.withColumn("diagnostic_ratio", F.round(rate(F.col("found"), F.col("total")), 4))


def amount_faults(amounts: DataFrame, sources: DataFrame, key: str, kind: str, fields: dict[str, str], amount: str, tolerance: float = 0.005) -> DataFrame:
    """Amounts that are not the value of their source field within the tolerance, or whose source is missing."""
    wide = sources.select(key, *[F.col(c).cast("double").alias(f"_{c}") for c in dict.fromkeys(fields.values())])
    told = first_match([(F.col(kind) == k, F.col(f"_{c}")) for k, c in fields.items()], F.lit(None).cast("double"))
    met = amounts.join(wide, key, "left")
    same = F.abs(told - F.col(amount).cast("double")) <= tolerance
    return met.where(~F.coalesce(same, F.lit(False))).select(*amounts.columns)


def location_counts(activities: DataFrame, locations: DataFrame, key: str, geometry: str) -> DataFrame:
    """activities with location_count: their distinct geometries, 0 without any."""
    n = locations.where(F.col(geometry).isNotNull()).groupBy(key).agg(F.countDistinct(geometry).alias("location_count"))
    return activities.join(n, key, "left").withColumn("location_count", F.coalesce("location_count", F.lit(0).cast("long")))


def verification_queue(activities: DataFrame, candidate: str, realized: str) -> DataFrame:
    """Candidates of physical work that are not known to be realised."""
    return activities.where(F.coalesce(F.col(candidate) == 1, F.lit(False)) & ~F.coalesce(F.col(realized) == 1, F.lit(False)))


def spatially_relevant(locations: DataFrame, activities: DataFrame, key: str, kind: str, kinds: Sequence[str], latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Located rows of activities of some classes."""
    some = activities.where(F.col(kind).isin(*kinds)).select(key)
    return locations.where(F.col(latitude).isNotNull() & F.col(longitude).isNotNull()).join(some, key, "left_semi")


def with_current(history: DataFrame, current: DataFrame, identity: str, columns: Sequence[str]) -> DataFrame:
    """A history with columns of the current table, by identity; null where the record is gone."""
    return history.join(current.select(identity, *columns), identity, "left")
