"""Long-format events, amounts, evidence and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.ids import short_id


def events(rows: DataFrame, key: str, items: list[tuple[str, Column, Column]]) -> DataFrame:
    """One row per item (event type, date, condition) that holds: event_id, key, event_type, event_date."""
    found = F.array(*[F.when(F.coalesce(when & day.isNotNull(), F.lit(False)), F.struct(F.lit(kind).alias("event_type"), day.cast("date").alias("event_date"))) for kind, day, when in items])
    out = rows.select(key, F.explode(F.array_compact(found)).alias("e"))
    day = F.date_format("e.event_date", "yyyy-MM-dd")
    return out.select(short_id("evt", F.col(key), F.col("e.event_type"), day).alias("event_id"), key, F.col("e.event_type").alias("event_type"), day.alias("event_date"))


def amounts(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Positive amounts in long format: keys, measure, amount."""
    long = rows.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(keys, measures, "measure", "amount")
    return long.where("amount > 0")


def match_diagnostics(matches: DataFrame, method: str, confidence: str, key: str) -> DataFrame:
    """Rows, distinct keys and share of all rows per method and confidence."""
    counted = matches.groupBy(method, confidence).agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"))
    total = counted.agg(F.sum("rows").alias("total"))
    return counted.join(F.broadcast(total)).select(method, confidence, "rows", "keys", F.round(F.col("rows") / F.col("total"), 6).alias("share"))


def grouped_links(links: DataFrame, keys: list[str], evidence: str, label: str, ranks: dict[str, int]) -> DataFrame:
    """One row per pair of keys: number of links, sorted distinct evidence, best label by rank."""
    rank = F.lit(0)
    for name, r in ranks.items():
        rank = F.when(F.col(label) == name, r).otherwise(rank)
    return links.groupBy(*keys).agg(F.count("*").alias("links"), F.array_join(F.array_sort(F.collect_set(evidence)), ";").alias("evidence"), F.max_by(label, rank).alias("best"))


def universe_counts(members: DataFrame, universe: DataFrame, on: list[str]) -> DataFrame:
    """For each group of the universe: its size, the members found in it, and the rest (members outside it count as strays)."""
    u = universe.groupBy(*on).agg(F.count("*").alias("universe"))
    m = members.groupBy(*on).agg(F.count("*").alias("members"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    out = u.join(m, on, "full_outer").select(*on, zero("universe").alias("universe"), zero("members").alias("members"))
    return out.withColumn("missing", F.greatest(F.lit(0).cast("long"), F.col("universe") - F.col("members"))).withColumn("stray", F.col("universe") == 0)


def cases(rows: DataFrame, key: str, claims: dict[str, Column], evidence: dict[str, Column]) -> DataFrame:
    """Nested cases as JSON: the key, which claims are unresolved, and what evidence there is."""
    open_claims = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in claims.items()]))
    known = F.filter(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in evidence.items()]), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    out = rows.select(F.col(key).alias("k"), open_claims.alias("claims"), known.alias("known")).where(F.size("claims") > 0)
    return out.select(
        short_id("case", F.col("k")).alias("case_id"), F.col("k").alias(key), F.array_join("claims", ";").alias("claims"), F.size("known").cast("long").alias("known_evidence"), F.to_json("known").alias("known_json")
    )
