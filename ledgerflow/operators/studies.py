"""Frames of validation studies: strata, risk portfolios, and which reviews count as complete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.classify import first_match
from ledgerflow.functions.dates import period_bucket
from ledgerflow.functions.ids import sample_rank
from ledgerflow.functions.jsonmap import split_list
from ledgerflow.operators import sampling

#: Layers of an activity and the stratum they put it in, in order.
STRATA = (
    (("historic_preservation",), "historic_preservation"),
    (("development_coordination",), "planning"),
    (("capital_",), "capital_project"),
    (("construction_inspections", "single_family_permits"), "permit"),
)
MANY_LAYERS = "cross_source_merge"
AMBIGUOUS, SUPPRESSED, MATCHED, UNMATCHED = "ambiguous_or_multi_candidate", "duplicate_suppression", "matched_existing", "retained_unmatched"
#: How a link came about: what a disposition must hold (or be) for a stratum, the first that does counts.
LINKS = ((AMBIGUOUS, "contains", "ambiguous"), (SUPPRESSED, "contains", "duplic"), (MATCHED, "equals", "merged_existing_activity"))
RARE, COMMON = "relatively_rare_type", "common_type"
#: A type is rare below so many records.
RARE_BELOW = 500


def layer_stratum(memberships: Column) -> Column:
    """From a list of layers kept as text; null if there is no stratum for it, which a check must report."""
    layers = split_list(memberships)
    has = lambda starts: F.exists(layers, lambda x: first_match([(x.startswith(s), F.lit(True)) for s in starts], F.lit(False)))
    rules = [(F.size(layers) > 1, F.lit(MANY_LAYERS)), *[(has(starts), F.lit(name)) for starts, name in STRATA]]
    return first_match(rules, F.lit(None).cast("string"))


def link_stratum(disposition: Column, review: Column) -> Column:
    """From how a link was disposed of; one that waits for a review is ambiguous whatever it says."""
    text = F.lower(F.coalesce(disposition, F.lit("")))
    waits = F.coalesce(F.lower(review) == "true", F.lit(False))
    told = [(text.contains(word) if how == "contains" else text == word, F.lit(stratum)) for stratum, how, word in LINKS]
    return first_match([(waits, F.lit(AMBIGUOUS)), *told], F.lit(UNMATCHED))


def observation_type(label: Column) -> Column:
    return F.when(label == "prospective_snapshot", "prospective").otherwise("retrospective")


def with_rarity(rows: DataFrame, *kind: str, below: int = RARE_BELOW) -> DataFrame:
    """Adds rarity: does a row's type have few rows? Counts are joined, so a common type is not gathered in one task."""
    counts = rows.groupBy(*kind).agg(F.count("*").alias("_n"))
    met = rows.alias("r").join(counts.alias("c"), [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in kind])
    return met.select("r.*", F.when(F.col("_n") < below, RARE).otherwise(COMMON).alias("rarity"))


def framed(rows: DataFrame, module: str, kind: str, day: Column, label: Column, below: int = RARE_BELOW) -> DataFrame:
    """rows with sampling_stratum: module, observation type, period and rarity of the type, joined by |."""
    out = with_rarity(rows, module, kind, below=below)
    parts = (F.coalesce(F.nullif(F.col(module), F.lit("")), F.lit("unknown_module")), observation_type(label), period_bucket(day), F.col("rarity"))
    return out.withColumn("sampling_stratum", F.concat_ws("|", *parts)).drop("rarity")


def study(rows: DataFrame, key: str, target: int, seed: int, name: str, least: int = 2, second_share: float = 0.25, stratum: str = "sampling_stratum") -> DataFrame:
    """The primary sample of a framed universe, with second_review marking a share of it, drawn by stratum too."""
    sizes = sampling.stratum_sizes(rows, stratum)
    primary = sampling.stratified(rows, key, stratum, sampling.allocate(sizes, target, least), seed, name)
    chosen = primary.select(key, stratum)
    again = sampling.stratified(chosen, key, stratum, sampling.allocate(sampling.stratum_sizes(chosen, stratum), max(1, round(target * second_share))), seed, name, "second_review")
    return primary.join(again.select(key, F.lit(True).alias("second_review")), key, "left").withColumn("second_review", F.coalesce("second_review", F.lit(False)))


def portfolio(rows: DataFrame, key: str, component: str, difficult: Column, difficult_count: int, control_count: int, seed: int) -> DataFrame:
    """So many difficult rows and, of all that are left, so many controls: rows with component and risk_tier.

    Both are the first by rank token. The counts are what is asked for, so the draw is small.
    """
    token = lambda purpose: sample_rank(seed, component, purpose, F.lit(""), F.col(key).cast("string"))
    hard = rows.where(F.coalesce(difficult, F.lit(False))).orderBy(token("difficult"), key).limit(difficult_count)
    rest = rows.join(hard.select(key), key, "left_anti").orderBy(token("control"), key).limit(control_count)
    return hard.withColumn("risk_tier", F.lit("elevated")).unionByName(rest.withColumn("risk_tier", F.lit("control"))).withColumn("component", F.lit(component))


def numbered_cases(chosen: DataFrame, key: str, prefix: str, seed: int) -> DataFrame:
    """case_id in an order that tells nothing: by component, then by rank token. For drawn (small) portfolios."""
    token = sample_rank(seed, "portfolio", "order", F.lit(""), F.col(key).cast("string"))
    order = Window.partitionBy(F.lit(prefix)).orderBy("component", token, key)
    return chosen.withColumn("case_id", F.format_string(f"{prefix}-%03d", F.row_number().over(order)))


def review_complete(
    required: Sequence[str],
    results: Mapping[str, Sequence[str]],
    follow_ups: Mapping[str, tuple[Sequence[str], str]],
    applies: Mapping[str, Column],
    either: Sequence[str],
    status: str = "review_status",
    confirmed: str = "manual_evidence_confirmed",
) -> Column:
    """Is a review complete?

    Its status says so; all required fields are filled; each result is one of its allowed words;
    a result among some words has its follow-up field filled; a result is not_applicable exactly
    where its column says that it does not apply; a person has confirmed; and one of ``either``
    is filled.
    """
    filled = lambda c: F.coalesce(F.trim(F.col(c)) != "", F.lit(False))
    sure = lambda c: F.coalesce(c, F.lit(False))
    gates = [sure(F.col(status) == "complete"), *[filled(c) for c in required]]
    gates += [sure(F.col(c).isin(*words)) for c, words in results.items()]
    gates += [~sure(F.col(c).isin(*words)) | filled(more) for c, (words, more) in follow_ups.items()]
    gates += [sure((F.col(c) != "not_applicable") == here) for c, here in applies.items()]
    gates.append(sure(F.col(confirmed) == "yes"))
    gates.append(first_match([(filled(c), F.lit(True)) for c in either], F.lit(False)))
    out = gates[0]
    for g in gates[1:]:
        out = out & g
    return out


def claim_counts(rows: DataFrame, claims: Sequence[str], by: Sequence[str], methods: str | None = None) -> DataFrame:
    """Supported and contradicted results per claim (and by), with the Wilson interval; methods kept as a list count each."""
    from ledgerflow.functions.numbers import wilson

    out = rows.withColumn("method", F.explode(split_list(F.col(methods)))) if methods else rows
    groups = [*by, *(["method"] if methods else [])]
    long = out.select(*groups, F.posexplode(F.array(*[F.col(c) for c in claims])).alias("i", "result"))
    long = long.withColumn("claim", F.array(*[F.lit(c) for c in claims])[F.col("i")])
    n = long.groupBy("claim", *groups).agg(F.count_if(F.col("result") == "supported").alias("supported"), F.count_if(F.col("result").isin("supported", "contradicted")).alias("decided"))
    w = wilson(F.col("supported"), F.col("decided"))
    six = lambda c: F.round(c, 6)
    return n.select("claim", *groups, "supported", "decided", six(w["estimate"]).alias("precision"), six(w["lower"]).alias("lower"), six(w["upper"]).alias("upper"))


def plan_outcomes(plan: DataFrame, sources: Mapping[str, tuple[DataFrame, str]], file: str = "source_file", key: str = "sample_id") -> DataFrame:
    """The outcome of each planned case from the source it names: one join on (source, key).

    sources: by name, rows and their outcome column. A case without a row keeps a null outcome and
    found = false; a source that is not listed finds nothing.
    """
    tables = [rows.select(F.lit(name).alias(file), F.col(key), F.col(outcome).alias("outcome"), F.lit(True).alias("found")) for name, (rows, outcome) in sources.items()]
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    out = plan.join(every, [file, key], "left")
    return out.withColumn("found", F.coalesce("found", F.lit(False)))
