"""Audits of recorded runs: hash chains, budgets, repeatability, manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.ids import hash_id
from ledgerflow.sources.workspace import cut


def verify_chain(log: DataFrame, chain: str, sequence: str, content: Column, previous: str, own: str) -> DataFrame:
    """Per chain: rows, and how many break its sequence, the link to the row before, or their own hash.

    A row's hash is that of its sequence number, previous hash and content. A chain of any length is cut
    into segments by ranges of the sequence, and each is checked by itself; a row for each segment
    carries the number of rows before it and the last hash of the one before over to it. Rows without
    chain are one chain; of rows with one sequence number and of those without any, the order is that of their hashes.
    """
    right = F.col(own).eqNullSafe(chain_hash(F.col(sequence), F.col(previous), content))
    rows = log.select(F.col(chain).alias("chain"), F.col(sequence).alias("seq"), F.col(previous).alias("prev"), F.col(own).alias("own"), right.alias("right"))
    # written, so that segments stay the same however often they are read
    rows = cut(rows.repartitionByRange("chain", "seq", "own", "prev").withColumn("segment", F.spark_partition_id()), "chain")
    order = [F.col(c).asc_nulls_first() for c in ("seq", "own", "prev")]
    ends = rows.groupBy("segment", "chain").agg(F.count("*").alias("n"), F.min("seq").alias("least"), F.max(F.struct(F.col("seq").isNotNull(), "seq", F.col("own").isNotNull(), "own", "prev")).alias("last"))
    one = Window.partitionBy("chain").orderBy("segment")
    over = Window.partitionBy("chain")
    ends = ends.select("segment", "chain", F.min("least").over(over).alias("first"), F.lag("last.own").over(one).alias("carried"), F.coalesce(F.sum("n").over(one.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    within = Window.partitionBy("segment", "chain").orderBy(*order)
    rows = rows.withColumn("before", F.lag("own").over(within)).withColumn("place", F.row_number().over(within))
    ends = ends.withColumnsRenamed({"segment": "s", "chain": "c"})
    rows = rows.join(ends, (rows["segment"] == ends["s"]) & rows["chain"].eqNullSafe(ends["c"]))
    gap = F.col("seq") != F.col("first") + F.col("offset") + F.col("place") - 1
    before = F.when(F.col("place") == 1, F.col("carried")).otherwise(F.col("before"))
    link = ~F.coalesce("prev", F.lit("")).eqNullSafe(F.coalesce(before, F.lit("")))
    return rows.groupBy(F.col("chain").alias(chain)).agg(F.count("*").alias("rows"), F.count_if(gap).alias("gaps"), F.count_if(link).alias("broken_links"), F.count_if(~F.col("right")).alias("wrong_hashes"))


def chain_hash(sequence: Column, previous: Column, content: Column) -> Column:
    return hash_id(sequence.cast("string"), previous, content)


def foreign_tools(calls: DataFrame, run: str, tool: str, allowed: list[str]) -> DataFrame:
    """Calls per run of tools that are not on the list, and which; runs without any give no row."""
    odd = calls.where(~F.coalesce(F.col(tool).isin(*allowed), F.lit(False)))
    return odd.groupBy(run).agg(F.count("*").alias("foreign_calls"), F.array_join(F.array_sort(F.collect_set(F.coalesce(F.col(tool), F.lit("")))), ";").alias("tools"))


def budgets(calls: DataFrame, run: str, fingerprint: str, cost: str, most_calls: int, most_repeats: int, most_cost: float) -> DataFrame:
    """Calls, distinct queries, most repeats of one query and cost per run, and whether they keep to the budget."""
    per = calls.groupBy(run, fingerprint).agg(F.count("*").alias("n"), F.sum(cost).alias("c"))
    out = per.groupBy(run).agg(F.sum("n").alias("calls"), F.count("*").alias("queries"), F.max("n").alias("most_repeats"), F.sum("c").alias("cost"))
    ok = (F.col("calls") <= most_calls) & (F.col("most_repeats") <= most_repeats) & (F.col("cost") <= most_cost)
    return out.withColumn("within_budget", ok)


def usage_limits(calls: DataFrame, run: str, usage: Mapping[str, float], once: Sequence[str] = ()) -> DataFrame:
    """Per run the total of each kind of usage (tokens, money, seconds), and which exceed their limits.

    ``usage`` maps columns to limits; columns in ``once`` are stated for the run on each of its calls and not
    added up. A kind that no call of a run states is unknown (null) and exceeds nothing; what is no number counts as not stated.
    """
    value = lambda c: F.expr(f"try_cast(`{c}` as double)")
    known = lambda c: F.when(~F.isnan(value(c)), value(c))
    per = calls.groupBy(run).agg(F.count("*").alias("calls"), *[(F.max(known(c)) if c in once else F.sum(known(c))).alias(c) for c in usage])
    over = F.array_compact(F.array(*[F.when(F.col(c) > limit, F.lit(c)) for c, limit in usage.items()]))
    return per.withColumn("exceeded", F.array_join(over, ";")).withColumn("within_limits", F.size(over) == 0)


def repeatability(rows: DataFrame, case: str, repeat: str, values: list[str]) -> DataFrame:
    """Do all repeats of a case have the same set of values? Compared by hashes of their sorted distinct values."""
    per = rows.select(case, repeat, F.concat_ws("|", *values).alias("v")).distinct().groupBy(case, repeat).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("v")), "\n"), 256).alias("h"))
    return per.groupBy(case).agg(F.count("*").alias("repeats"), (F.countDistinct("h") == 1).alias("repeatable"))


def manifest_check(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """status of every listed or found file (path, sha256): ok, changed, missing or unlisted."""
    m, f = manifest.select("path", F.col("sha256").alias("listed")), files.select("path", F.col("sha256").alias("found"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("listed").isNull(), "unlisted").when(F.col("found") == F.col("listed"), "ok").otherwise("changed")
    return m.join(f, "path", "full_outer").select("path", status.alias("status"))


def run_metrics(runs: DataFrame, by: str, status: str, cost: str) -> DataFrame:
    """Runs, share that finished, and mean and total cost where all costs are known."""
    known = F.count(cost) == F.count("*")
    return runs.groupBy(by).agg(
        F.count("*").alias("runs"), F.round(F.count_if(F.col(status) == "done") / F.count("*"), 6).alias("done_rate"),
        F.round(F.avg(cost), 6).alias("mean_cost"), F.when(known, F.round(F.sum(cost), 6)).alias("total_cost"),
    )


def forbidden(rows: DataFrame, key: str, stored: str, keys: list[str], status: str, allowed: list[str]) -> DataFrame:
    """Rows whose JSON holds a forbidden key at any depth, or whose status is not allowed."""
    found = F.array_intersect(F.transform(F.regexp_extract_all(F.col(stored), F.lit(r'"([^"\\]+)"\s*:'), 1), lambda k: F.lower(k)), F.array(*[F.lit(k.lower()) for k in keys]))
    bad = ~F.coalesce(F.col(status).isin(*allowed), F.lit(False))
    return rows.select(key, F.array_join(F.array_sort(found), ";").alias("forbidden_keys"), bad.alias("bad_status")).where("forbidden_keys <> '' or bad_status")


def identity_rules(evidence: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Which rule (type, least_tier, needs_exact) each piece of evidence meets: accepted, or the reason why not."""
    out = evidence.join(F.broadcast(rules), "evidence_type", "left")  # the rules are a fixed table
    reason = (
        F.when(F.col("least_tier").isNull(), "no_rule").when(F.col("tier") > F.col("least_tier"), "tier_too_low").when(F.col("needs_exact") & ~F.col("exact"), "not_exact").otherwise("accepted")
    )
    return out.select(key, "evidence_type", reason.alias("result"))


def scoped_hashes(claims: DataFrame, files: DataFrame, fields: DataFrame) -> DataFrame:
    """Is a claimed hash that of the file (scope file) or of the extracted fields (scope fields) it names?"""
    f, x = files.select(F.col("path").alias("ref"), F.col("sha256").alias("file_hash")), fields.select("ref", F.col("sha256").alias("field_hash"))
    actual = F.when(F.col("scope") == "file", F.col("file_hash")).when(F.col("scope") == "fields", F.col("field_hash"))
    return claims.join(f, "ref", "left").join(x, "ref", "left").select("claim_id", "scope", F.coalesce(actual == F.col("claimed"), F.lit(False)).alias("verified"))
