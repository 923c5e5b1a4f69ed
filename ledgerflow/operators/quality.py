"""Data-quality checks. Each returns rows of a common form: check, passed, faults (and what is asked for besides)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_of
from ledgerflow.functions.ids import fingerprint


def _check(name: str, faults: DataFrame) -> DataFrame:
    return faults.agg(F.count("*").alias("faults")).select(F.lit(name).alias("check"), (F.col("faults") == 0).alias("passed"), "faults")


def together(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def unique(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Keys that repeat or are blank."""
    blank = reduce(lambda a, b: a | b, [F.coalesce(F.trim(F.col(k).cast("string")) == "", F.lit(True)) for k in key])
    return _check(name, df.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | blank))


def foreign_key(df: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Values of a key, not null, without a parent row."""
    return _check(name, df.where(F.col(key).isNotNull()).join(parent, df[key] == parent[parent_key], "left_anti"))


def rule(df: DataFrame, holds: Column, name: str) -> DataFrame:
    """Rows for which a condition is not true."""
    return _check(name, df.where(~F.coalesce(holds, F.lit(False))))


def rules(df: DataFrame, holds: Mapping[str, Column]) -> DataFrame:
    """Several rules on the rows of one table, counted in one pass over it: a check for each name."""
    return listed(df.agg(*[fails(h).alias(name) for name, h in holds.items()]), list(holds))


def fails(holds: Column) -> Column:
    """How many rows a condition is not true for."""
    return F.count_if(~F.coalesce(holds, F.lit(False)))


def listed(faults: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of counted faults as a check for each name."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("faults")) for name in names])).alias("c")
    return faults.select(each).select("c.check", (F.col("c.faults") == 0).alias("passed"), "c.faults")


def words_hold(column: str, words: Sequence[str]) -> Column:
    return F.col(column).isin(*words)


def range_holds(column: str, low: float, high: float) -> Column:
    c = F.col(column).cast("double")
    return c.between(low, high) & ~F.isnan(c)


def vocabulary(df: DataFrame, column: str, words: Sequence[str], name: str) -> DataFrame:
    return rule(df, words_hold(column, words), name)


def in_range(df: DataFrame, column: str, low: float, high: float, name: str) -> DataFrame:
    return rule(df, range_holds(column, low, high), name)


def added_removed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with side added or removed."""
    new = after.select(key).distinct().join(before, key, "left_anti").select(key, F.lit("added").alias("side"))
    gone = before.select(key).distinct().join(after, key, "left_anti").select(key, F.lit("removed").alias("side"))
    return new.unionByName(gone)


def same_keys(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    return _check(name, added_removed(a, b, key))


def subset(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    return _check(name, a.select(key).distinct().join(b, key, "left_anti"))


def disjoint(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    return _check(name, a.select(key).distinct().join(b, key, "left_semi"))


def partition(parts: Sequence[DataFrame], whole: DataFrame, key: str, name: str) -> DataFrame:
    """Do the parts hold every key of the whole exactly once and no other?"""
    tagged = reduce(DataFrame.unionByName, [p.select(key).withColumn("part", F.lit(i)) for i, p in enumerate(parts)])
    counts = tagged.groupBy(key).agg(F.count("*").alias("n"))
    wrong = whole.select(key).distinct().withColumn("in", F.lit(True)).join(counts, key, "full_outer")
    return _check(name, wrong.where("n is null or n <> 1 or `in` is null"))


def copy_fidelity(raw: DataFrame, copy: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Compared and differing rows per column (nulls equal nulls)."""
    a = raw.select(key, *[F.col(c).cast("string").alias(f"a_{c}") for c in columns])
    b = copy.select(key, *[F.col(c).cast("string").alias(f"b_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")).alias("same")) for c in columns])
    return a.join(b, key).select(F.explode(pairs).alias("p")).groupBy("p.field").agg(F.count("*").alias("compared"), F.count_if(~F.col("p.same")).alias("differing"))


def reconcile_counts(declared: DataFrame, actual: DataFrame, on: str) -> DataFrame:
    """declared (on, expected) against the rows of actual per group."""
    n = actual.groupBy(on).agg(F.count("*").alias("actual"))
    out = declared.join(n, on, "full_outer")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    out = out.select(on, zero("expected"), zero("actual"))
    return out.withColumn("passed", F.col("expected") == F.col("actual"))


def collection(declared: DataFrame, inventory: DataFrame, fetched: DataFrame, source: str, key: str) -> DataFrame:
    """Per source: declared count, listed ids, fetched ids, and what does not fit together.

    A collection passes if the counts are equal and no id is missing, foreign, blank or repeated.
    """
    listed = inventory.select(source, key).distinct().withColumn("listed", F.lit(1))
    got = fetched.groupBy(source, key).agg(F.count("*").alias("copies"))
    both = listed.join(got, [source, key], "full_outer")
    per = both.groupBy(source).agg(
        F.count("listed").alias("inventory"), F.coalesce(F.sum("copies"), F.lit(0)).alias("fetched"),
        F.count_if(F.col("copies").isNull()).alias("missing"), F.count_if(F.col("listed").isNull()).alias("foreign"), F.count_if(F.col("copies") > 1).alias("repeated"),
    )
    out = declared.join(per, source, "left")
    ok = (F.col("expected") == F.col("inventory")) & (F.col("inventory") == F.col("fetched")) & (F.col("missing") + F.col("foreign") + F.col("repeated") == 0)
    return out.withColumn("passed", F.coalesce(ok, F.lit(False)))


def same_contents(a: DataFrame, b: DataFrame, *ignore: str) -> DataFrame:
    """Equal fingerprints: the same rows in any order, without the ignored columns."""
    x, y = fingerprint(a, *ignore), fingerprint(b, *ignore)
    both = x.toDF("a_rows", "a_xor", "a_sum").join(F.broadcast(y.toDF("b_rows", "b_xor", "b_sum")))  # one row each
    same = (F.col("a_rows") == F.col("b_rows")) & (F.col("a_xor") == F.col("b_xor")) & (F.col("a_sum") == F.col("b_sum"))
    return both.select(F.col("a_rows").alias("rows_a"), F.col("b_rows").alias("rows_b"), same.alias("equal"))


def partition_gaps(rows: DataFrame, day: Column, group: str, first: str, last: str) -> DataFrame:
    """Months of a declared window that a group has no row in, and rows outside the window."""
    spark = rows.sparkSession
    months = spark.sql(f"select explode(sequence(date'{first}', date'{last}', interval 1 month)) as d").select(month_of(F.col("d")).alias("month"))
    dated = rows.select(F.col(group).alias("g"), month_of(day).alias("month"), day.between(F.lit(first).cast("date"), F.last_day(F.lit(last).cast("date"))).alias("inside"))
    have = dated.where("inside").groupBy("g", "month").agg(F.count("*").alias("n"))
    # months of the window for each group; both are small
    spine = dated.select("g").distinct().join(F.broadcast(months))
    gaps = spine.join(have, ["g", "month"], "left_anti").groupBy("g").agg(F.count("*").alias("missing_months"))
    outside = dated.groupBy("g").agg(F.count_if(~F.coalesce("inside", F.lit(False))).alias("outside"), F.count("*").alias("rows"))
    return outside.join(gaps, "g", "left").select(F.col("g").alias(group), "rows", "outside", F.coalesce("missing_months", F.lit(0)).alias("missing_months"))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled and blank values per column, in one pass."""
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(~blank(c)).alias(c) for c in columns])
    long = one.unpivot(["rows"], list(columns), "column", "populated")
    return long.select("column", "populated", (F.col("rows") - F.col("populated")).alias("blank"), F.round(100 * F.col("populated") / F.nullif(F.col("rows"), F.lit(0)), 1).alias("percent"))


def suppress_small(counts: DataFrame, n: str = "n", least: int = 5) -> DataFrame:
    """Groups of at least ``least``; smaller ones become one row of null keys with their number as suppressed_groups."""
    keys = [c for c in counts.columns if c != n]
    kept = counts.where(F.col(n) >= least).withColumn("suppressed_groups", F.lit(0).cast("long"))
    few = counts.where(F.col(n) < least).agg(F.count("*").alias("suppressed_groups"))
    few = few.select(*[F.lit(None).cast(counts.schema[c].dataType).alias(c) for c in keys], F.lit(None).cast("long").alias(n), "suppressed_groups")
    return kept.unionByName(few)


def sample_design(sample: DataFrame, stratum: str, tolerance: float = 1e-9) -> DataFrame:
    """Do probability, weight, quota and population of drawn rows fit together?"""
    n = sample.groupBy(stratum).agg(F.count("*").alias("drawn"), F.min("quota").alias("quota"), F.min("population").alias("population"), F.min("probability").alias("p"), F.min("weight").alias("w"))
    ok = (F.col("drawn") == F.col("quota")) & (F.abs(F.col("p") - F.col("quota") / F.col("population")) < tolerance) & (F.abs(F.col("w") - F.col("population") / F.col("quota")) < tolerance)
    return n.select(stratum, "drawn", "population", ok.alias("passed"))


def summary(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Named aggregates in long format, from one pass."""
    one = df.agg(*[c.cast("double").alias(n) for n, c in measures.items()])
    return one.unpivot([], list(measures), "metric", "value")


#: Grades on which a claim of completion may rest, and grades that a derived claim may have.
COMPLETION_GRADES, DERIVED_GRADES = ("A1", "A2", "A3", "B1", "B2"), ("C", "D", "P", "X", "U")
#: Events that only an official record of them may claim.
CLOSING_EVENTS = ("final_inspection_passed", "temporary_co_issued", "certificate_of_occupancy_issued", "construction_completion_reported")


def claim_rules(truth: DataFrame, completed: str, grade: str) -> DataFrame:
    """Completion is claimed with a qualifying grade only, and no derived claim has such a grade."""
    graded = (F.coalesce(F.col(completed), F.lit("")) != "yes") | F.col(grade).isin(*COMPLETION_GRADES)
    return rules(truth, {"no_completion_without_grade": graded, "derived_grades_only": words_hold(grade, DERIVED_GRADES)})


def proposal_rules(pairs: DataFrame, merged: str, status: str, pending: str) -> DataFrame:
    """Candidate pairs are proposals: none is merged and all wait for a reviewer."""
    return rule(pairs, ~F.coalesce(F.col(merged), F.lit(True)) & (F.col(status) == pending), "proposals_never_merged")


def event_rules(events: DataFrame, kind: str, forbidden: Sequence[str] = CLOSING_EVENTS) -> DataFrame:
    """No event of a kind that this data cannot show."""
    return rule(events, F.col(kind).isNotNull() & ~F.col(kind).isin(*forbidden), "no_forbidden_events")
