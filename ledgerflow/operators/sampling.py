"""Reproducible stratified samples by hash rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.ids import fingerprint, sample_rank


#: Strata of a sample, at most: their counts and quotas pass through the driver.
MOST_STRATA = 100_000


def _by_name(stratum: str | None) -> tuple[bool, str]:
    """Order of strata: the one of rows without a stratum first."""
    return stratum is not None, stratum or ""


def allocate(populations: dict[str | None, int], target: int, least: int = 0) -> dict[str | None, int]:
    """Whole quotas that add up to target: at least ``least`` (or all) of each stratum, the rest in proportion to size, never beyond it.

    Largest remainders, ties by name, null first. Only the counts of strata come to the driver.
    """
    sizes = {k: n for k, n in sorted(populations.items(), key=lambda kn: _by_name(kn[0])) if n > 0}
    if not 0 < target <= sum(sizes.values()):
        raise ValueError("target must be between 1 and the number of rows")
    quota = {k: min(least, n) for k, n in sizes.items()}
    if sum(quota.values()) > target:
        raise ValueError("target is too small for the least number per stratum")
    while (rest := target - sum(quota.values())) > 0:
        open_ = {k: n for k, n in sizes.items() if quota[k] < n}
        share = {k: rest * n / sum(open_.values()) for k, n in open_.items()}
        more = {k: min(sizes[k] - quota[k], int(s)) for k, s in share.items()}
        if not any(more.values()):
            for k in sorted(open_, key=lambda k: (int(share[k]) - share[k], _by_name(k)))[:rest]:
                more[k] = 1
        quota = {k: q + more.get(k, 0) for k, q in quota.items()}
    return quota


#: Parts in which a stratum is ranked first.
SALTS = 64


def stratified(df: DataFrame, key: str, stratum: str, quotas: dict[str | None, int], seed: int, study: str, purpose: str = "primary") -> DataFrame:
    """The rows of each stratum with the smallest rank tokens, as many as its quota, with design columns.

    Adds rank, population, quota, probability and weight. A stratum is ranked in SALTS parts first, each of
    which keeps as many rows as the quota, so no task sorts a whole stratum. Rows without a stratum are a stratum
    of their own, under the name null; strata without a quota are not drawn from.
    """
    if len(quotas) > MOST_STRATA:
        raise ValueError(f"{len(quotas)} strata are more than {MOST_STRATA}")
    spark = df.sparkSession
    plan = spark.createDataFrame(list(quotas.items()), "_stratum string, quota long")  # a row per stratum
    tokens = df.withColumn("token", sample_rank(seed, study, purpose, F.col(stratum), F.col(key).cast("string")))
    ranked = tokens.join(F.broadcast(plan), F.col(stratum).eqNullSafe(F.col("_stratum"))).drop("_stratum")
    ranked = ranked.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    for by in ((stratum, "_salt"), (stratum,)):
        order = Window.partitionBy(*by).orderBy("token", key)
        ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max(quotas.values(), default=0)).where("rank <= quota")
    drawn = ranked.drop("_salt")
    sizes = df.groupBy(F.col(stratum).alias("_stratum")).agg(F.count("*").alias("population"))
    met = drawn.join(F.broadcast(sizes), F.col(stratum).eqNullSafe(F.col("_stratum"))).drop("_stratum")  # MOST_STRATA rows at most
    out = met.withColumn("probability", F.round(F.col("quota") / F.col("population"), 12))
    return out.withColumn("weight", F.round(F.col("population") / F.col("quota"), 12)).drop("token")


def stratum_sizes(df: DataFrame, stratum: str) -> dict[str | None, int]:
    """Rows of each stratum, null being one; an error beyond MOST_STRATA."""
    rows = df.groupBy(F.col(stratum).alias("s")).agg(F.count("*").alias("n")).limit(MOST_STRATA + 1).collect()
    if len(rows) > MOST_STRATA:
        raise ValueError(f"{stratum} has more than {MOST_STRATA} strata")
    return {r["s"]: r["n"] for r in rows}


def two_phase(df: DataFrame, key: str, stratum: str, first: int, second: int, seed: int, study: str) -> DataFrame:
    """A development draw and a holdout draw that share no row, with a phase column."""
    a = stratified(df, key, stratum, allocate(stratum_sizes(df, stratum), first), seed, study, "development")
    rest = df.join(a.select(key), key, "left_anti")
    b = stratified(rest, key, stratum, allocate(stratum_sizes(rest, stratum), second), seed, study, "holdout")
    return a.withColumn("phase", F.lit("development")).unionByName(b.withColumn("phase", F.lit("holdout")))


def matched_categories(categories: dict[str, Column]) -> Column:
    """The names of all categories that a row belongs to, in their order; an unknown condition is no match."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in categories.items()]))


def by_category(df: DataFrame, key: str, categories: dict[str, Column], quota: int | dict[str, int], seed: int, study: str) -> DataFrame:
    """Rows drawn category by category in order, each row once: it counts for the first category that draws it.

    A quota for each category, or one for all; a category with fewer rows left gives all of them.
    """
    left, out = df, None
    for name, condition in categories.items():
        pool = left.where(condition).withColumn("category", F.lit(name))
        token = sample_rank(seed, study, name, F.lit(name), F.col(key).cast("string"))
        drawn = pool.withColumn("token", token).orderBy("token", key).limit(quota if isinstance(quota, int) else quota[name]).drop("token")
        out = drawn if out is None else out.unionByName(drawn)
        left = left.join(drawn.select(key), key, "left_anti")
    return out


def numbered(sample: DataFrame, prefix: str, *order: str) -> DataFrame:
    """Sequential ids of a drawn (small) sample."""
    return sample.withColumn("sample_id", F.format_string(f"{prefix}-%04d", F.row_number().over(Window.partitionBy(F.lit(prefix)).orderBy(*order))))


def universe_fingerprint(df: DataFrame, key: str, stratum: str) -> DataFrame:
    return fingerprint(df.select(key, stratum))
