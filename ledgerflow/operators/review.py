"""Estimates from reviewed samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import wilson


def _interval(successes: str, total: str) -> list[Column]:
    w = wilson(F.col(successes), F.col(total))
    return [F.round(w[f], 6).alias(f) for f in ("estimate", "lower", "upper")]


def precision(reviews: DataFrame, by: list[str], correct: Column) -> DataFrame:
    """Reviewed, correct and the Wilson interval per group; nulls of ``correct`` are not reviewed."""
    counted = reviews.groupBy(*by).agg(F.count(correct).alias("reviewed"), F.count_if(correct).alias("correct"))
    return counted.select(*by, "reviewed", "correct", *_interval("correct", "reviewed"))


def weighted_precision(reviews: DataFrame, by: list[str], correct: Column, weight: str) -> DataFrame:
    """Design-weighted precision with Kish's effective number of reviews."""
    w = F.when(correct.isNotNull(), F.col(weight))
    return reviews.groupBy(*by).agg(
        F.round(F.sum(F.when(correct, w).otherwise(0.0)) / F.sum(w), 6).alias("weighted_precision"),
        F.round(F.pow(F.sum(w), 2) / F.sum(w * w), 6).alias("effective_n"),
    )


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Number of pairs, agreement and Cohen's kappa; null kappa where chance agrees always. Pairs with a null are left out."""
    both = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
    cells = both.groupBy("a", "b").agg(F.count("*").alias("n"))
    total = cells.agg(F.sum("n").alias("pairs"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("agree"))
    rows, columns = cells.groupBy("a").agg(F.sum("n").alias("na")), cells.groupBy("b").agg(F.sum("n").alias("nb"))
    chance = rows.join(columns, F.col("a") == F.col("b")).agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("cross"))
    out = total.join(F.broadcast(chance))  # one row each
    observed, expected = F.col("agree") / F.col("pairs"), F.col("cross") / (F.col("pairs") * F.col("pairs"))
    return out.select("pairs", F.round(observed, 6).alias("agreement"), F.round(F.when(expected < 1, (observed - expected) / (1 - expected)), 6).alias("kappa"))


def confusion(pairs: DataFrame, predicted: str, reviewed: str) -> DataFrame:
    return pairs.groupBy(F.col(predicted).alias("predicted"), F.col(reviewed).alias("reviewed")).agg(F.count("*").alias("n"))


def recall(truth: DataFrame, found: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Share of the true rows that were found, per group."""
    hits = found.select(key).distinct().withColumn("hit", F.lit(True))
    out = truth.join(hits, key, "left").groupBy(*by).agg(F.count("*").alias("total"), F.count_if(F.coalesce("hit", F.lit(False))).alias("found"))
    return out.select(*by, "total", "found", *_interval("found", "total"))


def proportions(rows: DataFrame, category: str, vocabulary: list[str]) -> DataFrame:
    """Share and interval of every word of a fixed vocabulary, also of those that do not occur."""
    spine = rows.sparkSession.createDataFrame([(v,) for v in vocabulary], f"{category} string")
    counted = rows.groupBy(category).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    out = spine.join(counted, category, "left").join(F.broadcast(total)).select(category, F.coalesce("n", F.lit(0)).alias("n"), "total")
    return out.select(category, "n", "total", *_interval("n", "total"))


def coverage(samples: DataFrame, reviews: DataFrame, key: str, by: str) -> DataFrame:
    """Assigned and reviewed rows per study; precision stays null where nothing was reviewed."""
    out = samples.join(reviews.select(key, F.lit(True).alias("done")).distinct(), key, "left").groupBy(by).agg(F.count("*").alias("assigned"), F.count("done").alias("reviewed"))
    share = F.when(F.col("reviewed") > 0, F.round(F.col("reviewed") / F.col("assigned"), 6))
    return out.select(by, "assigned", "reviewed", share.alias("coverage"), (F.col("reviewed") == F.col("assigned")).alias("complete"))


def pooled_weights(samples: DataFrame, universe: DataFrame, stratum: str) -> DataFrame:
    """Weights recomputed for samples of several phases taken together: stratum size over rows drawn."""
    n = samples.groupBy(stratum).agg(F.count("*").alias("drawn"))
    return universe.groupBy(stratum).agg(F.count("*").alias("population")).join(n, stratum).withColumn("weight", F.round(F.col("population") / F.col("drawn"), 12))
