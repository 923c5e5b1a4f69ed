"""Scans: text tables, feature collections, aliased exports, dated snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ledgerflow.functions.ids import fingerprint
from ledgerflow.functions.text import restore_csv_cell


def read_csv(spark: SparkSession, path: str, restore: bool = False) -> DataFrame:
    """A CSV file with a header, plain or gzipped: all text, blanks as nulls, a byte order mark dropped; with restore, apostrophes put before formulas are taken off."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', maxCharsPerColumn=-1, encoding="UTF-8")
    df = df.toDF(*[c.lstrip("\ufeff") for c in df.columns])
    value = lambda c: restore_csv_cell(F.col(f"`{c}`")) if restore else F.col(f"`{c}`")
    return df.select(*[F.nullif(value(c), F.lit("")).alias(c) for c in df.columns])


_FEATURES = "features array<struct<properties:map<string,string>,geometry:string>>"


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of GeoJSON collections: ordinal, properties (map of text), geometry (JSON text)."""
    rows = spark.read.schema(_FEATURES).json(path, multiLine=True)
    return rows.select(F.posexplode("features").alias("ordinal", "f")).select("ordinal", "f.properties", "f.geometry")


def feature_rows(texts: DataFrame, column: str = "value") -> DataFrame:
    """The same from collections that stand in a column of text, one per row."""
    parsed = F.from_json(column, f"struct<{_FEATURES.replace(' ', ':', 1)}>")
    return texts.select(F.posexplode(parsed["features"]).alias("ordinal", "f")).select("ordinal", "f.properties", "f.geometry")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """By name: .csv(.gz) as CSV, .jsonl/.ndjson as lines, .json as a list or an object with records or features."""
    name = path.lower().removesuffix(".gz")
    if name.endswith(".csv"):
        return read_csv(spark, path)
    if name.endswith((".jsonl", ".ndjson")):
        return spark.read.json(path)
    if name.endswith(".json"):
        df = spark.read.json(path, multiLine=True)
        for inner in ("records", "features"):
            if isinstance(df.schema[inner].dataType if inner in df.columns else None, ArrayType):
                return df.select(F.explode(inner).alias("r")).select("r.*")
        return df
    raise ValueError(f"no reader for {path}")


def with_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]], required: Sequence[str]) -> DataFrame:
    """Canonical columns, each from the first of its aliases that is there (in any case), else null.

    A required column without any alias is an error.
    """
    here = {c.lower().strip(): c for c in reversed(df.columns)}

    def pick(target: str) -> Column:
        for a in (target, *aliases[target]):
            if a.lower() in here:
                return F.col(f"`{here[a.lower()]}`")
        if target in required:
            raise ValueError(f"no column for {target} among {df.columns}")
        return F.lit(None).cast("string")

    return df.select(*[pick(t).alias(t) for t in aliases])


def strict_load(df: DataFrame, columns: Sequence[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, populated rows without one). Missing columns are an error; blank rows are dropped."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    filled = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    some = filled(columns[0])
    for c in columns[1:]:
        some = some | filled(c)
    populated = df.select(*columns).where(some)
    return populated.where(filled(key)), populated.where(~filled(key))


def catalog(snapshots: DataFrame, date: str = "snapshot_date", retrieved: str = "retrieved_at") -> DataFrame:
    """One row per dated partition: rows, retrieval time, and whether all rows agree on it and on the label."""
    return snapshots.groupBy(date).agg(
        F.count("*").alias("rows"), F.max(retrieved).alias("retrieved"),
        ((F.countDistinct(retrieved) == 1) & (F.max(F.substring(F.col(retrieved).cast("string"), 1, 10)) == F.first(F.col(date).cast("string")))).alias("consistent"),
    )


def load_observations(archive: DataFrame, current: DataFrame, date: str = "snapshot_date", ignore: Sequence[str] = ()) -> DataFrame:
    """All snapshots, with the current table if its date is new; a different state of a known date is an error."""
    days = [r[0] for r in current.select(date).distinct().limit(2).collect()]
    if len(days) != 1:
        raise ValueError("the current table must have one snapshot date")
    same_day = archive.where(F.col(date) == F.lit(days[0]))
    if same_day.isEmpty():
        return archive.unionByName(current)
    if fingerprint(same_day, *ignore).first() != fingerprint(current, *ignore).first():
        raise ValueError(f"{days[0]} is archived with other contents")
    return archive


def change_universe(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All comparison tables of an index, as one."""
    return spark.read.parquet(*paths)
