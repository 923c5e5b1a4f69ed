"""Deterministic identifiers and hashes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import token


def _joined(parts: tuple[Column, ...]) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def short_id(prefix: str, *parts: Column, digits: int = 16) -> Column:
    """prefix-<first hex digits of the SHA-1 of the parts, joined by |>; null parts count as blank."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha1(F.encode(_joined(parts), "utf-8")), 1, digits))


def hash_id(*parts: Column) -> Column:
    return F.sha2(F.encode(_joined(parts), "utf-8"), 256)


def record_id(parts: list[Column], public_number: Column) -> Column:
    """From the composite parts if all are there, else from the public number, else null."""
    whole = F.lit(True)
    for p in parts:
        whole = whole & p.isNotNull()
    return F.when(whole, hash_id(F.lit("parts"), *parts)).when(token(public_number).isNotNull(), hash_id(F.lit("number"), token(public_number)))


def child_id(parent: Column, own: Column, *fallback: Column) -> Column:
    """An id within its parent: by the own id, else by the fallback values."""
    return F.when(own.isNotNull(), hash_id(F.lit("own"), parent, own)).otherwise(hash_id(F.lit("content"), parent, *fallback))


def sample_rank(seed: int, study: str, purpose: str, stratum: Column, key: Column) -> Column:
    """The token whose order draws a sample."""
    return hash_id(F.lit(str(seed)), F.lit(study), F.lit(purpose), stratum, key)


def map_hash(m: Column) -> Column:
    """SHA-256 of a map as JSON with sorted keys."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(m)))
    return F.sha2(F.encode(F.to_json(ordered), "utf-8"), 256)


def fingerprint(df: DataFrame, *ignore: str) -> DataFrame:
    """rows, xor and sum of row hashes: equal for equal contents in any order of rows and columns."""
    names = sorted(c for c in df.columns if c not in ignore)
    row = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in names]), {"ignoreNullFields": "false"})
    part = F.conv(F.substring(F.sha1(F.encode(row, "utf-8")), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.select(F.xxhash64(row).alias("h"), part.alias("p")).agg(
        F.count("*").alias("rows"), F.coalesce(F.bit_xor("h"), F.lit(0)).alias("xor_hash"), F.coalesce(F.sum("p"), F.lit(0)).alias("sum_hash")
    )
