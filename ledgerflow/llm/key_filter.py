"""Which keys may be among a given set: a bitmap, built and tested by Spark.

The bitmap is sized by the number of keys, counted beforehand, and is what gets broadcast: 1 MB at
least, ``MOST_BITS`` bits (16 MB) at most. A set bit may be there by chance, a bit that is not set is proof of
absence. Where that is not enough, the rows meet the keys in a shuffled join instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import written

LEAST_BITS, MOST_BITS = 1 << 23, 1 << 27
_BUCKET = 32768  # bits of one bitmap of bitmap_construct_agg


@dataclass
class KeyFilter:
    """table: bucket and bits, or, without a number of bits, the hashes of all keys as ``_key``."""

    bits: int | None
    table: DataFrame


def key_filter(shared: DataFrame, *keys: Column) -> KeyFilter:
    hashes = written(shared.select(F.xxhash64(*keys).alias("_key")).distinct())
    n = hashes.count()
    if 8 * n > MOST_BITS:
        return KeyFilter(None, hashes)
    bits = LEAST_BITS
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    slot = F.pmod("_key", F.lit(bits))
    table = hashes.select(slot.alias("slot")).groupBy((F.col("slot") / _BUCKET).cast("int").alias("bucket"))
    return KeyFilter(bits, table.agg(F.bitmap_construct_agg(F.col("slot") % _BUCKET).alias("bits")))


def marked(rows: DataFrame, shared: KeyFilter, *keys: Column, name: str) -> DataFrame:
    """rows with a boolean column: may the keys be among those of the filter?"""
    out = rows.withColumn("_key", F.xxhash64(*keys))
    if shared.bits is None:
        known = shared.table.withColumn(name, F.lit(True))
        return out.join(known, "_key", "left").withColumn(name, F.coalesce(name, F.lit(False))).drop("_key")
    out = out.withColumn("slot", F.pmod("_key", F.lit(shared.bits))).withColumn("bucket", (F.col("slot") / _BUCKET).cast("int"))
    out = out.join(F.broadcast(shared.table), "bucket", "left")
    at = (F.col("slot") % _BUCKET).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return out.withColumn(name, F.coalesce(bit, F.lit(False))).drop("_key", "slot", "bucket", "bits")
