"""Which records of two observations are the same record?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.text import canonical
from ledgerflow.operators.spread import dealt

#: Texts that stand for a missing identifier.
PLACEHOLDERS = ("", "N/A", "NA", "NONE", "NULL", "UNKNOWN", "0000000", "0", "-")


def is_placeholder(native: Column) -> Column:
    c = F.coalesce(canonical(native), F.lit(""))
    return c.isin(*PLACEHOLDERS) | c.rlike(r"^OBJECTID-\d+$")


def base_identity(source: Column, native: Column, global_id: Column, object_id: Column) -> Column:
    """SOURCE|NATIVE|id, or by GLOBALID or OBJECTID where the native id is a placeholder; null if there is none."""
    named = lambda kind, c: F.concat(F.lit(f"|{kind}|"), c)
    own = F.when(~is_placeholder(native), named("NATIVE", canonical(native)))
    return F.concat(canonical(source), F.coalesce(own, named("GLOBALID", canonical(global_id)), named("OBJECTID", canonical(object_id))))


def with_identity(snapshots: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Adds base_identity and record_identity.

    A base that any compared snapshot holds twice is told apart by GlobalID or OBJECTID in all of
    them, so that ids do not flip between observations. One shuffle, by the base, into parts of a bounded
    number of rows, as what follows (the pairing of a diff, too) sorts each part.
    """
    out = snapshots.withColumn("base_identity", base_identity(F.col("source_name"), F.col("native_id"), F.col("global_id"), F.col("object_id")))
    out = dealt(out, "base_identity", count=snapshots)
    by = Window.partitionBy("base_identity")
    twice = F.count("*").over(by) > F.size(F.collect_set(date).over(by))
    suffix = F.coalesce(
        F.concat(F.lit("|GLOBALID|"), canonical(F.col("global_id"))), F.concat(F.lit("|OBJECTID|"), canonical(F.col("object_id")))
    )
    return out.withColumn("record_identity", F.when(twice, F.concat("base_identity", suffix)).otherwise(F.col("base_identity")))


def identity_faults(identified: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Identities that a snapshot still holds more than once, and rows without any."""
    counts = identified.groupBy(date, "record_identity").agg(F.count("*").alias("n"))
    return counts.where("n > 1 or record_identity is null")
