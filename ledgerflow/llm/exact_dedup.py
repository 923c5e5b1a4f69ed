"""Exact copies by progressive refinement: length, then prefix hash, then full hash.

Each step keeps only the keys that at least two rows share. The shared keys of a step go
to the next one as a bitmap sized by their number (see key_filter), which is the only thing of
them that is broadcast: a row whose bit is not set cannot have a copy, and its content is not
looked at any further. A bit that is set by chance costs work, never a wrong result, because
groups are formed by the full hash in the end. Only keys and hashes are shuffled. Rows of one
large group meet their group's row in several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.key_filter import key_filter, marked
from ledgerflow.llm.shared import written
from ledgerflow.operators.spread import frequent, spread_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """Null as empty, A-Z in lower case, all else as it is."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _candidates(base: DataFrame) -> DataFrame:
    """base (id, text and more) with by_prefix: do other rows share its length and prefix hash?"""
    base = base.withColumn("size", F.octet_length(F.coalesce(F.col("text"), F.lit(""))))
    prefix = F.xxhash64(normalised(F.substring(F.col("text"), 1, PREFIX_CHARS)))
    lengths = base.groupBy("size").agg(F.count("*").alias("n")).where("n > 1")
    same_length = marked(base, key_filter(lengths, F.col("size")), F.col("size"), name="by_length")
    same_length = same_length.withColumn("prefix", F.when(F.col("by_length"), prefix))
    prefixes = same_length.where("by_length").groupBy("size", "prefix").agg(F.count("*").alias("n")).where("n > 1")
    keys = (F.col("size"), F.col("prefix"))
    return marked(same_length, key_filter(prefixes, *keys), *keys, name="by_prefix")


def _content(text: Column) -> Column:
    return F.sha2(F.encode(normalised(text), "utf-8"), 256)


def _groups(hashed: DataFrame) -> DataFrame:
    """content_sha256, keep_id and group_size of the groups of two rows or more, as a table of its own."""
    groups = hashed.groupBy("content_sha256").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    return written(groups.where("group_size > 1"))


def _large(groups: DataFrame) -> DataFrame | None:
    return frequent(groups, "content_sha256", counts=groups.select("content_sha256", F.col("group_size").alias("n")))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, content_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty.
    keep_id is the largest id of the group; kept marks the rows that carry it, so rows that
    repeat both id and text are all marked. A null id is smaller than any other and is kept
    only if the whole group has null ids. content_sha256 is the hash of the normalised text;
    without ``digest`` it is null where no copy was possible and the content was not hashed.
    Other columns of docs play no part. An empty table gives an empty result.
    """
    rows = _candidates(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")))
    sha = _content(F.col("text"))
    rows = written(rows.select("id", "by_prefix", (sha if digest else F.when(F.col("by_prefix"), sha)).alias("content_sha256")))
    hashed = rows.where("by_prefix").select("id", "content_sha256")
    groups = _groups(hashed)
    met = spread_join(hashed, groups, ["content_sha256"], [F.col("id")], "left", _large(groups))
    alone = rows.where(~F.col("by_prefix")).select("id", "content_sha256", F.lit(None).cast(hashed.schema["id"].dataType).alias("keep_id"), F.lit(None).cast("long").alias("group_size"))
    joined = met.unionByName(alone)
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        "content_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that another copy stands for; columns as they are.

    Of a group of equal texts the row with the largest id stays; where rows repeat the same
    id and text, each of them stays. Only rows that may have a copy are shuffled.
    """
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = _candidates(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), whole.alias("row")))
    hashed = rows.select("id", "row", F.when(F.col("by_prefix"), _content(F.col("text"))).alias("content_sha256"))
    groups = _groups(hashed.where("content_sha256 is not null"))
    found = marked(hashed, key_filter(groups, F.col("content_sha256")), F.col("content_sha256"), name="copied")
    copied = F.col("copied") & F.col("content_sha256").isNotNull()
    met = spread_join(found.where(copied), groups, ["content_sha256"], [F.col("id")], "left", _large(groups))
    stay = met.where(F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).select("row")
    alone = found.where(~copied).select("row")
    return alone.unionByName(stay).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
