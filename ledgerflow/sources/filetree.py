"""Manifests of files of any size by hash trees.

A file is read in ranges of a fixed size, each by itself in whatever task; a range's hash is a leaf.
Up to ``fan`` neighbouring hashes make one of the next level, until one is left: the file's root. Files are
joined to one root by the digits of their paths' hashes. No task sees more than a range or ``fan``
hashes, and all roots depend on the bytes and paths alone, not on tasks, partitions or the order of files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range, and hashes joined to one.
RANGE, FAN = 8 << 20, 1024


def ranges(spark: SparkSession, path: str, pattern: str = "*", size: int = RANGE) -> DataFrame:
    """path, bytes, part, start and length of the ranges of all files under a path; empty files, which Spark does not list, have none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    parts = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("length") / size) - 1)
    each = files.select("path", F.col("length").alias("bytes"), F.explode(parts).alias("part"))
    start = F.col("part") * size
    return each.select("path", "bytes", "part", start.alias("start"), F.least(F.lit(size), F.col("bytes") - start).alias("length"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = []
        for path, start, length in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "length")], strict=True):
            store, inner = FileSystem.from_uri(path)
            with store.open_input_file(inner) as f:
                data = f.read_at(length, start)
            if len(data) != length:
                raise OSError(f"{path}: {len(data)} bytes at {start} where {length} were listed")
            hashes.append(hashlib.sha256(b"\0" + data).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("path", "bytes", "part")] + [pa.array(hashes, pa.string())], names=["path", "bytes", "part", "sha256"])


def hashed_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, bytes and sha256 of listed files (path and bytes), read block by block."""
    for batch in batches:
        hashes = []
        for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
            store, inner = FileSystem.from_uri(path)
            digest, seen = hashlib.sha256(), 0
            with store.open_input_stream(inner) as f:
                while block := f.read(RANGE):
                    digest.update(block)
                    seen += len(block)
            if seen != size:
                raise OSError(f"{path}: {seen} bytes where {size} were listed")
            hashes.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("bytes"), pa.array(hashes, pa.string())], names=["path", "bytes", "sha256"])


def range_hashes(spark: SparkSession, path: str, pattern: str = "*", size: int = RANGE) -> DataFrame:
    """path, bytes, part and sha256 of each range: of a zero byte and the range's bytes.

    The ranges of one file are dealt over all tasks. Paths are those of a store that pyarrow can open
    (local, shared, HDFS, S3, GCS); a file that shrinks while it is read is an error.
    """
    listed = ranges(spark, path, pattern, size)
    return listed.repartition(F.col("path"), F.col("part")).mapInArrow(_read, "path string, bytes long, part long, sha256 string")


def joined_hash(hashes: Column) -> Column:
    """The hash over hashes (hex digits in order): of a one byte and their bytes."""
    return F.sha2(F.concat(F.lit(b"\1"), F.unhex(F.array_join(hashes, ""))), 256)


def _folded(nodes: DataFrame, keys: list[str], fan: int) -> DataFrame:
    """One level up: at most fan neighbours become one; of a key with a single node it stays."""
    group = nodes.groupBy(*keys, F.floor(F.col("part") / fan).alias("part"), "parts")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("part", "sha256"))), lambda x: x["sha256"])
    up = group.agg(ordered.alias("below"))
    above = F.when(F.col("parts") == 1, F.col("below")[0]).otherwise(joined_hash(F.col("below")))
    return up.select(*keys, "part", F.ceil(F.col("parts") / fan).alias("parts"), above.alias("sha256"))


def file_roots(hashes: DataFrame, size: int = RANGE, fan: int = FAN) -> DataFrame:
    """path, bytes and root of each file, from its range_hashes of the same size."""
    most = hashes.agg(F.max("part")).first()[0]
    nodes = hashes.withColumn("parts", F.ceil(F.col("bytes") / size))
    left = (most or 0) + 1
    while left > 1:
        nodes = _folded(nodes, ["path", "bytes"], fan)
        left = -(-left // fan)
    return nodes.select("path", "bytes", F.col("sha256").alias("root"))


def tree_root(files: DataFrame, fan: int = FAN, strip: str = "") -> DataFrame:
    """files and root: one hash over a manifest (path and root of each file), whatever its size and order.

    A file's leaf is the hash of its path (behind ``strip``) and root. Leaves meet by as many first digits of
    their paths' hashes as keep groups near ``fan``, then digit by digit. No files: the hash of nothing.
    """
    path = F.substring("path", len(strip) + 1, 1 << 30) if strip else F.col("path")
    place = F.sha2(path, 256)
    leaf = F.sha2(F.concat(F.lit(b"\0"), F.encode(F.concat_ws(" ", path, "root"), "utf-8")), 256)
    leaves = files.select(place.alias("place"), leaf.alias("sha256"))
    n = leaves.count()
    digits = 0
    while n > fan * 16**digits:
        digits += 1
    for d in range(digits, -1, -1):
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "sha256"))), lambda x: x["sha256"])
        groups = leaves.groupBy(F.substring("place", 1, d).alias("place")) if d else leaves.groupBy(F.lit("").alias("place"))
        leaves = groups.agg(ordered.alias("below")).select("place", joined_hash(F.col("below")).alias("sha256"))
    none = F.lit(hashlib.sha256(b"\1").hexdigest())
    return leaves.agg(F.lit(n).cast("long").alias("files"), F.coalesce(F.max("sha256"), none).alias("root"))


def changed_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """path and part of the ranges whose bytes differ, came or went between two range_hashes of one size."""
    a, b = before.select("path", "part", F.col("sha256").alias("old")), after.select("path", "part", F.col("sha256").alias("new"))
    both = a.join(b, ["path", "part"], "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.select("path", "part", change.alias("change"))
