"""The trie of conversations' beginnings, by adaptive radix trees over turn ids.

A turn's id has a fixed width: the length of its text as four big-endian bytes and 16 bytes of a
digest of role and text. A conversation is the string of its turns' ids, so conversations that begin
alike are strings that begin alike, and a node of the trie is a depth of whole ids.

The strings are dealt into contiguous ranges; each range is a shard, and one radix tree holds it. Nodes
on the path that two neighbouring shards have in common are *open*: each shard gives its part of
them, and parts add up (members, children, leaves, saved tokens). All others are whole within one
shard. An open node is named by the first shard that has it and its depth, which the common lengths at
the shards' borders tell; two numbers for each shard are all that passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.radix_tree import RadixTree, common
from ledgerflow.llm.shared import small_batches, written
from ledgerflow.operators.spread import frequent, spread_join

#: Bytes of a turn's id.
WIDTH = 20
#: Bytes of strings that one radix tree holds, about.
SHARD_BYTES = 1 << 20
#: Members of one sequence whose ids lie this close are listed together.
LISTED = 1 << 16

_PARTS = "open int, depth long, above int, parent_conv_id long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, turn_id binary"


def turn_keys(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and key, the string of turn ids, of every conversation: a row for each, of 20 bytes a turn.

    Turns are taken by number, null first, equal numbers by role and then by id; null role or text
    counts as empty. Rows without conv take no part. Only ids are shuffled, no texts.
    """
    c = lambda name: F.col(f"`{name}`")
    said, by = F.coalesce(c(text).cast("string"), F.lit("")), F.coalesce(c(role).cast("string"), F.lit(""))
    size = F.lpad(F.hex(F.octet_length(said)), 8, "0")
    digest = F.left(F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256), F.lit(2 * (WIDTH - 4)))
    rows = conversations.where(c(conv).isNotNull()).select(c(conv).cast("long").alias("conv_id"), F.struct(c(turn).alias("turn"), by.alias("role"), F.concat(size, digest).alias("id")).alias("turn"))
    ordered = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(ordered, lambda t: t["id"]), "")).alias("key"))


def _shards(keys: DataFrame) -> DataFrame:
    """shard, key, n, first and ids: a row for each sequence and LISTED ids; shards are contiguous ranges of keys."""
    near = keys.groupBy("key", F.floor(F.col("conv_id") / LISTED).alias("near"))
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")), ",")
    listed = written(near.agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), ids.alias("ids")))
    size = listed.agg(F.sum(F.length("key") + F.length("ids"))).first()[0] or 0
    return written(listed.repartitionByRange(size // SHARD_BYTES + 1, "key").withColumn("shard", F.spark_partition_id()))


def _common_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        before = [-1 if z is None else common(z, a) // WIDTH for z, a in zip(rows["before"], rows["a"], strict=True)]
        inside = [common(a, z) // WIDTH for a, z in zip(rows["a"], rows["z"], strict=True)]
        yield pa.RecordBatch.from_pydict({"shard": batch.column("shard"), "before": pa.array(before, pa.int64()), "inside": pa.array(inside, pa.int64())})


class Borders:
    """How many turns the strings at the borders of shards have in common."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        """rows: shard, common turns of its first string and the one before (-1: none), of its first and last."""
        rows = sorted(rows)
        self.shard = np.array([r[0] for r in rows], np.int64)
        self.before = np.array([r[1] for r in rows] + [-1], np.int64)
        self.inside = np.array([r[2] for r in rows], np.int64)

    def of(self, shard: int) -> tuple[list[int], int]:
        """(first shard of the open node at each depth that an earlier shard has begun, depth up to which the next goes on)."""
        k = int(np.searchsorted(self.shard, shard))
        begun, j = [0] * (int(self.before[k]) + 1), k - 1
        for depth in range(len(begun) - 1, -1, -1):
            while self.before[j] >= depth and self.inside[j] >= depth:
                j -= 1
            begun[depth] = int(self.shard[j])
        return begun, int(self.before[k + 1])


def _borders(shards: DataFrame) -> Borders:
    ends = shards.groupBy("shard").agg(F.min("key").alias("a"), F.max("key").alias("z"))
    beside = ends.withColumn("before", F.lag("z").over(Window.orderBy("shard")))  # a row for each shard
    return Borders([tuple(r) for r in beside.mapInArrow(_common_turns, "shard int, before long, inside long").collect()])


def _shard_nodes(tree: RadixTree, shard: int, borders: Borders) -> pa.RecordBatch:
    """The nodes of one shard's tree, open ones in part."""
    nodes = list(tree.aligned(WIDTH))
    begun, beyond = borders.of(shard)
    n = len(nodes)
    first_at: dict[int, int] = {}
    last_at: dict[int, int] = {}
    for i, (depth, *_) in enumerate(nodes):
        if depth < len(begun):
            first_at.setdefault(depth, i)
        if depth <= beyond:
            last_at[depth] = i
    named: list[int | None] = [None] * n
    for i in last_at.values():
        named[i] = shard
    for depth, i in first_at.items():
        named[i] = begun[depth]
    old = set(first_at.values())
    members, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    digest: list[str | None] = [None] * n
    for i in range(n - 1, -1, -1):
        depth, parent, turn, end = nodes[i]
        if end is not None:
            members[i] += end[0]
            least[i] = end[1] if least[i] is None else min(least[i], end[1])
            digest[i] = end[2]
        size = int.from_bytes(turn[:4])
        saved[i] += (members[i] - (i not in old)) * size
        if not children[i] and named[i] is None:
            leaves[i] = 1
        if parent >= 0:
            members[parent] += members[i]
            least[parent] = least[i] if least[parent] is None else min(least[parent], least[i])
            children[parent] += i not in old
            leaves[parent] += leaves[i]
            saved[parent] += saved[i]
    parents = [x[1] for x in nodes]
    above = [named[p] if p >= 0 else None for p in parents]
    parent_conv = [least[p] if p >= 0 and named[p] is None else None for p in parents]
    columns = [named, [x[0] for x in nodes], above, parent_conv, least, members, children, leaves, saved, digest, [x[2] or None for x in nodes]]
    schema = pa.schema([("open", pa.int32()), ("depth", pa.int64()), ("above", pa.int32()), *[(c, pa.int64()) for c in ("parent_conv_id", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], ("ends_sha256", pa.string()), ("turn_id", pa.binary())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _trees(batches: Iterator[pa.RecordBatch], borders: Borders) -> Iterator[pa.RecordBatch]:
    """One tree after the other; the rows of a key follow each other by their ids, which only pass through the digest."""
    tree, shard, key, state = RadixTree(), None, None, None

    def end() -> None:
        if key is not None:
            tree.insert(key, (state[0], state[1], state[2].hexdigest()))

    for batch in batches:
        for of, k, n, first, ids in zip(*[batch.column(c).to_pylist() for c in ("shard", "key", "n", "first", "ids")], strict=True):
            if of == shard and k == key:
                state[0] += n
                state[2].update(b"," + ids.encode())
                continue
            end()
            if of != shard:
                if shard is not None:
                    yield _shard_nodes(tree, shard, borders)
                tree, shard = RadixTree(), of
            key, state = k, [n, first, hashlib.sha256(ids.encode())]
    end()
    if shard is not None:
        yield _shard_nodes(tree, shard, borders)


def prefix_trie(keys: DataFrame) -> DataFrame:
    """A row for each node of the trie of keys (conv_id and key, a string of 20-byte turn ids; one row each).

    conv_id (the smallest member), depth, parent_conv_id (the parent's; null at the root), n_convs
    (members), n_children, n_leaves (childless nodes of the subtree), saved_tokens (over the
    subtree: (n_convs - 1) times the bytes of the node's last text), ends_sha256 (of the ids of those
    members that end here, ascending, joined by commas) and turn_id (null at the root). A null key
    counts as one without turns; rows without conv_id take no part; no rows, no nodes. Other columns
    play no part. A key that very many conversations share is grouped before anything is gathered,
    and its members' ids pass through a digest in order, without being held.
    """
    small_batches(keys.sparkSession)
    plain = keys.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("key", F.lit(b"")).alias("key"))
    shards = _shards(plain)
    borders = keys.sparkSession.sparkContext.broadcast(_borders(shards))
    dealt = shards.repartition(F.col("shard")).sortWithinPartitions("shard", "key", "first")
    parts = written(dealt.mapInArrow(lambda it: _trees(it, borders.value), _PARTS))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    shared = parts.where("open is not null").groupBy("open", "depth")
    open_nodes = shared.agg(F.max("above").alias("above"), F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"), F.max("turn_id").alias("turn_id"))
    whole = parts.where("open is null")
    below = whole.where("above is not null").drop("open", "parent_conv_id").unionByName(open_nodes.drop("open"))
    heads = open_nodes.select(F.col("open").alias("above"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    joined = spread_join(below, heads, ["above", "depth"], [F.col("conv_id")], "left", frequent(below, "above", "depth"))
    out = whole.where("above is null").drop("open").unionByName(joined)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "turn_id")
