"""N-gram Jaccard self-join by rare-first prefix filtering, and its connected components.

A document's set holds its distinct 5-word shingles. Two sets link when their similarity is at
least 3/4. The steps:

1. One pass hashes every set to a record id, so that equal sets are one record from here on,
   and counts all shingles of all documents in a table of ``COUNT_SLOTS`` slots (a fixed 8 MB).
   A second hash of the sets tells apart different ones that share a record id: those take it
   as their id instead.
2. Shingles are ordered by the count of their slot, then by hash: rare first. Linked sets share
   a shingle within their prefixes of n - ceil(3n/4) + 1 shingles. A second pass deals the
   prefixes out by shingle; shingles of one record end there.
3. Records that share a prefix shingle become candidates if the length filter and the positional
   filter allow it. Where more than ``GROUP`` records meet on one shingle, each is only paired
   with the first ``HUBS`` of them, so the number of pairs stays in proportion to the rows. Those
   come first whose prefixes hold the most frequent shingles: among near copies of one text, they
   are the least changed, and most others link with them.
4. The suffix filter bounds the overlap of a pair by the sizes of both sets in ``BINS`` hash
   classes. What is left is verified once per pair on the full sets, under another hash of the
   words than the one that found the pair.
5. Records of a large group that are not yet connected with its first hub are then paired with the
   others of the group that they are not connected with, block by block within size classes whose
   sizes may link, unless the suffix filter with ``FINE``
   classes, or their distances to that hub, rule it out: if these differ by more than 1/4, the
   triangle inequality of the Jaccard distance says that the pair cannot link. So no link between
   components is missed.

Only records with candidates have their sets shuffled; texts never are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerflow.llm.components import components
from ledgerflow.llm.key_filter import key_filter, marked
from ledgerflow.llm.shared import small_batches, written
from ledgerflow.llm.textbytes import LOWER, SEED, SEED2, counts_by_row, mix, pieces, rows_of, span_hash, spans, string_buffers
from ledgerflow.operators.spread import frequent, spread_join

WORDS = 5
COUNT_BITS = 20
COUNT_SLOTS = 1 << COUNT_BITS
COUNT_BLOCK = 1 << 12
GROUP, HUBS = 6, 3
BLOCK = 256
PART_ROWS = 1_000_000
MOST_PARTS = 20_000
BINS, FINE = 128, 512

# A place: 255 - how frequent the record's prefix is << 55 | size of its set << 28 | position
_CALM, _SIZE, _AT = 55, 28, (1 << 28) - 1
_SIZE_MASK = (1 << (_CALM - _SIZE)) - 1

#: All bytes but blank and the control characters from tab to carriage return.
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[32, 9, 10, 11, 12, 13]] = False


def shingle_sets(offsets: np.ndarray, data: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, in order of row and hash."""
    data = LOWER[data]
    start, end = spans(data, offsets, WORD_BYTE)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = span_hash(data, start, end, seed)
    row = rows_of(start, offsets)
    words = counts_by_row(start, offsets)
    n = max(0, len(start) - WORDS + 1)
    at = np.flatnonzero(row[:n] == row[len(row) - n :])
    short = np.flatnonzero((words > 0) & (words < WORDS))
    h = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        h = mix(h * np.uint64(3) + word[at + k])
    rows = row[at]
    if len(short):
        first = (np.cumsum(words) - words)[short]
        s = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            s = np.where(words[short] > k, mix(s * np.uint64(5) + word[np.minimum(first + k, len(word) - 1)] + np.uint64(1)), s)
        h, rows = np.append(h, s), np.append(rows, short)
    order = _by_row(rows, np.argsort(h))
    h, rows = h[order], rows[order]
    new = np.append(True, (h[1:] != h[:-1]) | (rows[1:] != rows[:-1]))
    return rows[new], h[new]


def _by_row(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """order, stably sorted by row."""
    keys = rows[order]
    small = len(keys) == 0 or keys.max() < 1 << 16
    return order[np.argsort(keys.astype(np.uint16) if small else keys, kind="stable")]


def _records(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, record id, second hash) of each text's set."""
    size = np.bincount(rows, minlength=n)
    both = np.zeros((2, n), np.uint64)
    full = np.flatnonzero(size)
    if len(full):
        at = (np.cumsum(size) - size)[full]
        for out, salt in zip(both, (0xA5A5A5A5A5A5A5A5, 0x3C6EF372FE94F82B), strict=True):
            out[full] = mix(np.add.reduceat(mix(hashes ^ np.uint64(salt)), at) * np.uint64(31) + size[full].astype(np.uint64))
    return size, both[0].view(np.int64), both[1].view(np.int64)


def _told_apart(rid: np.ndarray, check: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Record ids; where different sets share one, their second hashes."""
    return np.where(np.isin(rid, shared), check, rid) if len(shared) else rid


def _bins(rows: np.ndarray, hashes: np.ndarray, n: int, bins: int) -> np.ndarray:
    cell = rows * bins + (hashes & np.uint64(bins - 1)).astype(np.int64)
    return np.bincount(cell, minlength=n * bins).astype(np.int32)


def _few_bins(rows: np.ndarray, hashes: np.ndarray, n: int) -> pa.Array:
    """BINS counts of each text in a byte each; null where one does not fit."""
    counts = _bins(rows, hashes, n, BINS).reshape(n, BINS)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BINS), pa.array(np.minimum(counts, 127).astype(np.int8).ravel()))
    return pc.if_else(pa.array(counts.max(axis=1, initial=0) <= 127), lists, pa.scalar(None, lists.type))


def _fine(rows: np.ndarray, hashes: np.ndarray, n: int) -> pa.Array:
    """FINE counts of each text in a byte each; null where one does not fit."""
    counts = _bins(rows, hashes, n, FINE).reshape(n, FINE)
    offsets = pa.py_buffer((np.arange(n + 1, dtype=np.int32) * FINE).tobytes())
    raw = pa.BinaryArray.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.minimum(counts, 255).astype(np.uint8).tobytes())])
    return pc.if_else(pa.array(counts.max(axis=1, initial=0) < 255), raw, pa.scalar(None, pa.binary()))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (id, size, rid, check, bins, fine) per text, and at the end the partition's counts (block, counts)."""
    schema = pa.schema([("id", pa.int64()), ("size", pa.int64()), ("rid", pa.int64()), ("check", pa.int64()), ("bins", pa.list_(pa.int8())), ("fine", pa.binary()), ("block", pa.int32()), ("counts", pa.list_(pa.int32()))])
    counts = np.zeros(COUNT_SLOTS, np.int64)
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        for a, b in pieces(offsets):
            n = b - a
            rows, hashes = shingle_sets(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            counts += np.bincount((hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=COUNT_SLOTS)
            size, rid, check = _records(rows, hashes, n)
            bins = _few_bins(rows, hashes, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(a, n), pa.array(size.astype(np.int64)), pa.array(rid), pa.array(check), bins, _fine(rows, hashes, n), pa.nulls(n, pa.int32()), pa.nulls(n, schema.field("counts").type)], schema=schema
            )
    blocks = counts.reshape(-1, COUNT_BLOCK)
    used = np.flatnonzero(blocks.any(axis=1))
    if len(used):
        m = len(used)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * COUNT_BLOCK), pa.array(np.minimum(blocks[used], 2**31 - 1).astype(np.int32).ravel()))
        none = [pa.nulls(m, pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([*none, pa.nulls(m, schema.field("bins").type), pa.nulls(m, pa.binary()), pa.array(used.astype(np.int32)), lists], schema=schema)


def _add_up(table: pa.Table) -> pa.Table:
    total = np.zeros(COUNT_BLOCK, np.int64)
    for chunk in table["counts"].chunks:
        total += chunk.flatten().to_numpy().reshape(-1, COUNT_BLOCK).sum(axis=0)
    total = np.minimum(total, 2**31 - 1).astype(np.int32)
    return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "part": pa.array([0], pa.int32()), "counts": pa.array([total], pa.list_(pa.int32()))})


def _slot_counts(survey: DataFrame) -> np.ndarray:
    """Occurrences per slot over all documents: partial sums over parts of the partitions, then over the parts."""
    rows = survey.where("block is not null").select("block", "counts").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    schema = "block int, part int, counts array<int>"
    rows = rows.groupBy("block", "part").applyInArrow(_add_up, schema)
    rows = rows.groupBy("block").applyInArrow(_add_up, schema)
    out = np.zeros(COUNT_SLOTS, np.int32)
    for r in rows.select("block", "counts").collect():  # COUNT_SLOTS numbers at most
        out[r["block"] * COUNT_BLOCK : (r["block"] + 1) * COUNT_BLOCK] = r["counts"]
    return out


def _prefixes(batches: Iterator[pa.RecordBatch], counts: np.ndarray, shared: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(token, rid, place) of the prefix of every record; a record once per task."""
    seen: set[int] = set()
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        for a, b in pieces(offsets):
            n = b - a
            rows, hashes = shingle_sets(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            size, rid, check = _records(rows, hashes, n)
            rid = _told_apart(rid, check, shared)
            fresh = np.zeros(n, bool)
            for i, r in enumerate(rid.tolist()):
                if size[i] and r not in seen:
                    seen.add(r)
                    fresh[i] = True
            own = fresh[rows]
            rows, hashes = rows[own], hashes[own]
            size = np.where(fresh, size, 0)
            count = counts[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
            # logarithmic steps, so that no count is too large to be told from a larger one
            order = np.argsort((np.log2(count + 1.0) * 1000).astype(np.uint16), kind="stable")
            order = _by_row(rows, order)
            rows, hashes = rows[order], hashes[order]
            position = np.arange(len(rows)) - (np.cumsum(size) - size)[rows]
            inside = position < (size - (3 * size + 3) // 4 + 1)[rows]
            rows, position, count = rows[inside], position[inside], count[order][inside]
            known = np.maximum(np.bincount(rows, minlength=n), 1)
            calm = 255 - np.minimum(np.bincount(rows, weights=np.log2(count + 1.0), minlength=n) / known * 8, 255).astype(np.int64)
            place = (calm[rows] << _CALM) + (size[rows] << _SIZE) + position
            yield pa.RecordBatch.from_arrays([pa.array(hashes[inside].view(np.int64)), pa.array(rid[rows]), pa.array(place)], names=["token", "rid", "place"])


_MEET = pa.schema([("token", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("size", pa.int64()), ("hub", pa.bool_())])
_MEET_SQL = "token long, a long, b long, size long, hub boolean"


def _possible(a_place: np.ndarray, b_place: np.ndarray) -> np.ndarray:
    """Length filter and positional filter."""
    n, i, m, j = a_place >> _SIZE & _SIZE_MASK, a_place & _AT, b_place >> _SIZE & _SIZE_MASK, b_place & _AT
    most = np.minimum(i, j) + 1 + np.minimum(n - i, m - j) - 1
    return (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & (7 * most >= 3 * (n + m))


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of records that share a token, from rows in order of token, place and record.

    Groups of up to GROUP records give all their pairs, larger ones those with their first HUBS
    records; pairs with the very first carry hub. At most GROUP rows, and the hubs of one large group, are kept from batch to batch.
    """
    held = np.zeros((0, 3), np.int64)
    hubs = held  # the first rows of the large group that the last batch ended in
    behind = 0  # how many of its rows have been seen
    last: tuple[int, int] | None = None

    def emit(x: np.ndarray, y: np.ndarray, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        ok = first | _possible(x[:, 2], y[:, 2])
        x, y, first = x[ok], y[ok], first[ok]
        if len(x):
            size = y[:, 2] >> _SIZE & _SIZE_MASK
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(y[:, 1]), pa.array(size), pa.array(first)], schema=_MEET)

    def large(hubs: np.ndarray, rows: np.ndarray, since: int) -> Iterator[pa.RecordBatch]:
        """Rows of one large group, numbered from ``since``, with its hubs."""
        rank = since + np.arange(len(rows))
        for k in range(len(hubs)):
            later = rank > k
            n = int(later.sum())
            if n:
                yield from emit(np.repeat(hubs[k : k + 1], n, axis=0), rows[later], np.full(n, k == 0))

    def groups(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All pairs of small groups, and the pairs of large ones, that lie in rows as a whole."""
        if not len(rows):
            return
        start = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
        size = np.diff(np.append(start, len(rows)))
        for k in np.unique(size[(size > 1) & (size <= GROUP)]):
            at = start[size == k]
            i, j = np.triu_indices(int(k), 1)
            x, y = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
            yield from emit(rows[x], rows[y], np.zeros(len(x), bool))
        for at, k in zip(start[size > GROUP], size[size > GROUP], strict=True):
            yield from large(rows[at : at + HUBS], rows[at : at + k], 0)

    for batch in batches:
        rows = np.column_stack([batch.column(c).to_numpy() for c in ("token", "rid", "place")])
        if not len(rows):
            continue
        repeat = np.append(last == (int(rows[0, 0]), int(rows[0, 1])), (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1]))
        last = (int(rows[-1, 0]), int(rows[-1, 1]))
        rows = rows[~repeat]
        if len(hubs):
            more = int((rows[:, 0] == hubs[0, 0]).sum())  # they stand in front
            yield from large(hubs, rows[:more], behind)
            behind += more
            rows = rows[more:]
            if not len(rows):
                continue
            hubs = np.zeros((0, 3), np.int64)
        rows = np.concatenate([held, rows])
        if not len(rows):
            continue
        tail = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
        if len(rows) - tail > GROUP:
            hubs, behind, held = rows[tail : tail + HUBS].copy(), len(rows) - tail, np.zeros((0, 3), np.int64)
            yield from groups(rows)
        else:
            held = rows[tail:]
            yield from groups(rows[:tail])
    yield from groups(held)


def _sets(batches: Iterator[pa.RecordBatch], shared: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Record id and set of every text, the set under a hash of its own."""
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        for a, b in pieces(offsets):
            own, text = offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]
            _, rid, check = _records(*shingle_sets(own, text), b - a)
            rows, hashes = shingle_sets(own, text, SEED2)
            at = np.append(0, np.cumsum(np.bincount(rows, minlength=b - a))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(_told_apart(rid, check, shared)), pa.ListArray.from_arrays(pa.array(at), pa.array(hashes.view(np.int64)))], names=["rid", "set"])


def _linked(common: Column, n: Column, m: Column) -> Column:
    return 100 * common >= 75 * (n + m - common)


def _verified(pairs: DataFrame, records: DataFrame, docs: DataFrame, shared: np.ndarray) -> DataFrame:
    """a, b, n, m, common of some pairs of records, from their full sets."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    where = written(asked.join(records, "rid").select("rid", F.col("keep").alias("id")))
    some = marked(docs, key_filter(where, F.col("id")), F.col("id"), name="asked").where("asked").select("text")
    # a few more sets than asked for, by chance bits; the joins leave them out
    sets = written(some.mapInArrow(lambda it: _sets(it, shared), "rid long, set array<long>"), "uncompressed")
    met = _with_both(pairs, sets.select("rid", "set"))
    sized = met.select("a", "b", F.size("a_set").alias("n"), F.size("b_set").alias("m"), F.size(F.array_intersect("a_set", "b_set")).alias("common"))
    # a pair stands once, also where a record's set does not
    return sized.groupBy("a", "b").agg(*[F.first(c).alias(c) for c in ("n", "m", "common")])


def _with_both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs a, b with the columns of both their rows in a table by rid, named a_ and b_."""
    roles = pairs.select(F.explode(F.array("a", "b")).alias("rid"))
    hot = frequent(roles, "rid")  # the same for both sides, so that the table is dealt out once
    for side, other in (("a", "b"), ("b", "a")):
        own = table.select(F.col("rid").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in table.columns if c != "rid"])
        pairs = spread_join(pairs, own, [side], [F.col(other)], hot=None if hot is None else hot.withColumnRenamed("rid", side))
    return pairs


def _suffix_filter(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs whose sets may overlap enough: no bin can hold more common shingles than the smaller side has there."""
    both = _with_both(pairs, records.select("rid", "size", "bins"))
    most = F.aggregate(F.zip_with("a_bins", "b_bins", lambda x, y: F.least(x, y).cast("int")), F.lit(0), lambda s, x: s + x)
    # sets without bins are bounded by the smaller one
    most = F.coalesce(most, F.least("a_size", "b_size").cast("int"))
    return both.where(_linked(most, F.col("a_size"), F.col("b_size"))).select("a", "b")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles and component_id of every row of docs.

    component_id is the smallest id that links lead to, the row's own included. Words are runs of
    anything but ASCII white space, after lower-casing A-Z. A text of one to four words has one
    shingle; null, empty and blank texts have none, link with nothing and keep their own id. Rows
    that repeat an id stay rows of their own; rows with a null id link through as others do, and
    components of null ids alone have a null component_id. Ids are read as long integers; other
    columns play no part.
    """
    out = _rows_in_components(docs, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def _rows_in_components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, size, rid, label (of its component; null without shingles) and component of every row of docs."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    small_batches(docs.sparkSession)
    survey = written(docs.mapInArrow(_survey, "id long, size long, rid long, check long, bins array<byte>, fine binary, block int, counts array<int>"))
    rows = survey.where("block is null")
    both = rows.where("size > 0").groupBy("rid").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select("rid")
    shared = np.array([r["rid"] for r in both.collect()], np.int64)  # by chance alone: next to never one
    if len(shared):
        rows = rows.withColumn("rid", F.when(F.col("rid").isin(shared.tolist()), F.col("check")).otherwise(F.col("rid")))
    full = rows.where("size > 0")
    records = written(full.groupBy("rid").agg(F.min("id").alias("keep"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bins").alias("bins"), F.first("fine").alias("fine")))
    counts = docs.sparkSession.sparkContext.broadcast(_slot_counts(survey))  # a fixed COUNT_SLOTS numbers

    prefixes = docs.mapInArrow(lambda it: _prefixes(it, counts.value, shared), "token long, rid long, place long")
    dealt = prefixes.repartition(_parts(records), "token").sortWithinPartitions("token", "place", "rid")
    met = written(dealt.mapInArrow(_meetings, _MEET_SQL))
    pairs = written(met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("tokens")))
    pairs = written(_suffix_filter(pairs, records))
    known = written(_verified(pairs, records, docs, shared))
    is_link = _linked(F.col("common"), F.col("n"), F.col("m"))
    links = known.where(is_link).select("a", "b")
    labels = components(links)
    if not met.where("hub").isEmpty():
        extra = written(_second_round(met.where("hub"), known, labels, records))
        more = _verified(extra, records, docs, shared).where(is_link).select("a", "b")
        labels = components(written(links.unionByName(more)))

    home = records.select("rid", "keep", "copies").join(labels, records["rid"] == labels["node"], "left")
    home = written(home.select("rid", F.coalesce("label", "rid").alias("label"), "keep", "copies"))
    least = home.groupBy("label").agg(F.min("keep").alias("component"))
    home = spread_join(home, least, ["label"], [F.col("rid")], hot=frequent(home, "label"))
    copies = frequent(full, "rid", counts=records.select("rid", F.col("copies").alias("n")))
    named = spread_join(full.select("id", "size", "rid"), home.select("rid", "label", "component"), ["rid"], [F.col("id")], hot=copies)
    named = named.select("id", "size", "rid", "label", "component")
    alone = rows.where("size = 0").select("id", "size", "rid", F.lit(None).cast("long").alias("label"), F.col("id").alias("component"))
    return named.unionByName(alone)


def _parts(records: DataFrame) -> int:
    """Tasks for the prefix rows of all records: about PART_ROWS rows each, the session's number at least."""
    rows = records.agg(F.sum(F.col("size") - F.ceil(F.col("size") * 3 / 4) + 1)).first()[0] or 0
    return max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(rows) // PART_ROWS))


def _close_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Pairs of a block of records outside a hub's component and a block of its group that may link."""
    out: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    if left.num_rows and right.num_rows:
        column = lambda t, c: t[c].to_numpy()

        def counts(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            # a null signature bounds nothing: of two, the smaller set does
            some = t["fine"].combine_chunks()
            return string_buffers(some.fill_null(b"\xff" * FINE))[1].reshape(-1, FINE), some.is_null().to_numpy(zero_copy_only=False)

        names = ("size", "low", "high", "label", "rid")
        (y_fine, y_wide), (y_size, y_low, y_high, y_label, y_rid) = counts(right), (column(right, c) for c in names)
        for fine, wide, size, low, high, label, rid in zip(*counts(left), *(column(left, c) for c in names), strict=True):
            most = np.minimum(fine, y_fine).sum(axis=1, dtype=np.int64)
            if wide:
                most[y_wide] = np.minimum(size, y_size)[y_wide]
            ok = (7 * most >= 3 * (size + y_size)) & (low - y_high <= 0.2500001) & (y_low - high <= 0.2500001) & (label != y_label)
            ok &= 4 * np.minimum(size, y_size) >= 3 * np.maximum(size, y_size)
            other = y_rid[ok]
            out.append(np.column_stack([np.minimum(rid, other), np.maximum(rid, other)]))
    pairs = np.unique(np.concatenate(out), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _second_round(met: DataFrame, known: DataFrame, labels: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs of records with the same first hub, that are not connected and could link.

    The members of a hub with more than BLOCK fall into classes by size, such that sizes that may link lie in the same
    or in neighbouring classes, and there into blocks of about BLOCK records. Every block of those
    outside its component meets every block of these classes once, in a task of its own. The suffix filter, the
    triangle inequality and the components are tested there, so only pairs that pass become rows.
    """
    distance = known.select("a", "b", (1 - F.col("common") / (F.col("n") + F.col("m") - F.col("common"))).alias("far"))
    distance = distance.unionByName(distance.select(F.col("b").alias("a"), F.col("a").alias("b"), "far"))
    # a member that the filters keep from being compared with its hub is farther than 1/4 from it
    here = written(met.groupBy("a", "b").agg(F.first("size").alias("size")).join(distance, ["a", "b"], "left"))
    of_hub = labels.select(F.col("node").alias("a"), F.col("label").alias("hub_label"))
    of_one = labels.select(F.col("node").alias("b"), F.col("label").alias("own_label"))
    here = spread_join(here, of_hub, ["a"], [F.col("b")], "left", frequent(here, "a")).join(of_one, "b", "left")
    here = here.join(records.select(F.col("rid").alias("b"), "fine"), "b").select(
        F.col("a").alias("hub"), F.col("b").alias("rid"), "size", F.coalesce("far", F.lit(0.25)).alias("low"), F.coalesce("far", F.lit(1.0)).alias("high"),
        F.coalesce("own_label", "b").alias("label"), "fine", (F.coalesce("own_label", "b") != F.coalesce("hub_label", "a")).alias("outside"),
        # a step a little above 4/3, so that rounding cannot part sizes that may link
        F.floor(F.log("size") / math.log(4 / 3 + 1e-6)).cast("int").alias("klass"),
    )
    here = written(here)
    large = here.groupBy("hub").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("hub", F.lit(True).alias("large"))
    here = spread_join(here, large, ["hub"], [F.col("rid")], "left", frequent(here, "hub"))
    here = written(here.withColumn("klass", F.when(F.col("large"), F.col("klass")).otherwise(0)))
    sizes = here.groupBy("hub", "klass").agg(F.count_if("outside").alias("out"), F.count("*").alias("all"))
    left = sizes.where("out > 0").select("hub", F.col("klass").alias("x_klass"), F.ceil(F.col("out") / BLOCK).cast("int").alias("x_blocks"))
    left = left.withColumn("y_klass", F.explode(F.array(*[F.col("x_klass") + k for k in (-1, 0, 1)])))
    right = sizes.select("hub", F.col("klass").alias("y_klass"), F.ceil(F.col("all") / BLOCK).cast("int").alias("y_blocks"))
    plan = written(left.join(right, ["hub", "y_klass"]))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")
    rows = lambda side, of: here.where(of).withColumnRenamed("klass", f"{side}_klass").join(plan, ["hub", f"{side}_klass"])
    by = ("hub", "x_klass", "y_klass", "x", "y")
    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in (*by, "rid", "size", "low", "high", "label", "fine")])
    x = fresh(rows("x", F.col("outside")).withColumn("x", block("x_blocks")).withColumn("y", each("y_blocks")))
    y = fresh(rows("y", F.lit(True)).withColumn("y", block("y_blocks")).withColumn("x", each("x_blocks")))
    # tasks by their number of block pairs: bytes do not tell what these cost
    meetings = plan.agg(F.sum(F.col("x_blocks") * F.col("y_blocks"))).first()[0] or 0
    parts = max(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, -(-int(meetings) // 4)))
    x, y = (side.repartition(parts, *by) for side in (x, y))
    pairs = x.groupBy(*by).cogroup(y.groupBy(*by)).applyInArrow(_close_pairs, "a long, b long")
    return pairs.where("a <> b").distinct().join(known.select("a", "b"), ["a", "b"], "left_anti")


def _with_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        for a, b in pieces(offsets):
            n = b - a
            size, rid, check = _records(*shingle_sets(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]), n)
            columns = [batch.column("row").slice(a, n), batch.column("id").slice(a, n), pa.array(size.astype(np.int64)), pa.array(rid), pa.array(check)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "size", "rid", "check"])


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component, the one with the smallest id; columns as they are.

    Where several rows of a component have its smallest id, one of them stays; rows of that id in
    other components are judged there. Rows with a null id, and rows without shingles, stay. Only
    rows whose id repeats are read once more and shuffled for this.
    """
    rows = written(_rows_in_components(docs, id_col, text_col))
    repeated = written(rows.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"))
    gone = rows.where("component <> id").select(F.col("id").alias("_gone"))
    gone = gone.unionByName(repeated.select(F.col("id").alias("_gone"))).distinct()
    kept = docs.join(gone, docs[f"`{id_col}`"] == gone["_gone"], "left_anti")
    if repeated.isEmpty():
        return kept
    # of the rows that have their component's smallest id, those of one record
    best = rows.where("size > 0 and id = component").join(repeated, "id", "left_semi").groupBy("label").agg(F.min("id").alias("id"), F.min("rid").alias("best"))
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    again = docs.select(whole.alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    again = marked(again, key_filter(repeated, F.col("id")), F.col("id"), name="asked").where("asked").select("row", "id", "text").join(repeated, "id", "left_semi")
    kind = StructType([again.schema["row"], *[StructField(c, LongType()) for c in ("id", "size", "rid", "check")]])
    again = again.select("row", "id", "text").mapInArrow(_with_records, kind)
    one = again.where("size > 0").join(best.select("id", "best"), "id").where("rid = best or check = best").groupBy("id", "best").agg(F.first("row").alias("row"))
    more = one.select("row").unionByName(again.where("size = 0").select("row"))
    return kept.unionByName(more.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
