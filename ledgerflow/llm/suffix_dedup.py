"""Suffix-array dedup: remove bytes covered by long strings that also start earlier.

A window is a string of ``WINDOW`` bytes. Every start of a window belongs to one anchor: the least
``GRAM``-byte string inside the window, by hash. Equal windows have equal anchors at equal
offsets, so windows only need to be compared with others of the same anchor.

1. One pass cuts every text into runs of neighbouring starts with one anchor. A run is dealt out by
   its anchor with a digest (128 bits, BLAKE2) of its content (all bytes of its windows).
2. Runs arrive in order of anchor, content and place. All but the first of equal runs are repeats as
   a whole. First runs of anchors with one content need nothing; the others need a closer look.
3. Only those have their bytes fetched, from the documents that hold them. They are gathered by
   anchor into shards of about ``SHARD`` bytes; each shard gets its suffix array by induced sorting
   and its permuted common prefixes. Windows are equal where neighbours in the array share
   WINDOW bytes; of each class all starts but the earliest are repeats.
4. An anchor with more than ``HOT`` different contents is split before that: its windows are dealt
   out anew by the anchor and the bytes next to it. What is still larger then (very many contents
   around one string of twice the length) is compared window by window, by digests.
5. The repeats of a document are joined to it, and the bytes they cover are removed. Documents
   without repeats are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.key_filter import key_filter, marked
from ledgerflow.llm.shared import small_batches, written
from ledgerflow.llm.suffix_array import permuted_common_prefixes, suffix_array
from ledgerflow.llm.textbytes import digests, eight_bytes, mix, pieces, span_hash, string_buffers
from ledgerflow.operators.spread import frequent, spread_join

WINDOW, GRAM = 100, 32
#: Grams per window; also the largest number of starts in a run.
SPAN = WINDOW - GRAM + 1
SHARD = 1 << 22
HOT = 8192
#: Bytes before its anchor from which on a window is dealt out by those rather than by what follows.
HALF = (WINDOW - GRAM) // 2
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

# place of a run: its first start << 8 | (its number of starts - 1) << 1 | settled
_RUN_SQL = "anchor long, content long, more long, id long, place long"
_RUN = pa.schema([(n, pa.int64()) for n in ("anchor", "content", "more", "id", "place")])


def _least_in_windows(keys: np.ndarray) -> np.ndarray:
    """min(keys[s : s + SPAN]) for every s with a full window."""
    n = len(keys)
    if n < SPAN:
        return np.zeros(0, keys.dtype)
    blocks = -(-n // SPAN)
    padded = np.full(blocks * SPAN, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    grid = padded.reshape(blocks, SPAN)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - SPAN + 1], ahead[SPAN - 1 : n])


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every position on; it orders and deals out, and need not tell apart."""
    eight = eight_bytes(data)
    n = len(data) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for k, factor in enumerate(_FACTORS):
        h += eight[8 * k : 8 * k + n] * np.uint64(factor)
    return mix(h)


def runs(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first start, number of starts, anchor, two columns of content digest) of the runs of some texts."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return (none,) * 6
    grams = _grams(data)
    # the least by its first half, then the leftmost: the same choice wherever the window stands
    low = np.uint64(0xFFFFFFFF)
    at = (_least_in_windows((grams & ~low) | np.arange(len(grams), dtype=np.uint64)) & low).astype(np.int64)
    length = np.diff(offsets)
    row = np.repeat(np.arange(len(length)), length)[: len(at)]
    valid = np.arange(len(at)) + WINDOW <= offsets[1:][row]
    start = np.flatnonzero(valid)
    if not len(start):
        return (none,) * 6
    own, at = row[start], at[start]
    fresh = np.append(True, (at[1:] != at[:-1]) | (own[1:] != own[:-1]))
    first = np.flatnonzero(fresh)
    many = np.diff(np.append(first, len(start)))
    begin = start[first]
    content, more = digests(data, begin, begin + many - 1 + WINDOW)
    own = own[first]
    return own, begin - offsets[own], many, grams[at[first]].view(np.int64), content, more


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of all texts. Of equal runs in a batch the first goes on; the rest are settled, under keys of their own."""
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        ids = batch.column("id").to_numpy()
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for a, b in pieces(offsets):
            row, begin, many, anchor, content, more = runs(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            for p, x in zip(parts, (anchor, content, more, ids[a:b][row], begin << 8 | (many - 1) << 1), strict=True):
                p.append(x)
        if not parts[0]:
            continue
        anchor, content, more, who, place = (np.concatenate(p) for p in parts)
        order = np.lexsort((place, who, more, content))
        anchor, content, more, who, place = anchor[order], content[order], more[order], who[order], place[order]
        again = np.append(False, (content[1:] == content[:-1]) & (more[1:] == more[:-1]) & (anchor[1:] == anchor[:-1]))[: len(anchor)]
        anchor = np.where(again, mix((who * 31 + place).view(np.uint64)).view(np.int64), anchor)
        content, more = np.where(again, 0, content), np.where(again, 0, more)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, content, more, who, place | again)], schema=_RUN)


_SORTED_SQL = "anchor long, id long, place long"
_SORTED = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("place", pa.int64())])


def _first_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs in order: repeats (anchor null), and the first runs of anchors with several contents.

    Keeps one row from batch to batch: the first run of the last anchor, until a second content shows up.
    """
    anchor_before = content_before = more_before = None
    held: np.ndarray | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, content, more, who, place = (batch.column(c).to_numpy() for c in ("anchor", "content", "more", "id", "place"))
        settled = (place & 1) == 1
        open_ = np.flatnonzero(~settled)
        repeat = np.zeros(len(anchor), bool)
        first_rows = []
        if len(open_):
            a, c, d = anchor[open_], content[open_], more[open_]
            same_anchor = np.append(anchor_before is not None and a[0] == anchor_before, a[1:] == a[:-1])
            same = same_anchor & np.append(content_before is not None and c[0] == content_before and d[0] == more_before, (c[1:] == c[:-1]) & (d[1:] == d[:-1]))
            repeat[open_[same]] = True
            anchor_before, content_before, more_before = a[-1], c[-1], d[-1]
            first = open_[~same]
            rows = np.column_stack([anchor[first], who[first], place[first]])
            # a run without a row before it of the same anchor starts a new anchor
            begins = ~same_anchor[~same]
            carried = held is not None
            if carried:
                rows, begins = np.concatenate([held[None, :], rows]), np.append(True, begins)
            group = np.cumsum(begins)
            size = np.bincount(group, minlength=int(group[-1]) + 1 if len(group) else 1)
            keep = size[group] > 1 if len(group) else np.zeros(0, bool)
            # runs of an anchor whose first run has been passed on before
            if len(group):
                keep |= group == 0
                held = rows[-1] if size[group[-1]] == 1 and group[-1] > 0 else None
            first_rows = rows[keep]
        out = np.flatnonzero(settled | repeat)
        parts = [pa.RecordBatch.from_arrays([pa.nulls(len(out), pa.int64()), pa.array(who[out]), pa.array(place[out])], schema=_SORTED)]
        if len(first_rows):
            parts.append(pa.RecordBatch.from_arrays([pa.array(first_rows[:, k].copy()) for k in range(3)], schema=_SORTED))
        yield from parts


_BYTES_SQL = "anchor long, id long, place long, bytes binary"
_BYTES = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("place", pa.int64()), ("bytes", pa.binary())])


def _begin(place: np.ndarray) -> np.ndarray:
    return place >> 8


def _starts(place: np.ndarray) -> np.ndarray:
    return (place >> 1 & 127) + 1


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that each text is asked for."""
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        ids, asked = batch.column("id").to_numpy(), batch.column("asked")
        at = asked.offsets.to_numpy().astype(np.int64)
        flat = asked.values
        anchor, place = flat.field("anchor").to_numpy(), flat.field("place").to_numpy()
        for a, b in pieces(offsets):
            lo, hi = at[a], at[b]
            row = np.repeat(np.arange(a, b), np.diff(at[a : b + 1]))
            p = place[lo:hi]
            begin, length = offsets[row] + _begin(p), _starts(p) - 1 + WINDOW
            text = data[_ragged(begin, length)]
            ends = np.append(0, np.cumsum(length)).astype(np.int32)
            raw = pa.BinaryArray.from_buffers(pa.binary(), len(p), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(anchor[lo:hi]), pa.array(ids[row]), pa.array(p), raw], schema=_BYTES)


def shard_repeats(ids: np.ndarray, place: np.ndarray, offsets: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, start) of the windows of some runs that also start earlier within these runs."""
    order = suffix_array(text)
    shared = permuted_common_prefixes(text, order)
    many = _starts(place)
    start = _ragged(offsets[:-1], many)  # in the shard
    run = np.repeat(np.arange(len(many)), many)
    number = np.full(len(text), -1, np.int64)
    number[start] = np.arange(len(start))
    klass = np.cumsum(shared[order] < WINDOW)
    own = number[order]
    klass, own = klass[own >= 0], own[own >= 0]
    who = ids[run[own]]
    where = _begin(place)[run[own]] + start[own] - offsets[:-1][run[own]]
    by = np.lexsort((where, who, klass))
    klass, who, where = klass[by], who[by], where[by]
    later = np.append(False, klass[1:] == klass[:-1])
    return who[later], where[later]


_REPEAT_SQL = "id long, begin long, end long"
_REPEAT = pa.schema([("id", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])


def _intervals(who: np.ndarray, where: np.ndarray) -> pa.RecordBatch:
    """Neighbouring repeated windows as intervals of bytes."""
    by = np.lexsort((where, who))
    who, where = who[by], where[by]
    fresh = np.append(True, (who[1:] != who[:-1]) | (where[1:] > where[:-1] + WINDOW))[: len(who)]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(who)) - 1 if len(first) else first
    return pa.RecordBatch.from_arrays([pa.array(who[first]), pa.array(where[first]), pa.array(where[last] + WINDOW)], schema=_REPEAT)


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among runs that come in order of their anchors, a shard at a time."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        offsets, text = string_buffers(table["bytes"])
        return _intervals(*shard_repeats(table["id"].to_numpy(), table["place"].to_numpy(), offsets, text))

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size >= SHARD:
            table = pa.Table.from_batches(held).combine_chunks()
            anchor = table["anchor"].to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut:
                yield settle(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            size = sum(b.column("bytes").nbytes for b in held) if cut else 0
    if held:
        yield settle(pa.Table.from_batches(held).combine_chunks())


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of hot anchors, cut in two and dealt out anew by what stands next to the anchor.

    A window in which the anchor stands far to the left holds the GRAM bytes behind it, any other
    those before it; equal windows agree on which, so they get the same new key.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, text = string_buffers(batch.column("bytes"))
        anchor, who, place = (batch.column(c).to_numpy() for c in ("anchor", "id", "place"))
        many, begin, base = _starts(place), _begin(place), offsets[:-1]
        # where the anchor stands: the first place that lies in all windows of the run
        span = SPAN - many + 1
        at = _ragged(base + many - 1, span)
        run = np.repeat(np.arange(len(many)), span)
        found = np.where(_grams(text)[at] == anchor[run].view(np.uint64), at, len(text))
        spot = np.minimum.reduceat(found, np.cumsum(span) - span)
        cut = np.clip(spot - base - HALF, 0, many)  # starts before it have more than HALF bytes before the anchor
        for side, first, last in ((0, np.zeros(len(many), np.int64), cut), (1, cut, many)):
            some = np.flatnonzero(last > first)
            if not len(some):
                continue
            first, last = first[some], last[some]
            beside = spot[some] + (GRAM if side else -GRAM)
            key = mix(span_hash(text, beside, beside + GRAM) + anchor[some].view(np.uint64) * np.uint64(2) + np.uint64(side))
            length = last - first - 1 + WINDOW
            ends = np.append(0, np.cumsum(length)).astype(np.int32)
            raw = pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(text[_ragged(base[some] + first, length)].tobytes())])
            where = (begin[some] + first) << 8 | (last - first - 1) << 1
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(who[some]), pa.array(where), raw], schema=_BYTES)


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest, id and start of every window of some runs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, text = string_buffers(batch.column("bytes"))
        place = batch.column("place").to_numpy()
        many = _starts(place)
        start = _ragged(offsets[:-1], many)
        run = np.repeat(np.arange(len(many)), many)
        one, two = digests(text, start, start + WINDOW)
        where = _begin(place)[run] + start - offsets[:-1][run]
        yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(batch.column("id").to_numpy()[run]), pa.array(where)], names=["one", "two", "id", "begin"])


def _window_repeats(runs: DataFrame) -> DataFrame:
    """Repeats among the runs of keys that stay very large, window by window."""
    windows = written(runs.mapInArrow(_single_windows, "one long, two long, id long, begin long"))
    earliest = written(windows.groupBy("one", "two").agg(F.min(F.struct("id", "begin")).alias("first"), F.count("*").alias("n")).where("n > 1"))
    hot = frequent(earliest, "one", "two", counts=earliest.select("one", "two", "n"))
    met = spread_join(windows, earliest, ["one", "two"], [F.col("id"), F.col("begin")], hot=hot)
    met = met.where((F.col("id") != F.col("first.id")) | (F.col("begin") != F.col("first.begin")))
    return met.select("id", "begin", (F.col("begin") + WINDOW).alias("end"))


def _large(runs: DataFrame) -> DataFrame:
    """The keys (anchor) of more than HOT runs."""
    return written(runs.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("anchor"))


def _sorted_repeats(runs: DataFrame) -> DataFrame:
    return runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_shards, _REPEAT_SQL)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n_bytes, spans and kept of texts with the intervals that are removed from them."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        repeats = batch.column("repeats")
        at = repeats.offsets.to_numpy().astype(np.int64)
        begin, end = repeats.values.field("begin").to_numpy(), repeats.values.field("end").to_numpy()
        for a, b in pieces(offsets):
            base = offsets[a]
            row = np.repeat(np.arange(a, b), np.diff(at[a : b + 1]))
            n = int(offsets[b] - base)
            change = np.bincount(offsets[row] - base + begin[at[a] : at[b]], minlength=n + 1) - np.bincount(offsets[row] - base + end[at[a] : at[b]], minlength=n + 1)
            gone = np.cumsum(change[:n]) > 0
            edge = np.zeros(n + 1, bool)
            edge[0] = True
            edge[offsets[a:b] - base] = True
            before = np.append(False, gone[:-1])[:n]
            first = np.flatnonzero(gone & (~before | edge[:n]))
            after = np.append(gone[1:], False)[:n]
            last = np.flatnonzero(gone & (~after | edge[1 : n + 1])) + 1
            owner = np.searchsorted(offsets[a : b + 1] - base, first, side="right") - 1
            own = offsets[a:b][owner] - base
            structs = pa.StructArray.from_arrays([pa.array(first - own), pa.array(last - own)], names=["start", "end"])
            sizes = np.bincount(owner, minlength=b - a)
            spans = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), structs).cast(span)
            rest = data[base : base + n][~gone]
            left = np.append(0, np.cumsum(~gone))[offsets[a : b + 1] - base].astype(np.int32)
            kept = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(left.tobytes()), pa.py_buffer(rest.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(np.diff(offsets[a : b + 1])), spans, kept], names=["id", "n_bytes", "spans", "kept"])


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text, given id and an id that tells rows apart and gives their order.

    Ids that are null or repeat are replaced by numbers in order of id and content (nulls first);
    such a table is written, so that the numbers stay the same.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    clash = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null")
    if clash.isEmpty():
        return rows.withColumn("given", F.col("id"))
    ordered = rows.orderBy("id", F.xxhash64("text"), "text").withColumn("number", F.monotonically_increasing_id())
    return written(ordered.select(F.col("number").alias("id"), "text", F.col("id").alias("given")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes, spans (start, end in bytes) and kept (binary) of every row of docs.

    A text is its UTF-8 bytes; null counts as empty. A byte goes if a string of WINDOW bytes
    that covers it also starts earlier: in a document with a smaller id, or in the same one
    further left. Strings are judged on the input, and never cross documents. Rows that repeat an
    id count as documents of their own, in order of their contents; null ids come first. Ids are
    read as long integers; other columns play no part.
    """
    small_batches(docs.sparkSession)
    rows = _numbered(docs, id_col, text_col)
    texts = rows.select("id", "text")
    dealt = texts.mapInArrow(_run_rows, _RUN_SQL).repartition("anchor").sortWithinPartitions("anchor", "content", "more", "id", "place")
    sorted_runs = written(dealt.mapInArrow(_first_runs, _SORTED_SQL))
    whole = sorted_runs.where("anchor is null").select(
        "id", F.shiftright("place", 8).alias("begin"), (F.shiftright("place", 8) + F.shiftright("place", 1).bitwiseAND(F.lit(127)) + WINDOW).alias("end")
    )
    open_runs = sorted_runs.where("anchor is not null")
    asked = open_runs.groupBy("id").agg(F.collect_list(F.struct("anchor", "place")).alias("asked"))
    holders = marked(texts, key_filter(open_runs, F.col("id")), F.col("id"), name="holds").where("holds").select("id", "text")
    fetched = holders.join(asked, "id").mapInArrow(_fetch, _BYTES_SQL)
    hot = _large(open_runs)
    if hot.isEmpty():
        partial = _sorted_repeats(fetched)
    else:
        fetched = written(fetched)
        # written before it is dealt out: keys of many rows leave it in many tasks
        split = written(fetched.join(hot, "anchor", "left_semi").mapInArrow(_split, _BYTES_SQL))
        still = _large(split)
        partial = _sorted_repeats(fetched.join(hot, "anchor", "left_anti").unionByName(split.join(still, "anchor", "left_anti")))
        if not still.isEmpty():
            partial = partial.unionByName(_window_repeats(split.join(still, "anchor", "left_semi")))
    repeats = written(whole.unionByName(partial))
    lists = repeats.groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("repeats"))
    split = marked(rows, key_filter(repeats, F.col("id")), F.col("id"), name="hit")
    empty = F.array().cast("array<struct<begin:long,end:long>>")
    hit = split.where("hit").select("id", "given", "text").join(lists, "id", "left")
    done = hit.select(F.col("given").alias("id"), "text", F.coalesce("repeats", empty).alias("repeats")).mapInArrow(
        _remove, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    clean = split.where(~F.col("hit")).select(
        F.col("given").alias("id"), F.octet_length(raw).cast("long").alias("n_bytes"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"), raw.alias("kept")
    )
    return done.unionByName(clean).withColumnRenamed("id", id_col)
