"""Runs of repeating words, by a sparse dynamic program over diagonals.

A diagonal holds the places of a text one lag apart; a word that equals the word one lag before
adds to the match length of its diagonal. A run of period q and exponent e is a match of
(e - 1) q words on diagonal q. Following every earlier occurrence of every word takes the square of
its count, so a word looks back from contexts that double:

* In the round of contexts of L words, each word has one diagonal at most: the lag to the latest
  earlier place with the same L words up to there. It counts if L / 2 < lag <= L.
* That loses nothing: within a run of smallest period q <= L, a context of L words comes again after
  q words and never sooner (a primitive word does not lie in its own square but at both ends), and
  with an exponent of 3 and more such contexts exist. Neighbouring words on one diagonal grow its
  match; where the diagonal ends, a match that is long enough is a run, and its period is the smallest.
* Only words whose context came before go on to contexts of 2 L, so rounds shrink with what repeats.

Words are told apart by their bytes; contexts by exact pairs of numbers of shorter ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import small_batches
from ledgerflow.llm.textbytes import FACTOR, mix, pieces, ragged, rows_of, span_hash, spans, string_buffers

#: A run has at least this many words, and at least this many periods.
MIN_WORDS, MIN_EXPONENT = 6, 4
#: Bytes that part words: the blank and 0x09 to 0x0D.
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False


def numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): places sorted by key and place, and which of them have the key of the one before."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    return order, np.append(False, sorted_key[1:] == sorted_key[:-1]) if len(key) else np.zeros(0, bool)


def word_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """numbered() of the words, words of different rows being different."""
    key = mix(span_hash(data, start, end) + row.astype(np.uint64) * np.uint64(FACTOR))
    order, same = numbered(key)
    later = np.flatnonzero(same)
    a, b = order[later - 1], order[later]
    size = end - start
    alike = (row[a] == row[b]) & (size[a] == size[b])
    if alike.all() and len(a):
        equal = data[ragged(start[a], size[a])] == data[ragged(start[b], size[a])]
        alike = np.logical_and.reduceat(equal, np.cumsum(size[a]) - size[a])
    if alike.all():
        return order, same
    raw, seen = data.tobytes(), {}  # two words share a hash: tell all words of the piece by themselves
    exact = [seen.setdefault((r, raw[x:y]), len(seen)) for r, x, y in zip(row.tolist(), start.tolist(), end.tolist(), strict=True)]
    return numbered(np.array(exact, np.int64))


def find_runs(order: np.ndarray, same: np.ndarray, row: np.ndarray, exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, smallest period) of all runs; order and same number the words, row ascends.

    exponent must be at least 3: shorter runs need not hold a context that names their period.
    """
    n = len(row)
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not found this way")
    words = np.bincount(row) if n else np.zeros(0, np.int64)
    place = np.arange(n)  # of those words that are left
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    context = 1
    while len(order):
        later = np.flatnonzero(same)
        lag = np.zeros(len(order), np.int64)
        lag[order[later]] = place[order[later]] - place[order[later - 1]]
        near = np.flatnonzero((2 * lag > context) & (lag <= context))
        if len(near):
            at, d = place[near], lag[near]
            fresh = np.append(True, (at[1:] != at[:-1] + 1) | (d[1:] != d[:-1]))
            first = np.flatnonzero(fresh)
            last = at[np.append(first[1:], len(at)) - 1]
            d = d[first]
            begin = at[first] - context + 1 - d
            length = last - begin + 1
            long = length >= np.maximum(MIN_WORDS, exponent * d)
            out.append((begin[long], length[long], d[long]))
        # contexts that came more than once, in rows that can hold a run of the next periods
        twice = same | np.append(same[1:], False)
        rank = np.full(n, -1, np.int64)
        rank[place[order[twice]]] = np.cumsum(~same)[twice]
        rank[words[row] < exponent * (context + 1)] = -1
        place = np.flatnonzero(rank[context:] >= 0) + context
        place = place[(rank[place - context] >= 0) & (row[place - context] == row[place])]
        order, same = numbered(rank[place - context] * (n + 1) + rank[place])
        context *= 2
    if not out:
        return (np.zeros(0, np.int64),) * 3
    begin, length, period = (np.concatenate(x) for x in zip(*out, strict=True))
    by = np.lexsort((period, begin))
    return begin[by], length[by], period[by]


def collapsed(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the rows' words joined by blanks, without those behind the first period of a run."""
    begin, length, period = runs
    depth = np.bincount(begin + period, minlength=len(row) + 1) - np.bincount(begin + length, minlength=len(row) + 1)
    keep = np.flatnonzero(np.cumsum(depth)[: len(row)] == 0)
    size = end[keep] - start[keep]
    blank = np.append(row[keep][1:] == row[keep][:-1], False).astype(np.int64) if len(keep) else np.zeros(0, np.int64)
    to = np.append(0, np.cumsum(size + blank))
    out = np.full(to[-1], 0x20, np.uint8)
    out[ragged(to[:-1], size)] = data[ragged(start[keep], size)]
    return out, to[np.searchsorted(row[keep], np.arange(rows + 1))]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every, raw = string_buffers(batch.column("text"))
        for a, b in pieces(every):
            offsets, data = every[a : b + 1] - every[a], raw[every[a] : every[b]]
            start, end = spans(data, offsets, WORD)
            row = rows_of(start, offsets)
            runs = find_runs(*word_numbers(data, start, end, row), row)
            first = np.searchsorted(row, np.arange(b - a + 1))  # word of each row
            text, bounds = collapsed(data, start, end, row, b - a, runs)
            begin, length, period = runs
            of = row[begin]
            numbers = pa.StructArray.from_arrays([pa.array(x) for x in (begin - first[of], length, period)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32)), numbers)
            texts = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(text.tobytes())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), pa.array(np.diff(first)), lists, texts], names=["key", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, runs (start, length, period by start and period) and collapsed text of every row of docs.

    Words are stretches without blanks and 0x09 to 0x0D. A run is a stretch of words with its
    smallest period q, as long as it can be, of at least 6 words and 4 q words. The collapsed text has the
    words, joined by blanks, that stand in no run behind its first q words. Null and empty texts
    have no words, no runs and an empty collapsed text. Repeated rows stay, as do nulls in key;
    other columns play no part. Memory is bounded by a piece of 1 MB or the longest text.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(_runs, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.select(F.col("key").alias(key), "n_words", "runs", "collapsed")
