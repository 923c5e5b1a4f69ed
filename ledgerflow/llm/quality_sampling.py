"""Quality by importance resampling over hashed n-gram models.

Texts are read as words and runs of punctuation; these and their pairs are hashed into ``BUCKETS`` buckets. Two bag models
give the buckets' probabilities: one of the raw corpus, counted over all documents, and one of
the target, counted over documents labelled as good. The weight of a document is the ratio of its
probabilities under both: its log is the sum of the log ratios of all its n-grams. Adding Gumbel
noise to the log weights and taking the k largest sums draws k documents without replacement in
proportion to their weights. The score, which compares documents of all lengths, takes the mean
log ratio as for a text of ``LENGTH`` n-grams.

The target is counted on at most about ``TARGET_ROWS`` labelled documents (chosen by a hash of the
id), whose ids are broadcast; models are fixed vectors of BUCKETS numbers. The k-th largest sum is
found exactly from counts per range of sums, a fixed number of counts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.license_scan import WORD_BYTE
from ledgerflow.llm.shared import small_batches, written
from ledgerflow.llm.textbytes import LOWER, mix, pieces, rows_of, span_hash, spans, string_buffers

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LENGTH = 100
TARGET_ROWS = 20_000
SHARE = 0.5
PRIOR = 200.0
_CELLS = 1 << 12
#: Bytes of punctuation: printing ones of ASCII that stand in no word.
MARK_BYTE = np.zeros(256, bool)
MARK_BYTE[33:127] = True
MARK_BYTE[65:91] = False
MARK_BYTE &= ~WORD_BYTE


def ngram_buckets(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all tokens (words, runs of punctuation) and pairs of them of some texts."""
    data = LOWER[data]
    both = [np.concatenate(x) for x in zip(spans(data, offsets, WORD_BYTE), spans(data, offsets, MARK_BYTE), strict=True)]
    order = np.argsort(both[0], kind="stable")
    start, end = both[0][order], both[1][order]
    word = span_hash(data, start, end)
    row = rows_of(start, offsets)
    same = np.flatnonzero(row[:-1] == row[1:])
    pair = mix(word[same] * np.uint64(3) + word[same + 1])
    bucket = (np.append(word, pair) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    return np.append(row, row[same]), bucket


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, raw, target) of a partition."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        good = batch.column("good").to_numpy(zero_copy_only=False)
        for a, b in pieces(offsets):
            row, bucket = ngram_buckets(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[a:b][row]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])


def _weigh(batches: Iterator[pa.RecordBatch], ratio: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for a, b in pieces(offsets):
            row, bucket = ngram_buckets(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            n[a:b] = np.bincount(row, minlength=b - a)
            total[a:b] = np.bincount(row, weights=ratio[bucket], minlength=b - a)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(total), pa.array(n)], names=["id", "total", "n"])


def log_ratios(docs: DataFrame, is_target: Column) -> np.ndarray:
    """log(target / raw) of every bucket; the target's counts are smoothed with PRIOR n-grams of the raw corpus. BUCKETS rows reach the driver."""
    rows = docs.select("text", F.coalesce(is_target, F.lit(False)).alias("good"))
    counts = rows.mapInArrow(_count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    got = counts.toPandas()
    raw, target = np.full(BUCKETS, 0.01), np.zeros(BUCKETS)
    raw[got["bucket"]] += got["raw"]
    target[got["bucket"]] += got["target"]
    share = raw / raw.sum()
    return np.log((target + PRIOR * share) / (target.sum() + PRIOR)) - np.log(share)


def kth_largest(rows: DataFrame, value: str, k: int) -> float:
    """The k-th largest of a column of finite numbers (k from 1): exact, by narrowing a range _CELLS-fold per pass.

    A range too narrow for cells of its own holds about _CELLS different numbers at most; these are
    counted one by one.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        step = (high - low) / _CELLS
        inside = rows.where(F.col(value).between(low, high))
        fine = low + step > low and high - step < high
        cell = F.least(F.floor((F.col(value) - low) / step), F.lit(_CELLS - 1)).cast("double") if fine else F.col(value)
        cells = inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
        for c in sorted(cells, key=lambda c: -c["low"]):
            if k <= c["n"]:
                low, high = c["low"], c["high"]
                break
            k -= c["n"]
    return low


def quality_sample(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, log_weight, score, gumbel_key and sampled of every row of docs.

    labels has doc_id, quality and toxic; documents with quality 1 that are not labelled toxic are
    the target (several labels of a document: any such one). score is the mean log ratio, times
    LENGTH, squeezed into 0 to 1. sampled marks the ceil(share * rows) largest keys; rows that tie with the last of them
    are marked too. Null and empty texts have log weight 0. Rows that repeat an id share its
    noise. Without any label, all weights follow from the raw corpus alone. Other columns play no
    part; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    small_batches(docs.sparkSession)
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    many = good.count()
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, TARGET_ROWS / max(1, many)))
    good = good.where(chosen).select(F.col("doc_id").alias("good_id"), F.lit(True).alias("is_good"))
    ratio = log_ratios(rows.join(F.broadcast(good), F.col("id") == F.col("good_id"), "left"), F.col("is_good"))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    kind = rows.schema["id"].dataType.simpleString()
    sums = rows.mapInArrow(lambda it: _weigh(it, shared.value), f"id {kind}, total double, n long")
    noise = (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weighed = sums.select(
        "id",
        F.col("total").alias("log_weight"),
        (1 / (1 + F.exp(-LENGTH * F.col("total") / F.greatest("n", F.lit(1))))).alias("score"),
        (F.col("total") - F.log(-F.log(noise))).alias("gumbel_key"),
    )
    weighed = written(weighed)
    n = weighed.count()
    least = kth_largest(weighed, "gumbel_key", -(-int(n * share * 1_000_000) // 1_000_000)) if n else 0.0
    return weighed.select(F.col("id").alias(id_col), "log_weight", "score", "gumbel_key", (F.col("gumbel_key") >= least).alias("sampled"))
