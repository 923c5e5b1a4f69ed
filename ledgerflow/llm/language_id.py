"""Language identification by prediction by partial matching (PPM).

One byte context tree per language with contexts of 0 to ``ORDER`` bytes. The statistics
are frozen after training. A byte costs -log2 of its share in the longest context that has
seen it; each longer context that has not seen it first costs its escape (method C: as
likely as its number of distinct successors). A text gets the language whose tree encodes
it in the fewest bits.

The trees of all languages share one set of nodes: ``child[m][node, byte]`` leads from an
m-byte string to the m+1-byte string, so the nodes of all positions of a text come from
``ORDER`` array look-ups, whatever the number of languages.

Training uses a sample of the labelled rows of about ``SAMPLE_BYTES`` bytes per language
(whole texts, chosen by a hash of the id in proportion to the language's size); that bounds
the model. Prediction reads every text in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import small_batches
from ledgerflow.llm.textbytes import LOWER, pieces, string_buffers

ORDER = 3
SAMPLE_BYTES = 2_000_000
UNDETERMINED = "und"
_PIECE = 1 << 18


def _shifted(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """values of the position before, 0 at the start of each text."""
    out = np.empty_like(values)
    out[0] = 0
    out[1:] = values[:-1]
    out[starts] = 0
    return out


def _gram_counts(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """(lang, size, gram, n) for every string of 1 to order + 1 bytes."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for lang in table["lang"].unique().to_pylist():
            mask = pc.equal(table["lang"], lang)
            offsets, data = string_buffers(table.filter(mask)["text"])
            if not len(data):
                continue
            data = LOWER[data].astype(np.int64)
            starts = offsets[:-1][np.diff(offsets) > 0]
            since = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
            code = np.zeros(len(data), np.int64)
            for m in range(1, order + 2):
                code = data.copy() if m == 1 else np.append(0, code[:-1]) * 256 + data
                grams, n = np.unique(code[since >= m - 1], return_counts=True)
                if len(grams):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams)), pa.array(np.full(len(grams), m, np.int32)), pa.array(grams), pa.array(n.astype(np.int64))],
                        names=["lang", "size", "gram", "n"],
                    )


class PpmModel:
    """Frozen trees: languages, child[m], cost[m][node, language], escape[m][node, language]."""

    def __init__(self, languages: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], order: int):
        """counts[m]: arrays (language number, gram, n) of the m-byte strings."""
        self.languages, self.order = languages, order
        k = len(languages)
        below = np.zeros(0, np.int64)  # grams one byte shorter, sorted; node i + 1 is the i-th
        self.child, self.cost, self.escape = [], [], []
        for m in range(1, order + 2):
            lang, gram, n = counts.get(m, (np.zeros(0, np.int64),) * 3)
            here = np.unique(gram)
            context = np.searchsorted(below, here >> 8) + 1 if m > 1 else np.zeros(len(here), np.int64)
            child = np.zeros((len(below) + 1, 256), np.int32)
            child[context, here & 255] = np.arange(1, len(here) + 1)
            seen = np.zeros((len(here), k))
            seen[np.searchsorted(here, gram), lang] = n
            total, distinct = np.zeros((len(below) + 1, k)), np.zeros((len(below) + 1, k))
            np.add.at(total, context, seen)
            np.add.at(distinct, context, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2(total + distinct) - np.log2(distinct), 0.0)
                own = np.log2(total + distinct)[context] - np.log2(seen)
            if m == 1:
                shorter = np.full((len(here), k), 8.0)
            else:
                shorter = self.cost[-1][np.searchsorted(below, here & ((1 << 8 * (m - 1)) - 1)) + 1]
            cost = np.zeros((len(here) + 1, k))
            cost[1:] = np.where(seen > 0, own, escape[context] + shorter)
            self.child.append(child)
            self.cost.append(cost)
            self.escape.append(escape)
            below = here

    def bits(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Exact code length of each text under each language: shape (texts, languages)."""
        texts, k = len(offsets) - 1, len(self.languages)
        out = np.zeros((texts, k))
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if not len(data) or not k:
            return out
        data, starts = LOWER[data], offsets[:-1][filled]
        nodes, before = [self.child[0][0][data]], []
        for m in range(1, self.order + 1):
            before.append(_shifted(nodes[-1], starts))
            nodes.append(self.child[m][before[-1], data])
        top = self.order
        total = self.cost[top][nodes[top]]
        left = np.flatnonzero(nodes[top] == 0)
        for m in range(top, -1, -1):
            if not len(left):
                break
            if m < top:
                total[left] += self.cost[m][nodes[m][left]]
                left = left[nodes[m][left] == 0]
            if m > 0:  # a context that no language has seen has no node and costs nothing
                known = before[m - 1][left]
                total[left] += np.where((known > 0)[:, None], self.escape[m][known], 0.0)
            else:
                total[left] += self.escape[0][0] + 8.0
        out[filled] = np.add.reduceat(total, starts, axis=0)
        return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> PpmModel:
    """Train on the rows of labelled with a text and a language.

    Rows with a null language, or with a null or empty text, teach nothing. With nothing to
    learn from, the model has no language. One row per language and per distinct string of
    the sample reaches the driver.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("key"))
    rows = rows.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    sizes = {r["lang"]: r["bytes"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()}
    languages = sorted(sizes)
    if not languages:
        return PpmModel([], {}, order)
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, F.lit(min(1.0, sample_bytes / sizes[name]))).otherwise(share)
    sample = rows.where(F.pmod(F.col("key"), F.lit(1 << 30)) / float(1 << 30) < share).select("lang", "text")
    counts = sample.mapInArrow(lambda it: _gram_counts(it, order), "lang string, size int, gram long, n long")
    got = counts.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).toPandas()
    number = got["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)
    by_size = {
        m: (number[at], got["gram"].to_numpy(np.int64)[at], got["n"].to_numpy(np.int64)[at])
        for m in range(1, order + 2)
        for at in [(got["size"] == m).to_numpy()]
    }
    return PpmModel(languages, by_size, order)


def _label(batches: Iterator[pa.RecordBatch], model: PpmModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        letters = batch.column("letters").to_numpy(zero_copy_only=False)
        n, k = batch.num_rows, len(model.languages)
        best, score = np.full(n, k), np.zeros(n)
        if k:
            for a, b in pieces(offsets, _PIECE):
                bits = model.bits(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
                best[a:b] = bits.argmin(axis=1)
                score[a:b] = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
            best[~letters], score[~letters] = k, 0.0
        names = pa.array([*model.languages, UNDETERMINED])
        rest = [c for c in batch.schema.names if c not in ("text", "letters")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), names.take(pa.array(best)), pa.array(score)], names=[*rest, "lang_pred", "score"])


def predict(docs: DataFrame, model: PpmModel, text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``keep`` with lang_pred and score for every row of docs.

    lang_pred is ``und`` with score 0 where the text is null or has no letter (and always, if
    the model has no language). Otherwise score is the posterior probability of lang_pred with
    all languages equally likely before. Equal code lengths go to the first name.
    """
    spark = docs.sparkSession
    keep = keep or {"doc_id": F.col("doc_id")}
    rows = docs.select(
        *[c.alias(n) for n, c in keep.items()],
        F.col(text).alias("text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = rows.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(lambda it: _label(it, shared.value), f"{fields}, lang_pred string, score double")


def accepted(docs: DataFrame, model: PpmModel, text: str = "text") -> DataFrame:
    """docs without the rows whose language is undetermined; columns as they are."""
    keep = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    out = predict(docs, model, text, keep).where(F.col("lang_pred") != UNDETERMINED)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
