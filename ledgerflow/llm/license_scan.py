"""License scans by diagonal voting.

Every text is read as words. A Spark join of all its rolling word k-grams with those of the
templates gives matches (position in the text, position in the template). Their
difference is the diagonal: a place where a template stands word for word gives one vote per
gram, all on one diagonal; inserted or left-out words move the rest to a neighbouring one.
Votes are collected per diagonal, neighbouring diagonals are merged, and a span counts when
enough of the template's grams were found in it, each counted once. Templates of up to LONG_WORDS
words vote with pairs, whole license texts with grams of LONG_GRAM words, so that common pairs of
words do not fill the join. A gram is joined on a 64-bit hash and held
against a second, independent hash, so a vote stands for equal words.

The templates are a fixed table of some hundred grams; it is all that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.shared import small_batches
from ledgerflow.llm.textbytes import LOWER, SEED2, counts_by_row, mix, pieces, rows_of, span_hash, spans, string_buffers

#: Phrases of the contract and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Longer wordings of public licenses and their labels; inexact places count too.
WORDINGS = {
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
#: Whole license texts and notices (words only, in lower case) and their labels; inexact places count too.
LICENSE_TEXTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the "
    "software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall "
    "be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for "
    "any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
    "dealings in the software": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
    "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
    "basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under "
    "the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
    "foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any "
    "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should "
    "have received a copy of the gnu general public license along with this program if not see": "gpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and "
    "this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages "
    "whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the "
    "use or performance of this software": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of "
    "source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is "
    "provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect "
    "incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or "
    "business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any "
    "way out of the use of this software even if advised of the possibility of such damage": "bsd",
}
#: Templates of more words vote with longer grams.
LONG_WORDS, LONG_GRAM = 64, 4
#: Votes are held as bits of 64-bit numbers, one number for so many places of a template.
MASK_BITS = 64
#: Share of a wording's grams that a span must hold, and how far diagonals may lie apart to be merged.
COVERAGE, NEIGHBOUR = 0.8, 2
GRAM = 2


def template_list() -> list[tuple[str, str, int]]:
    """(words, label, words of a gram) of all templates, the phrases of the contract first."""
    every = [*PHRASES.items(), *WORDINGS.items(), *LICENSE_TEXTS.items()]
    return [(text, label, LONG_GRAM if len(text.split()) > LONG_WORDS else GRAM) for text, label in every]


#: Bytes of words: 0-9, a-z (after lower-casing) and all bytes of characters beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


def _gram_hashes(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...] = (GRAM, LONG_GRAM)) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
    """(words by row; row, position, hash and second hash of all rolling word grams of each size within rows)."""
    data = LOWER[data]
    start, end = spans(data, offsets, WORD_BYTE)
    words = counts_by_row(start, offsets)
    one = span_hash(data, start, end)
    two = span_hash(data, start, end, SEED2)
    row = rows_of(start, offsets)
    base = np.cumsum(words) - words
    out = []
    for size in sizes:
        n = max(0, len(start) - size + 1)
        same = np.flatnonzero(row[:n] == row[size - 1 :]) if n else np.zeros(0, np.int64)
        first = np.zeros(len(same), np.uint64)
        second = first.copy()
        for k in range(size):
            first = mix(first * np.uint64(3) + one[same + k])
            second = mix(second * np.uint64(5) + two[same + k])
        out.append((row[same], same - base[row[same]], first.view(np.int64), second.view(np.int64)))
    return words, out


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, key, position, hash, second); one more per text with position -1, its key and number of words."""
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        row, key = batch.column("row").to_numpy(), batch.column("key")
        for a, b in pieces(offsets):
            own = offsets[a : b + 1] - offsets[a]
            words, grams = _gram_hashes(data[offsets[a] : offsets[b]], own)
            of, at, first, second = (np.concatenate(x) for x in zip(*grams, strict=True))
            n = b - a
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([row[a:b], row[a:b][of]])),
                    pa.concat_arrays([key.slice(a, n), pa.nulls(len(of), key.type)]),
                    pa.array(np.concatenate([np.full(n, -1), at]).astype(np.int32)),
                    pa.array(np.concatenate([np.zeros(n, np.int64), first])),
                    pa.array(np.concatenate([words, second]).astype(np.int64)),
                ],
                names=["row", "key", "position", "hash", "second"],
            )


def templates(spark: SparkSession) -> DataFrame:
    """Grams of all templates: t_hash, t_second, template, t_position. The table is fixed."""
    rows = []
    for number, (text, _, size) in enumerate(template_list()):
        data = np.frombuffer(text.encode(), np.uint8)
        _, [(_, at, first, second)] = _gram_hashes(data, np.array([0, len(data)]), (size,))
        rows += [(int(h), int(s), number, int(p)) for p, h, s in zip(at, first, second, strict=True)]
    return spark.createDataFrame(rows, "t_hash long, t_second long, template int, t_position int")


def _per_template(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])[F.col("template")]


def license_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified spans and one row per text: row, key, template, label, first, last, coverage, n_words.

    The row with template -1 carries the key of a text and its number of words (null text: 0)
    and nothing else; ``row`` tells the rows of docs apart, even where they repeat. Phrases of the contract count
    at every place where their words stand consecutively (coverage 1), wordings and whole texts at every merged
    span with at least COVERAGE of their grams. first and last are word positions: the smallest
    and largest start of the diagonals in the span.
    """
    spark = docs.sparkSession
    every = template_list()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    small_batches(spark)
    kind = rows.schema["key"].dataType.simpleString()
    grams = rows.mapInArrow(_grams, f"row long, key {kind}, position int, hash long, second long")
    met = grams.join(F.broadcast(templates(spark)), (F.col("hash") == F.col("t_hash")) & (F.col("second") - F.col("t_second") == 0), "left")
    met = met.where(F.col("template").isNotNull() | (F.col("position") < 0))
    voted = met.select(
        "row",
        "key",
        F.coalesce("template", F.lit(-1)).alias("template"),
        F.when(F.col("position") < 0, -1).otherwise(F.col("position") - F.col("t_position")).alias("diagonal"),
        F.when(F.col("position") < 0, F.col("second")).alias("n_words"),
        F.expr(f"coalesce(t_position, 0) div {MASK_BITS}").alias("part"),
        F.expr(f"shiftleft(1L, coalesce(t_position, 0) % {MASK_BITS})").alias("vote"),
    )
    diagonals = voted.groupBy("row", "template", "diagonal", "part").agg(F.bit_or("vote").alias("votes"), F.max("n_words").alias("n_words"), F.max("key").alias("key"))
    grams_of = _per_template([len(text.split()) - size + 1 for text, _, size in every])
    phrase = F.col("template") < len(PHRASES)
    by = Window.partitionBy("row", "template").orderBy("diagonal", "part")
    step = F.col("diagonal") - F.lag("diagonal").over(by)
    same_span = F.coalesce(F.when(phrase, step == 0).otherwise(step <= NEIGHBOUR), F.lit(False))
    diagonals = diagonals.repartition("row").withColumn("fresh", F.when(same_span, 0).otherwise(1))
    diagonals = diagonals.withColumn("span", F.sum("fresh").over(by))
    kept_of = (F.max("n_words").alias("n_words"), F.max("key").alias("key"))
    parts = diagonals.groupBy("row", "template", "span", "part").agg(F.bit_or("votes").alias("votes"), *kept_of, F.min("diagonal").alias("first"), F.max("diagonal").alias("last"))
    merged = parts.groupBy("row", "template", "span").agg(F.sum(F.bit_count("votes")).alias("found"), *kept_of, F.min("first").alias("first"), F.max("last").alias("last"))
    marker = F.col("template") < 0
    coverage = F.col("found") / grams_of
    exact = F.col("found") == grams_of
    kept = merged.where(marker | F.when(phrase, exact).otherwise(coverage >= COVERAGE))
    label = _per_template([label for _, label, _ in every])
    return kept.select(
        "row",
        "key",
        "template",
        F.when(~marker, label).alias("label"),
        F.when(~marker, F.col("first")).alias("first"),
        F.when(~marker, F.col("last")).alias("last"),
        F.when(~marker, coverage).alias("coverage"),
        "n_words",
    )


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no labels (empty strings, score 0). Rows that repeat
    a key stay rows of their own. Other columns play no part. score is the largest coverage of
    a span.
    """
    found = license_spans(docs, key, text)
    base = (F.col("template") >= 0) & (F.col("template") < len(PHRASES))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    out = found.groupBy("row").agg(
        F.max("key").alias(key),
        F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
    )
    return out.drop("row")
