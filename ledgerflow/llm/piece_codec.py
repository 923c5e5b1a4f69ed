"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

Encoding: a text becomes characters with a leading blank, blanks written as U+2581. It is cut
into words at places that no piece of the vocabulary spans, so words are encoded on their own,
and each distinct word of a task once. The symbols of all new words stand in one flat array.
A round looks up the rank of every adjacent pair, takes the smallest rank of each word (a
segmented minimum), merges its pairs of that rank from the left, all words at once, and compacts
the array; words without a mergeable pair leave it. Characters that are no piece become their
UTF-8 bytes.

A word may merge several pairs of its smallest rank in one round only if no pair that arises
ranks before it; otherwise it merges the leftmost alone. That gives the order in which a queue
of single merges would take them.

Decoding joins the pieces' bytes, turns U+2581 into blanks and drops the leading one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import small_batches
from ledgerflow.llm.textbytes import MASK, HashIndex, mix, pieces, ragged, span_hash, string_buffers

BLANK = 0x2581
#: Distinct words that a task remembers before it starts anew.
CACHE_WORDS = 400_000
NO_RANK = np.int32(2**31 - 1)


class Vocabulary:
    """What merging needs of a model: symbols, ranked pairs, byte pieces, and where words may be cut."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        byte = [model.is_byte(i) for i in range(size)]
        normal = {t: i for i, t in enumerate(texts) if not special[i] and not byte[i]}
        self.eos = model.eos_id()
        self.byte_piece = np.zeros(256, np.int32)
        for i in np.flatnonzero(byte):
            self.byte_piece[int(texts[i][3:5], 16)] = i
        self.pieces = size
        symbols = dict(normal)
        for c in sorted({c for t in normal for c in t}):
            symbols.setdefault(c, size + len(symbols) - len(normal))
        self.symbols = size + len(symbols) - len(normal)
        self.symbol_of_char = np.full(0x110000, -1, np.int32)
        for t, i in symbols.items():
            if len(t) == 1:
                self.symbol_of_char[ord(t)] = i
        rank_of = {s: r for r, s in enumerate(sorted({-model.get_score(i) for i in normal.values()}))}
        left, right, to, rank = [], [], [], []
        inner = np.zeros((256, 256), bool)  # does a piece hold this pair of characters?
        solid = np.zeros(0x110000, bool)  # is the character part of a longer piece?
        for t, i in normal.items():
            if len(t) > 1:
                r = rank_of[-model.get_score(i)]
                codes = [ord(c) for c in t]
                solid[codes] = True
                for a, b in zip(codes, codes[1:], strict=False):
                    if a < 256 and b < 256:
                        inner[a, b] = True
                for k in range(1, len(t)):
                    if t[:k] in symbols and t[k:] in symbols:
                        left.append(symbols[t[:k]])
                        right.append(symbols[t[k:]])
                        to.append(i)
                        rank.append(r)
        self.inner, self.solid = inner, solid
        self.blank_inside = any(chr(BLANK) in t.lstrip(chr(BLANK)) for t in normal)
        key = np.array(left, np.int64) * self.symbols + np.array(right, np.int64)
        spread = mix(key.view(np.uint64))  # a bijection
        order = np.argsort(spread)
        self.pair = HashIndex(spread[order])
        self.merged, self.rank = np.append(np.array(to, np.int32)[order], -1), np.append(np.array(rank, np.int32)[order], NO_RANK)
        # what each piece decodes to
        self.text = [
            bytes([int(t[3:5], 16)]) if byte[i] else b"" if model.is_control(i) else b" \xe2\x81\x87 " if model.is_unknown(i) else t.replace(chr(BLANK), " ").encode()
            for i, t in enumerate(texts)
        ]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs of symbols; NO_RANK where no piece is made of them."""
        key = mix((left.astype(np.int64) * self.symbols + right).view(np.uint64))
        at = self.pair.find(key)
        known = (self.pair.sorted[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.rank[at], NO_RANK), self.merged[at]

    def encode_words(self, chars: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, offsets) of words given as flat characters; no word is empty."""
        n = len(offsets) - 1
        symbol = self.symbol_of_char[chars]
        word = np.repeat(np.arange(n), np.diff(offsets))
        origin = np.arange(len(chars))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbol):
            same = word[:-1] == word[1:]
            rank, merged = self.look_up(symbol[:-1], symbol[1:])
            rank[~same] = NO_RANK
            start = np.flatnonzero(np.append(True, ~same))
            least = np.minimum.reduceat(np.append(rank, NO_RANK), start)
            length = np.diff(np.append(start, len(symbol)))
            going = np.repeat(least < NO_RANK, length)
            if not going.all():
                done.append((word[~going], symbol[~going], origin[~going]))
                rank, merged = rank[going[:-1]], merged[going[:-1]]
                symbol, word, origin = symbol[going], word[going], origin[going]
                if not len(symbol):
                    break
                rank, merged = rank[: len(symbol) - 1], merged[: len(symbol) - 1]
                length, least = length[least < NO_RANK], least[least < NO_RANK]
            floor = np.repeat(least, length)
            chosen = np.append(rank == floor[:-1], False)
            merged = np.append(merged, -1)
            # of pairs that overlap, every second one from the left
            at = np.flatnonzero(chosen)
            fresh = np.append(True, np.diff(at) != 1)
            run = np.cumsum(fresh) - 1
            keep = (np.arange(len(at)) - np.flatnonzero(fresh)[run]) % 2 == 0
            at = at[keep]
            take = np.zeros(len(symbol), bool)
            take[at] = True
            # does a pair that arises rank before the one just merged, or equal and further left?
            first = np.append(True, word[at[1:]] != word[at[:-1]])
            if not first.all():
                m = merged[at]
                after = np.minimum(at + 2, len(symbol) - 1)
                ranks_right = np.where((at + 2 < len(symbol)) & (word[after] == word[at]), self.look_up(m, symbol[after])[0], NO_RANK)
                joined = (at >= 2) & take[np.maximum(at - 2, 0)]
                before = np.where(joined, merged[np.maximum(at - 2, 0)], symbol[np.maximum(at - 1, 0)])
                ranks_left = np.where((at >= 1) & (word[np.maximum(at - 1, 0)] == word[at]), self.look_up(before, m)[0], NO_RANK)
                early = np.minimum(ranks_left, ranks_right) <= floor[at]
                hasty = np.zeros(n, bool)
                hasty[word[at[early]]] = True
                at = at[first | ~hasty[word[at]]]
                take[:] = False
                take[at] = True
            symbol[at] = merged[at]
            left = ~np.append(False, take[:-1])
            symbol, word, origin = symbol[left], word[left], origin[left]
        if not done:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        word, symbol, origin = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(origin)
        word, symbol, origin = word[order], symbol[order], origin[order]
        plain = (symbol >= 0) & (symbol < self.pieces)
        count = np.ones(len(symbol), np.int64)
        odd = np.flatnonzero(~plain)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars[origin[odd]]]
        count[odd] = [len(b) for b in raw]
        out = np.repeat(np.where(plain, symbol, 0).astype(np.int32), count)
        place = np.cumsum(count) - count
        if len(odd):
            data = np.frombuffer(b"".join(raw), np.uint8)
            inside = np.arange(len(data)) - np.repeat(np.cumsum(count[odd]) - count[odd], count[odd])
            out[np.repeat(place[odd], count[odd]) + inside] = self.byte_piece[data]
        sizes = np.bincount(word, weights=count, minlength=n).astype(np.int64)
        return out, np.append(0, np.cumsum(sizes))


class Encoder:
    """Encodes pieces of a column; keeps the distinct words seen so far, found by their hashes.

    A word counts as known only if its characters are those of the word kept under its hash; one
    that merely shares a hash is encoded anew wherever it stands.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.known = HashIndex(np.zeros(0, np.uint64))
        self.place = np.zeros(0, np.int64)  # their words' numbers
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.letters = np.zeros(0, np.int32)  # the words themselves, and where each ends
        self.ends = np.zeros(0, np.int64)

    def _add(self, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Encode some words and keep them; their numbers."""
        new = chars[ragged(starts, lengths)]
        ids, offsets = self.vocabulary.encode_words(new, np.append(0, np.cumsum(lengths)))
        numbers = len(self.offsets) - 1 + np.arange(len(starts))
        self.offsets = np.append(self.offsets, offsets[1:] + len(self.ids))
        self.ids = np.append(self.ids, ids)
        self.ends = np.append(self.ends, len(self.letters) + np.cumsum(lengths))
        self.letters = np.append(self.letters, new)
        return numbers

    def _learn(self, hashes: np.ndarray, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        place = np.append(self.place, self._add(chars, starts, lengths))
        known = np.append(self.known.sorted[:-1], hashes)
        order = np.argsort(known)
        self.known, self.place = HashIndex(known[order]), place[order]

    def _mistaken(self, word: np.ndarray, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which words (of known numbers; they follow each other in chars) are not the words kept under these numbers."""
        kept = np.diff(np.append(0, self.ends))[word]
        wrong = kept != lengths
        begin = self.ends[word] - kept
        if not wrong.any():
            same = self.letters[ragged(begin, lengths)] == chars
            return np.flatnonzero(~np.logical_and.reduceat(same, starts))
        right = np.flatnonzero(~wrong)
        if len(right):
            n = lengths[right]
            same = self.letters[ragged(begin[right], n)] == chars[ragged(starts[right], n)]
            wrong[right] = ~np.logical_and.reduceat(same, np.cumsum(n) - n)
        return np.flatnonzero(wrong)

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts; every text ends with the end id."""
        v = self.vocabulary
        n = len(offsets) - 1
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int32)
        begins = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]  # in characters
        full = np.flatnonzero(np.diff(begins) > 0)
        chars = np.insert(np.where(chars == 32, BLANK, chars), begins[:-1][full], BLANK)
        begins = begins + np.append(0, np.cumsum(np.diff(begins) > 0))
        counts = np.zeros(n, np.int64)
        if not len(chars):
            return np.full(n, v.eos, np.int32), np.arange(n + 1)
        a, b = chars[:-1], chars[1:]
        cut = np.empty(len(chars), bool)
        cut[0] = True
        if v.blank_inside:
            cut[1:] = False
        else:
            cut[1:] = (b == BLANK) & (a != BLANK)
        low = (a < 256) & (b < 256)
        cut[1:] |= low & ~v.inner[a & 255, b & 255]
        loose = ~v.solid[chars]
        cut[1:] |= loose[1:] | loose[:-1]
        cut[begins[:-1][full]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(chars))
        hashes = np.minimum(span_hash(chars.view(np.uint8), 4 * starts, 4 * ends), np.uint64(MASK - 1))  # MASK ends the index
        at = self.known.find(hashes)
        unknown = self.known.sorted[at] != hashes
        if unknown.any():
            if len(self.ends) > CACHE_WORDS:
                self._forget()
                unknown[:] = True
            which = np.flatnonzero(unknown)
            fresh, first = np.unique(hashes[which], return_index=True)
            first = which[first]
            self._learn(fresh, chars, starts[first], (ends - starts)[first])
            at = self.known.find(hashes)
        word = self.place[at]
        other = self._mistaken(word, chars, starts, ends - starts)
        if len(other):
            word[other] = self._add(chars, starts[other], (ends - starts)[other])
        length = self.offsets[word + 1] - self.offsets[word]
        counts[full] = np.add.reduceat(length, np.searchsorted(starts, begins[:-1][full]))
        out_offsets = np.append(0, np.cumsum(counts + 1))
        out = np.full(out_offsets[-1], v.eos, np.int32)
        inside = np.ones(len(out), bool)
        inside[out_offsets[1:] - 1] = False
        out[inside] = self.ids[ragged(self.offsets[word], length)]
        return out, out_offsets


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary)
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        for a, b in pieces(offsets):
            ids, at = encoder.encode(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), lists], names=["key", "ids"])


class Decoder:
    def __init__(self, text: list[bytes], size: int):
        self.size = size
        self.texts = pa.array(text, pa.large_binary())

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of lists of ids; ids outside the vocabulary decode to nothing."""
        known = (ids >= 0) & (ids < self.size)
        if not known.all():
            ids = np.where(known, ids, 1 << 30)
        got = self.texts.take(pa.array(np.where(known, ids, 0)))
        if not known.all():
            got = pc.if_else(pa.array(known), got, pa.scalar(b"", pa.large_binary()))
        at, data = string_buffers(got)
        bounds = at[offsets]
        first = bounds[:-1][np.diff(bounds) > 0]
        # the blank that encoding has put in front
        lead = first[data[first] == 32]
        keep = np.ones(len(data), bool)
        keep[lead] = False
        gone = np.append(0, np.cumsum(~keep))
        bounds, data = bounds - gone[bounds], data[keep]
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # byte pieces that make no character
            return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


def _decode(batches: Iterator[pa.RecordBatch], text: list[bytes]) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(text, len(text))
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy().astype(np.int64)
        for a, b in pieces(offsets, 1 << 18):
            flat = ids.values.to_numpy()[offsets[a] : offsets[b]]
            texts = decoder.decode(offsets[a : b + 1] - offsets[a], flat)
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), ids.slice(a, b - a), texts], names=["key", "ids", "text"])


def round_trip(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids and decoded text of every row of docs: encode and decode in one pass over the batches."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_file))
    kind = rows.schema["key"].dataType.simpleString()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode(_encode(batches, shared.value), shared.value.text)

    out = rows.mapInArrow(both, f"key {kind}, ids array<int>, text string")
    return out.select(F.col("key").alias(key), "ids", "text")


def encode(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ids of every row of docs, as the library encodes it with an end id and no sampling.

    Null and empty texts give the end id alone. Repeated rows stay; other columns play no part.
    The vocabulary (a model's size, whatever the table's) is broadcast.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_file))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(lambda it: _encode(it, shared.value), f"key {kind}, ids array<int>")
    return out.select(F.col("key").alias(key), "ids")


def decode(encoded: DataFrame, model_file: str, key: str = "doc_id") -> DataFrame:
    """key, ids and text of rows of ids: the inverse of encode.

    A null list decodes to an empty text and comes back empty; ids outside the vocabulary and
    control ids decode to nothing.
    """
    rows = encoded.select(F.col(f"`{key}`").alias("key"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model_file).text)
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(lambda it: _decode(it, shared.value), f"key {kind}, ids array<int>, text string")
    return out.select(F.col("key").alias(key), "ids", "text")
