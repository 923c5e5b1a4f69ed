"""Byte-level BPE encoding and decoding with a backtracking encoder.

A text is cut into words by the vocabulary's pattern (contractions, letters, digits, other signs,
white space), worked out from the classes of its characters for a whole piece of a column at once.
Each distinct word of a piece is encoded once, and words of the last pieces are remembered.

Encoding a word takes no merges. An Aho-Corasick automaton of the reversed tokens reads the word
from its end and gives the longest token that starts at each byte. From the left, the longest
token is taken whose pair with the token before it is *compatible*: both come out side by side when
the merges run over the two. Where none is, the last token is given up for a shorter one, and the
place where it ended is never tried again: a start of the word has one encoding at most. So the
result is that of the merges, in time linear in the word.

Whether a pair is compatible is told by taking its merges back, the later one first: the tokens
would have been joined if, at some moment, the two that met at the border had a merge of their own
that came before the next one to be taken back. Answers are kept in a table.

Decoding gathers the tokens' bytes from one flat array by a table of offsets.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from ledgerflow.llm.shared import small_batches
from ledgerflow.llm.textbytes import pieces, ragged, span_hash, string_buffers

#: Distinct words, and pairs of tokens, that a task remembers before it starts anew.
CACHE_WORDS, CACHE_PAIRS = 400_000, 2_000_000
#: Longer words are read without a list of all tokens found in them.
LONG_WORD = 4096
LETTER, DIGIT, SPACE, OTHER, UNSEEN = range(5)
#: The pattern's contractions: an apostrophe and these.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
NO_TOKEN = -1


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, the merge that makes each, and which of them can come out of the merges at all.

    Only byte-level vocabularies are taken whose merges each make a token of their own from
    tokens made before; others raise a ValueError, as the backtracking encoder needs that.
    """

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec["pre_tokenizer"]
        plain_model = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        plain_cutter = cutter and cutter["type"] == "ByteLevel" and cutter.get("use_regex", True) and not cutter["add_prefix_space"]
        if not plain_model or not plain_cutter or spec.get("normalizer"):
            raise ValueError(f"{file} is no plain byte-level BPE vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in what stands beside them are not supported")
        letter = byte_letters()
        self.added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *self.added.values()])
        self.tokens: list[bytes | None] = [None] * size
        for text, i in model["vocab"].items():
            self.tokens[i] = bytes(letter[c] for c in text)
        number = model["vocab"]
        self.left, self.right, self.made = [NO_TOKEN] * size, [NO_TOKEN] * size, [NO_TOKEN] * size
        self.rank: dict[tuple[int, int], int] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            i, left, right = number[a + b], number[a], number[b]
            if self.made[i] != NO_TOKEN or len(self.tokens[i]) < 2 or any(len(self.tokens[x]) > 1 and self.made[x] == NO_TOKEN for x in (left, right)):
                raise ValueError(f"merge {r} makes no token of its own from tokens made before")
            self.left[i], self.right[i], self.made[i], self.rank[left, right] = left, right, r, r
        self.reachable = [t is not None and len(t) == 1 for t in self.tokens]
        if sum(self.reachable) != 256:
            raise ValueError("not every byte is a token")
        for i in sorted((i for i in range(size) if self.made[i] != NO_TOKEN), key=self.made.__getitem__):
            a, b = self.left[i], self.right[i]
            self.reachable[i] = self.reachable[a] and self.reachable[b] and self.compatible(a, b, self.made[i])
        id_of = {self.tokens[i]: i for i in range(size) if self.reachable[i]}
        #: The longest token that is a proper start of a token.
        self.shorter = [NO_TOKEN] * size
        for text, i in id_of.items():
            self.shorter[i] = next((id_of[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in id_of), NO_TOKEN)
        for text, i in self.added.items():
            self.tokens[i] = text
        texts = [t or b"" for t in self.tokens]
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.append(0, np.cumsum([len(t) for t in texts]))

    def compatible(self, a: int, b: int, bound: float = float("inf")) -> bool:
        """Do tokens a and b stay apart when the merges of ranks below bound run over both?

        Of two merges of one rank the left one comes first, so b's last is taken back before a's, and
        a merge across the border comes before one of the same rank in b, but after one in a.
        """
        made, rank = self.made, self.rank
        while True:
            across = rank.get((a, b))
            if across is not None and across < bound:
                return False
            if made[a] > made[b]:
                bound = made[a]
                a = self.right[a]
            elif made[b] != NO_TOKEN:
                bound = made[b] + 1
                b = self.left[b]
            else:
                return True


class Encoder:
    """Encodes words and pieces of a column; remembers words and pairs."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for i, text in enumerate(v.tokens):
            if v.reachable[i]:
                self.automaton.add_word(text[::-1].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.length = np.diff(v.offsets).tolist()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[bytes, tuple[int, ...]] = {}
        self.kind = np.full(0x110000, UNSEEN, np.uint8)
        self.cutter = ByteLevel(add_prefix_space=False)
        self.added = re.compile(b"|".join(re.escape(t) for t in sorted(v.added, key=len, reverse=True))) if v.added else None

    def longest(self, word: bytes) -> list[int]:
        """The longest token that starts at each byte of a word.

        The automaton names the tokens that end at a place of the reversed word from the longest on,
        and at least the byte itself.
        """
        found = self.automaton.iter(word[::-1].decode("latin-1"))
        if len(word) <= LONG_WORD:
            return list(dict(reversed(list(found))).values())  # the first of each place, last place first
        out = array("i", bytes(4 * len(word)))
        before, last = -1, len(word) - 1
        for end, token in found:
            if end != before:
                out[last - end] = token
                before = end
        return out

    def encode_word(self, word: bytes) -> list[int]:
        """The tokens that the merges make of a word."""
        longest, shorter, length, pairs = self.longest(word), self.vocabulary.shorter, self.length, self.pairs
        token = longest[0]
        size, at = len(word), length[token]
        if at == size:
            return [token]
        if len(pairs) > CACHE_PAIRS:
            pairs.clear()
        out = [token]
        dead = bytearray(size + 1)  # places that no encoding reaches
        token = longest[at]
        while at < size:
            before = out[-1] if out else NO_TOKEN
            while token != NO_TOKEN:
                end = at + length[token]
                if not dead[end]:
                    if before == NO_TOKEN:
                        break
                    fits = pairs.get((before, token))
                    if fits is None:
                        fits = pairs[before, token] = self.vocabulary.compatible(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token != NO_TOKEN:
                out.append(token)
                at = end
                if at < size:
                    token = longest[at]
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token = shorter[token]
        return out

    def kinds(self, chars: np.ndarray) -> np.ndarray:
        """The class of each character; of one not met before, the library's own cutter is asked."""
        kind = self.kind[chars]
        if (kind == UNSEEN).any():
            joined = lambda before, c: len(self.cutter.pre_tokenize_str(before + c)) == 1
            for code in np.unique(chars[kind == UNSEEN]).tolist():
                c = chr(code)
                self.kind[code] = LETTER if joined("a", c) else DIGIT if joined("1", c) else OTHER if joined("!", c) else SPACE
            kind = self.kind[chars]
        return kind

    def cuts(self, chars: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Where words start, by the pattern; edge marks the characters at which a text of its own begins."""
        n = len(chars)
        kind = self.kinds(chars)
        start = edge.copy()
        start[1:] |= kind[1:] != kind[:-1]
        inner = np.append(~edge[1:], False)  # is the next character of the same text?
        # the last of some white space before something else stands alone, or joins it if it is a blank
        last = np.flatnonzero((kind == SPACE) & inner & np.append(kind[1:] != SPACE, False))
        start[last] = True
        start[last[chars[last] == 0x20] + 1] = False
        # contractions begin where an apostrophe begins a word
        quote = np.flatnonzero((chars == 0x27) & start & inner & np.append(kind[1:] == LETTER, False))
        if len(quote):
            first = chars[quote + 1]
            two = inner[quote + 1]
            second = np.where(two, chars[np.minimum(quote + 2, n - 1)], 0)
            size = np.zeros(len(quote), np.int64)
            for e in ENDINGS:
                size[(first == ord(e[0])) & (True if len(e) == 1 else second == ord(e[-1]))] = len(e)
            quote, size = quote[size > 0], size[size > 0]
            start[quote + 1] = False
            more = inner[quote + size]
            start[(quote + size + 1)[more]] = True
        return start

    def added_edges(self, offsets: np.ndarray, raw: bytes) -> list[int]:
        """The byte positions at which added tokens begin and end."""
        if self.added is None or not any(t in raw for t in self.vocabulary.added):
            return []
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            out += [x for m in self.added.finditer(raw, a, b) for x in m.span()]
        return out

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts."""
        n, raw = len(offsets) - 1, data.tobytes()
        if not raw:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # of characters, in bytes
        edge = np.zeros(len(chars) + 1, bool)
        edge[np.searchsorted(place, offsets)] = True
        special = self.added_edges(offsets, raw)
        edge[np.searchsorted(place, special)] = True
        start = self.cuts(chars, edge[:-1])
        for a, b in zip(special[::2], special[1::2], strict=True):
            i, j = np.searchsorted(place, [a, b])
            start[i + 1 : j] = False
        starts = place[:-1][start]
        ends = np.append(starts[1:], len(data))
        ids, at, number = self.encode_words(raw, data, starts, ends)
        size = np.diff(at)[number]
        out = ids[ragged(at[number], size)]
        row_ends = np.append(0, np.cumsum(size))[np.searchsorted(starts, offsets)]
        return out, row_ends

    def encode_words(self, raw: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids and offsets of distinct words, the number of each word among these)."""
        _, first, number = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        size = ends - starts
        alike = size == size[first][number]
        n = size[alike]
        same = data[ragged(starts[alike], n)] == data[ragged(starts[first][number][alike], n)]
        alike[alike] = np.logical_and.reduceat(same, np.cumsum(n) - n)
        odd = np.flatnonzero(~alike)  # words that share a hash with another word
        number[odd] = len(first) + np.arange(len(odd))
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if not self.words:
            self.words = {t: (i,) for t, i in self.vocabulary.added.items()}
        words, encode_word = self.words, self.encode_word
        lists = []
        chosen = np.append(first, odd)
        for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True):
            word = raw[a:b]
            ids = words.get(word)
            if ids is None:
                ids = words[word] = tuple(encode_word(word))
            lists.append(ids)
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(size.sum()))
        return flat, np.append(0, np.cumsum(size)), number


def decode(vocabulary: Vocabulary, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    """The texts of lists of ids; ids outside the vocabulary decode to nothing."""
    known = (ids >= 0) & (ids < len(vocabulary.tokens))
    ids = np.where(known, ids, 0)
    size = np.where(known, np.diff(vocabulary.offsets)[ids], 0)
    data = vocabulary.bytes[ragged(vocabulary.offsets[ids], size)]
    bounds = np.append(0, np.cumsum(size))[offsets]
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
    try:
        return raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:  # tokens that make no character
        return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The encoder of a broadcast vocabulary: built once in each worker process."""
    if id(vocabulary) not in _encoders:
        _encoders.clear()
        _encoders[id(vocabulary)] = Encoder(vocabulary)
    return _encoders[id(vocabulary)]


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    encoder = encoder_of(vocabulary)
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        for a, b in pieces(offsets):
            ids, at = encoder.encode(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            yield batch.column("key").slice(a, b - a), ids, at


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))


def encode(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ids of every row of docs, as the library encodes it without special tokens of its own.

    The strings of added tokens in a text become these tokens. Null and empty texts give no ids.
    Repeated rows stay, nulls in key too; other columns play no part. The vocabulary (of a fixed
    size, whatever the table's) is broadcast; memory is bounded by a piece of 1 MB or the longest text.
    """
    rows = _rows(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(file))
    kind = rows.schema["key"].dataType.simpleString()

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, at in _encoded(batches, shared.value):
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], names=["key", "ids"])

    out = rows.mapInArrow(lists, f"key {kind}, ids array<int>")
    return out.select(F.col("key").alias(key), "ids")


def round_trip(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, packed and text of every row of docs: encoded and decoded in one pass.

    packed holds the ids as little-endian unsigned 32-bit numbers, as token files for training have
    them. Rows and awkward cases as in encode; null and empty texts give empty ones.
    """
    rows = _rows(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(file))
    kind = rows.schema["key"].dataType.simpleString()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, at in _encoded(batches, shared.value):
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer((4 * at).astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays([keys, packed, decode(shared.value, at, ids)], names=["key", "packed", "text"])

    out = rows.mapInArrow(both, f"key {kind}, packed binary, text string")
    return out.select(F.col("key").alias(key), "packed", "text")


def decode_ids(encoded: DataFrame, file: str, key: str = "doc_id") -> DataFrame:
    """key, ids and text of rows of ids: the inverse of encode.

    A null list decodes to an empty text and comes back empty; a null id, and ids outside the
    vocabulary, decode to nothing. Bytes that make no character become U+FFFD.
    """
    rows = encoded.select(F.col(f"`{key}`").alias("key"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(file))
    kind = rows.schema["key"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy().astype(np.int64)
            for a, b in pieces(offsets, 1 << 18):
                flat = ids.values[offsets[a] : offsets[b]].fill_null(NO_TOKEN).to_numpy()
                text = decode(shared.value, offsets[a : b + 1] - offsets[a], flat)
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), ids.slice(a, b - a), text], names=["key", "ids", "text"])

    out = rows.mapInArrow(texts, f"key {kind}, ids array<int>, text string")
    return out.select(F.col("key").alias(key), "ids", "text")
