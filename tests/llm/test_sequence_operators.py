"""BPE codec, periodic runs and conversation trie against the library and plain versions."""

from __future__ import annotations

import hashlib
import json
import random
import struct
import zlib
from collections import defaultdict

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import bpe_codec, conversation_trie, periodic_runs, queries
from ledgerflow.llm.radix_tree import Full, Indexed, RadixTree, Sorted
from ledgerflow.llm.textbytes import string_buffers
from tests.llm import documents as D

FILE = public_tokenizers.path("byte_bpe_50k.json")
sha = lambda t: hashlib.sha256(t if isinstance(t, bytes) else t.encode()).hexdigest()


@pytest.fixture(scope="module")
def encoder():
    return bpe_codec.Encoder(bpe_codec.Vocabulary(FILE))


def encoded(encoder, texts):
    offsets, data = string_buffers(pa.array(texts, pa.string()))
    ids, at = encoder.encode(offsets, data)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)], bpe_codec.decode(encoder.vocabulary, at, ids).to_pylist()


def test_tokens_of_awkward_texts_equal_the_librarys(encoder):
    rnd = random.Random(4)
    bits = ["'", "'s", "'re", "'ll", "'S", " ", "  ", "\n", "\t", "\xa0", "　", "​", "a", "don't", "é", "ß", "漢", "1", "²", "½", "!", "..", "́", "<|endoftext|>", "<|endof", "😀", "the", "ing", "\x00", "\x1c", "\x85", "\U0001f468‍", "՘", "Ᲊ"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rnd.choice("abeth ") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0, 0x3000), rnd.randrange(0xE000, 0x110000)])) for _ in range(rnd.randint(0, 20))) for _ in range(3000)]
    texts += ["a" * 20_001, "ab" * 9000, "".join(rnd.choice("aeth") for _ in range(60_000)), " " * 5000 + "x", "é" * 3000, "0" * 1000]
    library = Tokenizer.from_file(FILE)
    ids, back = encoded(encoder, texts)
    assert back == texts
    assert ids == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_words_that_share_a_hash_are_told_apart(encoder, monkeypatch):
    plain = encoded(encoder, ["one two one three", "two one"])
    monkeypatch.setattr(bpe_codec, "span_hash", lambda data, a, b: (b - a) % 2)
    assert encoded(encoder, ["one two one three", "two one"]) == plain


def test_compatible_pairs_are_those_that_the_merges_leave(encoder):
    """Against merging pair by pair in the order of ranks."""
    v, rnd = encoder.vocabulary, random.Random(8)

    def merged(text: bytes) -> list[int]:
        parts = [v.tokens.index(bytes([b])) for b in text]
        while len(parts) > 1:
            rank, i = min((v.rank.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [next(t for t, r in enumerate(v.made) if r == rank)]
        return parts

    short = [i for i, t in enumerate(v.tokens[:3000]) if t and t.isalpha() and len(t) <= 4]
    for _ in range(150):
        a, b = rnd.choice(short), rnd.choice(short)
        assert v.compatible(a, b) == (merged(v.tokens[a] + v.tokens[b]) == [a, b])


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe_codec.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    with open(FILE, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "odd.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe_codec.Vocabulary(str(tmp_path / "odd.json"))


def test_bpe_of_tables(spark):
    docs = D.table(spark, [*D.rows(), (90, "x" * 1_300_000 + " y" * 200_000, "en", "s", 1), (None, "no id", "en", "s", 5)], extra=True)
    want = {i: (t or "", Tokenizer.from_file(FILE).encode(t or "", add_special_tokens=False).ids) for i, t, *_ in docs.select("doc_id", "text").collect()}
    got = bpe_codec.round_trip(docs, FILE).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.text, list(struct.unpack(f"<{len(r.packed) // 4}I", r.packed))) == want[r.doc_id]
    lists = bpe_codec.encode(docs, FILE)
    assert {r.doc_id: r.ids for r in lists.collect()} == {i: ids for i, (_, ids) in want.items()}
    assert {r.doc_id: r.text for r in bpe_codec.decode_ids(lists, FILE).collect()} == {i: t for i, (t, _) in want.items()}
    odd = spark.createDataFrame([(1, None), (2, [50256, 99999, -1]), (3, [None, 64])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe_codec.decode_ids(odd, FILE).collect()} == {1: "", 2: "<|endoftext|>", 3: "a"}
    assert bpe_codec.round_trip(D.empty(spark), FILE).count() == 0


def test_bpe_query_digests(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    library = Tokenizer.from_file(FILE)
    want = set()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in queries.op11_bpe_codec(spark, sf).collect()} == want


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i - q, j - i + q), q)
            i = j + 1
    runs = sorted((s, n, q) for (s, n), q in found.items())
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return runs, " ".join(w for k, w in enumerate(words) if k not in gone)


def repeating_texts(seed, n):
    rnd, out = random.Random(seed), []
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(0, 6)):
            block = [rnd.choice("abc") for _ in range(rnd.randint(1, 6))]
            words += block * rnd.randint(1, 6) + block[: rnd.randint(0, len(block))]
        out.append(rnd.choice([" ", "\n", " \t "]).join(words))
    return out


@pytest.mark.parametrize("same_hash", [False, True])
def test_runs_equal_plain_ones(spark, monkeypatch, same_hash):
    texts = [None, "", " \n", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "é\xa0x " * 9, *repeating_texts(3, 1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["key", "text"])
    if same_hash:
        monkeypatch.setattr(periodic_runs, "span_hash", lambda data, a, b: (a * 0).astype("uint64"))
    got = [r for b in periodic_runs._runs(iter([batch])) for r in b.to_pylist()]
    for r, t in zip(got, texts, strict=True):
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ") if w]
        runs, left = plain_runs(words)
        assert (r["n_words"], [tuple(x.values()) for x in r["runs"]], r["collapsed"]) == (len(words), runs, left)


def test_runs_of_tables(spark):
    rnd = random.Random(1)
    long = " ".join([" ".join(rnd.choice("ab") for _ in range(50_000))] * 5 + ["x y"] * 150_000)
    docs = D.table(spark, [*D.rows(), (90, long, "en", "s", 1), (None, "la " * 9, "en", "s", 27)], extra=True)
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert set(got) == {i for i, in docs.select("doc_id").collect()} and periodic_runs.periodic_runs(docs).count() == docs.count()
    assert [tuple(r) for r in got[None].runs] == [(0, 9, 1)] and got[None].collapsed == "la"
    assert [tuple(r) for r in got[65].runs] == [(0, 180, 3)] and got[65].collapsed == "the same line"
    assert (0, 250_000, 50_000) in [tuple(r) for r in got[90].runs] and (250_000, 300_000, 2) in [tuple(r) for r in got[90].runs]
    assert periodic_runs.periodic_runs(D.empty(spark)).count() == 0


@pytest.mark.parametrize("exponent", [3, 5])
def test_other_exponents(exponent, monkeypatch):
    import numpy as np

    rnd = random.Random(6)
    for _ in range(300):
        words = [ord(c) for c in " ".join(repeating_texts(rnd.random(), 1)).replace(" ", "").replace("\n", "").replace("\t", "")]
        order, same = periodic_runs.numbered(np.array(words, np.int64))
        got = set(zip(*[x.tolist() for x in periodic_runs.find_runs(order, same, np.zeros(len(words), np.int64), exponent)], strict=True))
        found = {}
        for q in range(1, len(words) // exponent + 1):
            i = q
            while i < len(words):
                j = i
                while j < len(words) and words[j] == words[j - q]:
                    j += 1
                if j - i + q >= max(6, exponent * q):
                    found.setdefault((i - q, j - i + q), q)
                i = j + 1
        assert got == {(s, n, q) for (s, n), q in found.items()}


def test_layouts_grow_and_strings_end_inside_of_others():
    tree, rnd = RadixTree(), random.Random(2)
    keys = {bytes(rnd.choice([rnd.randrange(256), 7]) for _ in range(3 * rnd.randint(0, 4))) for _ in range(3000)}
    for k in rnd.sample(sorted(keys), len(keys)):
        tree.insert(k, k)
    kinds = {type(tree.root.children)} | {type(n.children) for _, n in tree.root.children.items()}
    assert Full in kinds and kinds & {Sorted, Indexed}
    paths: list[bytes] = []
    for depth, parent, last, value in tree.aligned(3):
        path = (paths[parent] if parent >= 0 else b"") + last
        assert len(path) == 3 * depth and (value == path if path in keys else value is None)
        paths.append(path)
    assert sorted(set(paths)) == sorted({k[:d] for k in keys for d in range(0, len(k) + 1, 3)}) and len(set(paths)) == len(paths)
    assert list(RadixTree().aligned(3)) == []
    for n, kind in ((4, Sorted), (16, Sorted), (17, Indexed), (48, Indexed), (49, Full), (256, Full)):
        layout = Sorted()
        for label in rnd.sample(range(256), n):
            layout = layout.put(label, label)
        assert type(layout) is kind and [x for x, _ in layout.items()] == sorted(x for x, _ in layout.items()) and len(list(layout.items())) == n
        assert all(layout.find(x) == x for x, _ in layout.items())


def plain_trie(rows):
    """Nodes by their paths, from lists of turns."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    below = defaultdict(list)
    for p in members:
        if p:
            below[p[:-1]].append(p)

    def subtree(p):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        parts = [subtree(q) for q in below[p]]
        return sum(x for x, _ in parts) + own, sum(x for _, x in parts) or 1

    return sorted(str((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), subtree(p)[1], subtree(p)[0], sha(",".join(map(str, ends[p]))))) for p, m in members.items())


def conversations(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 10 == 0:
            continue  # its followers find no leader
        for t in range(rnd.randint(1, 12)):
            rows.append((c, t if t else rnd.choice([None, 0]), rnd.choice(["user", None, "assistant"]), rnd.choice(["hello", "é", None, "", "yes"]) if t < 3 else rnd.choice(["a", "b"])))
    rows += [r for r in rows if r[0] == 7]  # repeated rows
    rows += [(1000 + i, t, "user", "the same") for i in range(300) for t in range(3)]  # many copies
    rows += [(5 * i + 2000, t, "user", f"turn {t}") for i in range(3) for t in range(200)]  # long ones
    rows += [(None, 0, "user", "no id"), (4999, 0, "user", "only one")]
    return rows


@pytest.mark.parametrize("shard", [60, 2000, 1 << 20])
def test_trie_equals_plain_one(spark, monkeypatch, shard):
    monkeypatch.setattr(conversation_trie, "SHARD_BYTES", shard)
    monkeypatch.setattr(conversation_trie, "LISTED", 64)
    rows = conversations(9)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for name in ("key", "open", "n", "id", "shard", "above"):
        df = df.withColumn(name, conversation_trie.F.lit("clash"))
    got = conversation_trie.prefix_trie(queries.forked(conversation_trie.turn_keys(df)))
    assert sorted(str(tuple(r)[:-1]) for r in got.collect()) == plain_trie(rows)


def test_trie_of_nothing_and_of_keys_without_turns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie.prefix_trie(conversation_trie.turn_keys(none)).count() == 0
    bare = spark.createDataFrame([(4, None), (3, b""), (None, b"x" * 20)], "conv_id long, key binary")
    assert [tuple(r) for r in conversation_trie.prefix_trie(bare).collect()] == [(3, 0, None, 2, 0, 1, 0, sha("3,4"), None)]
