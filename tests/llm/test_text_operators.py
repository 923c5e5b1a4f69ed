"""Language ID, license scan, secret scan and piece codec against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerflow.llm import jaccard_join, language_id, license_scan, piece_codec, queries, secret_scan
from ledgerflow.llm.textbytes import pieces, string_buffers
from tests.llm import documents as D

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_language_of_prose_and_of_awkward_texts(spark):
    docs = D.table(spark, extra=True)
    model = language_id.fit(docs.where("doc_id % 4 <> 2"))
    got = {(r.doc_id, r.lang_pred): r.score for r in language_id.predict(docs, model).collect()}
    truth = {r[0]: (r[1], r[2]) for r in D.rows()}
    held = [(i, lang) for i, (text, lang) in truth.items() if i % 4 == 2 and i < 60 and text and len(text) > 40 and i % 7 != 1 and i % 6 != 3 and i % 9 != 2]
    assert held and sum((i, lang) in got for i, lang in held) >= 0.9 * len(held)
    assert all(0 <= s <= 1 for s in got.values())
    for i in (60, 61, 62, 63):
        assert got[i, "und"] == 0
    assert sum(1 for r in got if r[0] == 66) == 1 and language_id.predict(docs, model).count() == docs.count()


def test_code_lengths_equal_a_plain_tree():
    data = {"a": ["abracadabra", "abra cadabra"], "b": ["xyzzy xyz", "zyx"]}
    order, count = 3, {}
    for lang, texts in data.items():
        for t in texts:
            for i in range(len(t)):
                for m in range(min(i, order) + 1):
                    count[lang, t[i - m : i], t[i]] = count.get((lang, t[i - m : i], t[i]), 0) + 1

    def cost(lang, context, c):
        successors = {k[2]: n for k, n in count.items() if k[:2] == (lang, context)}
        total, distinct = sum(successors.values()), len(successors)
        if c in successors:
            return -math.log2(successors[c] / (total + distinct))
        escape = -math.log2(distinct / (total + distinct)) if total else 0
        return escape + (cost(lang, context[1:], c) if context else 8)

    def code(lang, t):
        return sum(cost(lang, t[max(0, i - order) : i], t[i]) for i in range(len(t)))

    tables = {}
    for m in range(1, order + 2):
        items = Counter()
        for (lang, context, c), n in count.items():
            if len(context) == m - 1:
                items["ab".index(lang), int.from_bytes((context + c).encode(), "big")] += n
        tables[m] = tuple(np.array(x) for x in zip(*[(lang, g, n) for (lang, g), n in items.items()], strict=True))
    model = language_id.PpmModel(["a", "b"], tables, order)
    texts = ["abra", "", "xyz abra", "q", "zzzz", "cadabr"]
    offsets, raw = string_buffers(pa.array(texts))
    bits = model.bits(offsets, raw)
    for i, t in enumerate(texts):
        assert bits[i] == pytest.approx([code("a", t), code("b", t)])


def test_nothing_to_learn_or_to_label(spark):
    model = language_id.fit(D.table(spark).where("lang is null"))
    assert {r.lang_pred for r in language_id.predict(D.table(spark), model).collect()} == {"und"}
    assert language_id.predict(D.empty(spark), model).count() == 0
    assert language_id.accepted(D.table(spark, extra=True), language_id.fit(D.table(spark))).columns == D.table(spark, extra=True).columns


def plain_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(D.LOWER))
    hits, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                hits.append(k)
                labels.add(label)
    return len(words), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))


def test_licenses_equal_a_plain_search(spark):
    data = D.rows() + [
        (100, "GNU-General  public\nLICENSE gnu general public license; mit mit license license apache license", None, None, None),
        (101, "gnu public general license, cc-by CC BY by cc", None, None, None),
        (102, "Permission is hereby kindly granted, free of charge, to any person obtaining a copy of this fine software", None, None, None),
    ]
    got = license_scan.scan_licenses(D.table(spark, data, extra=True)).collect()
    want = Counter((r[0], *plain_licenses(r[1])) for r in data)
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[102].labels == "mit" and by_id[102].base_labels == "" and 0.8 <= by_id[102].score < 1
    assert "cc-by-nc" in by_id[68].labels and set(by_id[68].base_labels.split(",")) <= set(by_id[68].labels.split(","))
    assert license_scan.scan_licenses(D.empty(spark)).count() == 0


PLAIN_RULES = {
    "assign": r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "forge": "gh[pousr]_[A-Za-z0-9]+",
    "pem": "-----BEGIN (?:[A-Z ]+)?PRIVATE KEY-----",
}
LEAST = {"access": 20, "hex": 24, "forge": 34, "pem": 0}


def plain_spans(text):
    out = []
    for k, (name, rule) in enumerate(PLAIN_RULES.items()):
        for m in re.finditer(rule, text or ""):
            if (len(m[1]) >= 6) if name == "assign" else (len(m[0]) >= LEAST[name]):
                out.append((m.start(), k, m.end()))
    return [(list(PLAIN_RULES)[k], s, e) for s, k, e in sorted(out)]


def test_automaton_equals_regular_expressions():
    rnd = random.Random(1)
    bits = "token|password|Passwd|SECRET|api_key|apikey|=|:| |'|\"|abc|deadbeef|0123456789abcdef|AKIA|ABCDEFGH|é|\n|,|x|-----BEGIN |RSA |PRIVATE KEY-----|ghp_|a1b2c3d4e5|中".split("|")
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + ["token=token: hunter22x", "f" * 9000, None, ""]
    machine = secret_scan.automaton()
    offsets, data = string_buffers(pa.array(texts))
    got = [[] for _ in texts]
    for a, b in pieces(offsets, 5000):
        for r, found in secret_scan.text_spans(machine, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
            got[a + r] = [(machine.kinds[k], s, e) for s, k, e in found]
    assert got == [plain_spans(t) for t in texts]


def test_secret_query_columns(spark):
    found = secret_scan.secret_spans(D.table(spark, extra=True)).collect()
    want = Counter((r[0], tuple(plain_spans(r[1]))) for r in D.rows())
    assert Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in found) == want
    assert secret_scan.secret_spans(D.empty(spark)).count() == 0
    assert secret_scan.span_sha256([], []) == hashlib.sha256(b"").hexdigest()


def test_pieces_equal_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocabulary = piece_codec.Vocabulary(MODEL)
    rnd = random.Random(3)
    bits = ["a", "b", "the", "  ", "   ", " ", "é", "中", "\n", "▁", "\x00", "😀", "<s>", "</s>", "ing", "1", "aaaa", "==", "don't", ".", "​"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60))) for _ in range(600)]
    texts += ["a" * n for n in range(1, 90)] + [" " * n for n in range(1, 60)] + ["ab" * n for n in range(1, 60)] + [None, "", "▁"]
    texts += ["".join(rnd.choice("etaoinshrdlu") for _ in range(3000))]
    encoder, decoder = piece_codec.Encoder(vocabulary), piece_codec.Decoder(vocabulary.text, len(vocabulary.text))
    offsets, data = string_buffers(pa.array(texts))
    got, back = [], []
    for a, b in pieces(offsets, 2000):
        ids, at = encoder.encode(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
        got += [ids[at[i] : at[i + 1]].tolist() for i in range(b - a)]
        back += decoder.decode(at, ids).to_pylist()
    want = sp.encode([t or "" for t in texts], add_eos=True)
    assert got == want
    assert back == [sp.decode(w) for w in want]


@pytest.mark.parametrize("bits", [64, 3])
def test_words_that_share_a_hash_are_encoded_each(monkeypatch, bits):
    """Words that polynomials modulo 2**64 confuse; and a hash of 3 bits, under which most words clash."""
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    plain = piece_codec.span_hash
    monkeypatch.setattr(piece_codec, "span_hash", lambda *a: plain(*a) & np.uint64((1 << bits) - 1))
    texts = []
    for n in (1024, 2048, 4096):
        for a, b in ("ab", "et"):
            word = [bin(i).count("1") % 2 for i in range(n)]
            texts += ["".join(a if x else b for x in word), "".join(b if x else a for x in word)]
    texts += [r[1] or "" for r in D.rows()]
    encoder = piece_codec.Encoder(piece_codec.Vocabulary(MODEL))
    offsets, data = string_buffers(pa.array(texts))
    got = []
    for a, b in pieces(offsets, 4000):
        ids, at = encoder.encode(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
        got += [ids[at[i] : at[i + 1]].tolist() for i in range(b - a)]
    assert got == sp.encode(texts, add_eos=True)


def test_whole_license_texts_are_found_beyond_64_grams(spark):
    """In full, with words changed, put in and left out here and there; and cut in half, which is too little."""
    texts = list(license_scan.LICENSE_TEXTS.items())
    assert all(len(t.split()) > license_scan.LONG_WORDS for t, _ in texts) and {size for _, _, size in license_scan.template_list()} == {license_scan.GRAM, license_scan.LONG_GRAM}
    rows, want = [], {}
    for i, (text, label) in enumerate(texts):
        words = text.split()
        edited = [w for k, w in enumerate(words) if k != 40]
        edited[60] = "changed"
        edited.insert(70, "inserted")
        quarter = len(words) // 4
        for k, body in enumerate((words, edited, words[quarter : 3 * quarter])):
            rows.append((10 * i + k, "Some words before. " * 30 + "\n".join(body).upper() + " and some behind", "en", "s", 1))
            want[10 * i + k] = (label, k)
    spans, found = {}, license_scan.license_spans(D.table(spark, rows)).collect()
    key = {r.row: r.key for r in found if r.template < 0}
    for r in found:
        if r.template >= len(license_scan.PHRASES) + len(license_scan.WORDINGS):
            spans.setdefault(key[r.row], []).append((r.label, r.coverage, r["first"]))
    for i, (label, k) in want.items():
        mine = [x for x in spans.get(i, []) if x[0] == label]
        if k == 0:
            assert (label, 1.0, 90) in mine
        elif k == 1:
            (_, coverage, first) = max(mine, key=lambda x: x[1])
            assert license_scan.COVERAGE <= coverage < 1 and 88 <= first <= 91
        else:
            assert not mine


def test_rows_without_ids_stay(spark):
    texts = ["Released under the MIT License. token = abcdef12", None, "the same thing is said again and again", "the same thing is said again and again"]
    docs = spark.createDataFrame([(None, t, "en", "s", 1) for t in texts], D.SCHEMA)
    model = language_id.fit(D.table(spark))
    assert sorted(r.lang_pred == "und" for r in language_id.predict(docs, model).collect()) == [False, False, False, True]
    assert Counter(r.base_labels for r in license_scan.scan_licenses(docs).collect()) == {"mit": 1, "": 3}
    assert Counter(len(r.spans) > 0 for r in secret_scan.secret_spans(docs).collect()) == {True: 1, False: 3}
    assert Counter(r.n_tokens > 1 for r in queries.token_digests(docs, MODEL).collect()) == {True: 3, False: 1}
    assert Counter((r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs).collect()) == {(4, None): 3, (0, None): 1}


def test_token_digests(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = Counter()
    for r in D.rows():
        ids = sp.encode(r[1] or "", add_eos=True)
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    assert Counter(map(tuple, queries.token_digests(D.table(spark, extra=True), MODEL).collect())) == want
    assert queries.token_digests(D.empty(spark), MODEL).count() == 0
    twice = piece_codec.decode(piece_codec.encode(D.table(spark), MODEL), MODEL)
    assert {(r.doc_id, r.text) for r in twice.collect()} == {(r.doc_id, r.text) for r in piece_codec.round_trip(D.table(spark), MODEL).collect()}
    odd = spark.createDataFrame([(1, None), (2, [5, 40000, -1, 2])], "doc_id long, ids array<int>")
    assert piece_codec.decode(odd, MODEL).where(F.col("text") == "").count() >= 1
