"""Exact dedup, Jaccard join and suffix-array dedup against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from ledgerflow.llm import exact_dedup, jaccard_join, key_filter, suffix_array, suffix_dedup
from ledgerflow.llm.components import components
from ledgerflow.operators import spread
from tests.llm import documents as D


def test_exact_copies(spark):
    groups = defaultdict(list)
    for r in D.rows():
        groups[(r[1] or "").translate(D.LOWER)].append(r[0])
    want = Counter()
    for r in D.rows():
        t = (r[1] or "").translate(D.LOWER)
        keep = max(groups[t])
        want[r[0], keep, len(groups[t]), r[0] == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup.exact_copies(D.table(spark, extra=True), digest=True).collect())) == want
    unread = exact_dedup.exact_copies(D.table(spark)).where("group_size = 1 and content_sha256 is null").count()
    assert unread > 0
    assert exact_dedup.exact_copies(D.empty(spark)).count() == 0


def test_one_copy_stays(spark):
    kept = exact_dedup.drop_copies(D.table(spark, extra=True))
    assert kept.columns == D.table(spark, extra=True).columns
    texts = [(r.text or "").translate(D.LOWER) for r in kept.collect()]
    assert set(texts) == {(r[1] or "").translate(D.LOWER) for r in D.rows()}
    assert len(texts) == len(set(texts))
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), (1, "b")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in exact_dedup.drop_copies(nulls).collect()) == [("1", "b"), ("None", "a"), ("None", "a")]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(D.LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def plain_components(data):
    sets = [(r[0], shingles(r[1])) for r in data]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            common = len(a & b)
            if common and 100 * common >= 75 * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return Counter((doc, len(s), least[find(i)]) for i, (doc, s) in enumerate(sets))


def test_jaccard_components(spark):
    got = jaccard_join.link_components(D.table(spark, extra=True)).collect()
    assert Counter(map(tuple, got)) == plain_components(D.rows())
    assert jaccard_join.link_components(D.empty(spark)).count() == 0


def test_jaccard_in_large_groups_of_near_copies(spark):
    """More records than GROUP share shingles, in chains where the hub links with some only."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    data = []
    for i in range(90):
        words = list(base)
        for _ in range(rnd.randint(0, 5)):
            words[rnd.randrange(60)] = f"x{rnd.randrange(400)}"
        data.append((i, " ".join(words), "en", "s", 1))
    for i in range(90, 120):  # a passage that many unrelated documents share
        data.append((i, " ".join(base[:12] + [f"y{i}_{k}" for k in range(rnd.randint(2, 30))]), "en", "s", 1))
    assert Counter(map(tuple, jaccard_join.link_components(D.table(spark, data)).collect())) == plain_components(data)


def test_close_pairs_of_sets_too_large_for_signatures():
    """Equal sizes, no signature on either side: nothing rules the pair out."""
    def side(rid, size, fine):
        return pa.table({"fine": pa.array([fine], pa.binary()), "size": [size], "low": [0.25], "high": [1.0], "label": [rid], "rid": [rid]})

    few = bytes([1]) * jaccard_join.FINE
    assert jaccard_join._close_pairs(side(1, 200_000, None), side(2, 200_500, None)).to_pylist() == [{"a": 1, "b": 2}]
    assert jaccard_join._close_pairs(side(1, 200_000, None), side(2, 400_000, None)).num_rows == 0
    assert jaccard_join._close_pairs(side(1, 600, None), side(2, jaccard_join.FINE, few)).num_rows == 1
    assert jaccard_join._close_pairs(side(1, jaccard_join.FINE, few), side(2, 600, None)).num_rows == 1
    large = jaccard_join._fine(np.zeros(200_000, np.int64), np.arange(200_000, dtype=np.uint64), 1)[0].as_py()
    assert large is None and jaccard_join._close_pairs(side(3, 200_000, large), side(4, 200_000, large)).num_rows == 1


def thue_morse(n, a, b):
    """A string and its complement, which polynomial hashes modulo 2**64 cannot tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(a if x else b for x in bits), "".join(b if x else a for x in bits)


def test_words_that_polynomials_confuse_stay_apart(spark):
    data, i = [], 0
    for n in (1024, 2048, 4096):
        for a, b in ("ab", "et"):
            for t in thue_morse(n, a, b):
                data += [(i, t, "en", "s", 1), (i + 1, f"{t} is one of six words here", "en", "s", 1)]
                i += 2
    assert Counter(map(tuple, jaccard_join.link_components(D.table(spark, data)).collect())) == plain_components(data)
    assert digest(suffix_dedup.remove_repeats(D.table(spark, data))) == plain_repeats(data)


def test_sets_that_share_a_record_id_are_told_apart(spark, monkeypatch):
    plain = jaccard_join._records

    def few_ids(rows, hashes, n):
        size, rid, check = plain(rows, hashes, n)
        return size, rid & 3, check

    monkeypatch.setattr(jaccard_join, "_records", few_ids)
    assert Counter(map(tuple, jaccard_join.link_components(D.table(spark)).collect())) == plain_components(D.rows())
    kept = jaccard_join.one_per_component(D.table(spark))
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in plain_components(D.rows())}


def test_more_keys_than_a_bitmap_holds_and_frequent_keys(spark, monkeypatch):
    """The ways for very many and for very frequent keys give the same rows."""
    monkeypatch.setattr(key_filter, "MOST_BITS", 0)
    monkeypatch.setattr(spread, "LEAST", 2)
    monkeypatch.setattr(spread, "MOST", 10)
    data = D.rows() + [(300 + i, f"common text of many copies {i % 2}", "en", "s", 1) for i in range(40)]
    docs = D.table(spark, data, extra=True)
    assert Counter(map(tuple, jaccard_join.link_components(docs).collect())) == plain_components(data)
    groups = defaultdict(list)
    for r in data:
        groups[(r[1] or "").translate(D.LOWER)].append(r[0])
    want = Counter((r[0], max(g), len(g)) for r in data for g in [groups[(r[1] or "").translate(D.LOWER)]])
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_copies(docs, digest=True).collect()) == want
    assert len(exact_dedup.drop_copies(docs).collect()) == len({t for t in groups})
    assert digest(suffix_dedup.remove_repeats(docs)) == plain_repeats(data)


def test_one_per_component_stays(spark):
    docs = D.table(spark, extra=True)
    kept = jaccard_join.one_per_component(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in plain_components(D.rows())}
    assert {r.doc_id for r in kept.collect()} == want


def test_one_per_component_where_ids_repeat(spark):
    rnd = random.Random(7)
    a, b, c, d = ([f"{x}{rnd.randrange(10**6)}" for _ in range(40)] for x in "abcd")
    near = lambda t: " ".join([*t[:-1], "changed"])
    text = lambda t: " ".join(t)
    data = [
        (1, near(a)), (5, text(a)), (5, text(b)),  # the clean one of id 5 stays
        (6, text(c)), (6, text(c)), (6, near(c)), (9, near(c)),  # one of id 6 stays
        (7, text(d)), (8, near(d)), (8, None), (8, " "), (None, near(d)),
    ]
    docs = spark.createDataFrame([(i, t, "s", "x") for i, t in data], "doc_id long, text string, slot string, row string").repartition(3)
    kept = jaccard_join.one_per_component(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    of_six = [t for i, t in got.elements() if i == 6]
    assert len(of_six) == 1 and of_six[0] in (text(c), near(c))
    del got[6, of_six[0]]
    assert got == Counter([(1, near(a)), (5, text(b)), (7, text(d)), (8, None), (8, " "), (None, near(d))])


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (300, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200, 300: 200}


def test_suffix_arrays_and_common_prefixes():
    rnd = np.random.default_rng(1)
    for k in range(400):
        n, s = int(rnd.integers(0, 150)), int(rnd.integers(1, 5))
        t = rnd.integers(0, 256 if k % 5 == 0 else s, n).astype(np.uint8)
        if k % 7 == 0:
            t = np.tile(t[: max(1, n // 9)], 9)
        raw = bytes(t)
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        order = suffix_array.suffix_array(t)
        assert order.tolist() == want
        shared = suffix_array.permuted_common_prefixes(t, order)
        for a, b in zip(want, want[1:], strict=False):
            n = 0
            while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert shared[b] == n


def test_suffix_arrays_of_any_alphabet():
    rnd = np.random.default_rng(2)
    for top in (3, 300, 70_000):
        for n in (2, 50, 400):
            t = rnd.integers(0, top, n)
            t[: n // 2] = t[n // 2 : n // 2 * 2]
            assert suffix_array.suffix_array(t).tolist() == sorted(range(n), key=lambda i: t[i:].tolist())  # noqa: B023
    long = np.tile(np.frombuffer(b"the same words again and ", np.uint8), 300)
    raw = bytes(long)
    assert suffix_array.suffix_array(long).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def plain_repeats(data, width=100):
    """Texts in order of id; windows seen before are removed."""
    seen, out = set(), Counter()
    for r in sorted(data, key=lambda r: r[0]):
        raw = (r[1] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - width + 1):
            w = raw[s : s + width]
            if w in seen:
                gone[s : s + width] = b"\1" * width
            seen.add(w)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[r[0], len(raw), sum(gone), runs, kept] += 1
    return out


def digest(df):
    return Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in df.collect())


def test_repeats_are_removed(spark):
    rnd = random.Random(4)
    data = D.rows() + [(200 + i, "".join(rnd.choice("ab ") for _ in range(rnd.randint(80, 400))) * rnd.randint(1, 3), "en", "s", 1) for i in range(20)]
    assert digest(suffix_dedup.remove_repeats(D.table(spark, data, extra=True))) == plain_repeats(data)
    assert suffix_dedup.remove_repeats(D.empty(spark)).count() == 0


def test_repeats_with_hot_anchors_window_by_window(spark, monkeypatch):
    rnd = random.Random(6)
    line = "this very common line stands in all of the documents of this table"
    data = [(i, " ".join(f"{rnd.random()}" for _ in range(6)) + line + " ".join(f"{rnd.randrange(3)}{line[:30]}" for _ in range(5)), "en", "s", 1) for i in range(40)]
    for hot in (5, 0):  # split by what stands beside the anchor, and also window by window
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        assert digest(suffix_dedup.remove_repeats(D.table(spark, data))) == plain_repeats(data)
    monkeypatch.setattr(suffix_dedup, "HOT", 12)
    assert digest(suffix_dedup.remove_repeats(D.table(spark, data))) == plain_repeats(data)
    monkeypatch.setattr(suffix_dedup, "HOT", 8192)
    monkeypatch.setattr(suffix_dedup, "SHARD", 500)
    assert digest(suffix_dedup.remove_repeats(D.table(spark, data))) == plain_repeats(data)


def test_repeats_with_null_ids(spark):
    text = "0123456789" * 15
    rows = spark.createDataFrame([(None, text), (3, text), (None, "x")], "doc_id long, text string")
    got = digest(suffix_dedup.remove_repeats(rows))
    assert sum(n for (i, *_), n in got.items() if i is None) == 2 and got[3, 150, 150, 1, b""] == 1
