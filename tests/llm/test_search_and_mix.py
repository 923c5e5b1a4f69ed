"""Top-k search, quality sampling, mixing and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerflow.llm import metric_search, quality_sampling, source_mixing
from ledgerflow.llm.shared import written
from tests.llm import documents as D
from tests.llm.test_dedup_operators import plain_components


def test_top_k_equals_all_products(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)], 1) for i in range(400)]
    rows += [(400 + i, rows[3][1], 1) for i in range(12)]  # ties
    rows += [(500, None, 1), (501, [1.0, None] * 4, 1), (502, [float("nan")] * 8, 1), (503, [float("inf")] * 8, 1), (504, [], 1), (550, [1.0, 2.0], 1), (551, [3.0, 1.0], 1), (600, [0.0] * 8, 1), (None, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit("clash"))
    monkeypatch.setattr(metric_search, "SHARD_ROWS", 150)
    monkeypatch.setattr(metric_search, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(metric_search, "PAGE", 8)
    got = {}
    for r in metric_search.top_k(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    use = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    for q, v in use.items():
        if q % 50 == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in use.items() if i != q and len(w) == len(v)))[:5]
            assert got.pop(q) == {k + 1: (i, -s) for k, (s, i) in enumerate(best)}
    assert not got
    assert metric_search.top_k(df.limit(0), F.lit(True)).count() == 0


def test_search_avoids_products():
    rnd = np.random.default_rng(0)
    centers = rnd.integers(-2000, 2000, (40, 16))
    vectors = (centers[rnd.integers(0, 40, 4000)] + rnd.integers(-40, 40, (4000, 16))).astype(float)
    pages = metric_search.build_pages(np.arange(4000), vectors)
    router = pages[0].pop("router")
    for p in pages:
        p["vectors"] = p["vectors"].reshape(-1, 16)
    found, computed = metric_search.search(dict(enumerate(pages)), router, vectors[7], 7, 5)
    products = vectors @ vectors[7]
    products[7] = -np.inf
    assert [s for s, _ in found] == sorted(products.astype(float), reverse=True)[:5]
    assert computed < 2500


def test_a_page_is_visited_once_for_all_queries():
    """Many queries take one walk through a tree, and find what each finds alone: the products, ties and own rows included."""
    rnd = np.random.default_rng(5)
    vectors = rnd.integers(-30, 30, (900, 6)).astype(float)
    vectors[100:140] = vectors[7]
    pages = metric_search.build_pages(np.arange(900), vectors)
    router = pages[0].pop("router")
    visits = []

    class Page(dict):
        def __getitem__(self, name):
            if name == "parent":
                visits.append(id(self))
            return super().__getitem__(name)

    tree = {i: Page(p | {"vectors": p["vectors"].reshape(-1, 6)}) for i, p in enumerate(pages)}
    own = np.arange(0, 900, 9)
    products = vectors[own] @ vectors.T
    products[np.arange(100), own] = -np.inf
    least = np.where(np.arange(100) % 2 == 0, -np.inf, np.sort(products, axis=1)[:, -3])  # every other query asks for its three best scores
    scores, ids, _ = metric_search.search_all(tree, router, vectors[own], own, 5, least)
    assert len(visits) == len(set(visits)) <= len(pages)
    for q in range(100):
        want = [(s, i) for s, i in sorted(((-p, i) for i, p in enumerate(products[q])))[:5] if -s >= least[q]]
        assert [(-s, i) for s, i in zip(scores[q], ids[q], strict=True) if np.isfinite(s)] == want


def test_search_leaves_out_regions(spark, monkeypatch):
    """Of rows in tight clusters, a query visits few shards beyond its own; the result is that of all products."""
    rnd = np.random.default_rng(3)
    centers = rnd.normal(0, 4, (12, 8))
    rows = [(i, (centers[i % 12] + rnd.normal(0, 0.05, 8)).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(metric_search, "SHARD_ROWS", 40)
    visits = []
    visit = metric_search._visit

    def counted(trees, queries, k):
        visits.append(queries.count())
        return visit(trees, queries, k)

    monkeypatch.setattr(metric_search, "_visit", counted)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in metric_search.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    use = np.floor(256 * np.array([v for _, v in rows], np.float32).astype(np.float64))
    for q in range(0, 1200, 50):
        products = use @ use[q]
        products[q] = -np.inf
        for rank, i in enumerate(np.lexsort((np.arange(1200), -products))[:5]):
            assert got.pop((q, rank + 1)) == (int(i), int(products[i]))
    assert not got
    assert visits[0] == 24 and visits[1] < 24 * 12  # of more than 30 shards


def test_log_weights_and_draw_equal_a_plain_version(spark):
    rnd = random.Random(3)
    docs = [(i, D.prose(rnd, rnd.choice(["en", "de"]), rnd.randint(0, 40)) if i % 7 else None, "en", "s", 1) for i in range(40)] + [(7, "twice here", "en", "s", 1)]
    good = {i for i in range(0, 40, 3)}
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = quality_sampling.quality_sample(D.table(spark, docs, extra=True), labels, share=0.3).collect()

    def buckets(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return quality_sampling.ngram_buckets(np.array([0, len(data)]), data)[1].tolist()

    raw, target = Counter(), Counter()
    for i, text, *_ in docs:
        raw.update(buckets(text))
        if i in good:
            target.update(buckets(text))
    size, prior = quality_sampling.BUCKETS, quality_sampling.PRIOR
    share = {b: (raw[b] + 0.01) / (sum(raw.values()) + 0.01 * size) for b in raw}
    ratio = {b: math.log((target[b] + prior * share[b]) / (sum(target.values()) + prior)) - math.log(share[b]) for b in raw}
    want = sorted((i, round(sum(ratio[b] for b in buckets(text)), 6)) for i, text, *_ in docs)
    assert sorted((r.doc_id, round(r.log_weight, 6)) for r in got) == want
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    least = keys[math.ceil(0.3 * len(docs)) - 1]
    assert all(r.sampled == (r.gumbel_key >= least) for r in got)
    noise = [r.gumbel_key - r.log_weight for r in got]
    assert all(math.isfinite(x) for x in noise) and len({round(x, 9) for x in noise}) == 40


def test_quality_sample(spark):
    rnd = random.Random(9)
    good = [(i, D.prose(rnd, "en", 40), "en", "s", 1) for i in range(60)]
    bad = [(i, " ".join(rnd.choice(["click", "buy", "now", "free", "$$$", "win"]) for _ in range(40)), "en", "s", 1) for i in range(60, 120)]
    docs = D.table(spark, good + bad + [(300, None, None, None, None), (301, "", None, None, None)])
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = quality_sampling.quality_sample(docs, labels, share=0.5).collect()
    assert len(got) == 122 and sum(r.sampled for r in got) == 61
    by = {r.doc_id: r for r in got}
    assert min(by[i].score for i in range(1, 60, 2)) > max(by[i].score for i in range(61, 120, 2))
    assert quality_sampling.quality_sample(D.empty(spark), labels).count() == 0
    assert quality_sampling.quality_sample(docs, labels.limit(0)).count() == 122


def test_kth_largest(spark):
    values = [random.Random(1).gauss(0, 100) for _ in range(500)] + [1.5] * 40
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 300, 540):
        assert quality_sampling.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_kth_largest_of_neighbouring_numbers(spark):
    values = [1.0]
    for _ in range(999):
        values.append(math.nextafter(values[-1], 2))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 500, 1000):
        assert quality_sampling.kth_largest(df, "v", k) == values[1000 - k]


def test_pfair_deviates_by_less_than_one_block():
    for shares in ({"a": 512, "b": 300, "c": 212}, {"a": 1, "b": 1, "c": 1022}, {f"s{i}": n for i, n in enumerate((400, 300, 200, 100, 24))}):
        period = sum(shares.values())
        slots = source_mixing.one_period(shares)
        assert sorted(s for v in slots.values() for s in v) == list(range(period))
        for name, a in shares.items():
            had = np.cumsum(np.isin(np.arange(period), slots[name]))
            assert np.abs(had - np.arange(1, period + 1) * a / period).max() < 1
    assert sum(source_mixing.shares({"a": 5.0, "b": 0.001, "c": 1.0}, 64).values()) == 64


def test_phases_place_every_block_once():
    blocks = {"a": 1700, "b": 30, "c": 700, "d": 1}
    seen = Counter()
    for p in source_mixing.phases(blocks, {"a": 1.0, "b": 2.0, "c": 1.0, "d": 1.0}):
        seen.update({n: k for n, k in p.blocks.items()})
    assert seen == blocks


def plain_slots(counts, rows_of_block, weights):
    """Slot by slot over all blocks: of those released, the one due first; a new phase when a source has no block left."""
    left = {n: -(-c // rows_of_block) for n, c in counts.items() if c}
    done, slot, out = dict.fromkeys(left, 0), 0, {}
    while left:
        period = max(source_mixing.LEAST_PERIOD, 1 << (4 * len(left) - 1).bit_length())
        share = source_mixing.shares({n: weights[n] for n in left}, period)
        had, t = dict.fromkeys(left, 0), 0
        while True:
            ready = [(-(-(had[n] + 1) * period // a), n) for n, a in share.items() if had[n] * period // a <= t]
            n = min(ready)[1]
            if had[n] == left[n]:
                break
            out[n, done[n] + had[n]] = slot
            had[n] += 1
            t += 1
            slot += 1
        done = {n: done[n] + had[n] for n in left}
        left = {n: left[n] - had[n] for n in left if left[n] > had[n]}
    return out


def test_mix(spark):
    docs = D.table(spark, extra=True)
    got = source_mixing.mix(docs, block_rows=3).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((r[0], r[3] or "") for r in D.rows())
    assert all(r.release <= r.slot < r.deadline for r in got)
    counts = Counter(r[3] or "" for r in D.rows())
    want = plain_slots(counts, 3, source_mixing.tempered(counts))
    assert {(r.source, r.block): r.slot for r in got} == want
    ranks = Counter((r.source, r.rank) for r in got)
    assert set(ranks) == {(n, i) for n, c in counts.items() for i in range(c)} and max(ranks.values()) == 1 and all(r.block == r.rank // 3 for r in got)
    ordered = source_mixing.in_mixed_order(docs, block_rows=3)
    assert ordered.columns == docs.columns and ordered.count() == docs.count()
    by_slot = defaultdict(set)
    for r in got:
        by_slot[r.slot].add(r.doc_id)
    place = 0
    rows = [r.doc_id for r in ordered.collect()]
    for slot in sorted(by_slot):
        n = sum(1 for r in got if r.slot == slot)
        assert set(rows[place : place + n]) == by_slot[slot]
        place += n
    assert source_mixing.mix(D.empty(spark)).count() == 0
    assert {r.source for r in source_mixing.mix(docs.withColumn("source", F.when(F.col("source") != "src0", F.col("source")).otherwise(F.when(F.col("doc_id") % 2 == 0, "")))).collect()} >= {""}


@pytest.mark.parametrize("ranges", [8, 4096])
def test_rows_keep_within_one_block_of_their_share(spark, monkeypatch, ranges):
    """Twenty equal sources and two of other sizes: after each slot, in rows."""
    monkeypatch.setattr(source_mixing, "RANGE_ROWS", ranges)
    rows = [(i, f"s{i % 20}") for i in range(8000)] + [(10_000 + i, "large") for i in range(3000)] + [(20_000 + i, "small") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(3)
    counts = Counter(s for _, s in rows)
    weights = dict.fromkeys(counts, 1.0)
    got = source_mixing.mix(docs, weights=weights).collect()
    assert {(r.source, r.block): r.slot for r in got} == plain_slots(counts, 64, weights)
    assert all(n == 64 for (s, b), n in Counter((r.source, r.block) for r in got).items() if b < counts[s] // 64)
    first = source_mixing.phases({n: -(-c // 64) for n, c in counts.items()}, weights)[0]
    had, per_slot = dict.fromkeys(counts, 0), defaultdict(Counter)
    for r in got:
        per_slot[r.slot][r.source] += 1
    end = sum(first.blocks.values())
    for t in range(end - len(counts)):  # the last block of a source may be short
        for n, k in per_slot[t].items():
            had[n] += k
        for n, share in first.share.items():
            assert abs(had[n] - 64 * (t + 1) * share / sum(first.share.values())) < 64 or had[n] == counts[n]


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "MOST_SOURCES", 5)
    docs = spark.range(30).selectExpr("id as doc_id", "cast(id % 6 as string) as source")
    with pytest.raises(ValueError, match="more than 5"):
        source_mixing.mix(docs)


def test_mix_spreads_rows_without_keys_and_with_a_common_one(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "RANGE_ROWS", 64)
    rows = [(None, "a")] * 600 + [(7, "a")] * 700 + [(i, "a") for i in range(1000, 1200)] + [(i, None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = source_mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s or "") for i, s in rows)
    assert max(Counter((r.source, r.block) for r in got).values()) == 64
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_positions_are_those_of_the_files(spark, tmp_path):
    docs = D.table(spark)
    ordered = source_mixing.in_mixed_order(docs, block_rows=3).repartitionByRange(4, "doc_id").sortWithinPartitions("text")
    ordered.write.parquet(f"{tmp_path}/out")
    got = source_mixing.with_positions(spark.read.parquet(f"{tmp_path}/out")).collect()
    assert sorted(r.position for r in got) == list(range(docs.count()))
    plain = source_mixing.with_positions(spark.createDataFrame(D.rows(), D.SCHEMA).coalesce(1)).collect()  # no files: written first
    assert [r.doc_id for r in sorted(plain, key=lambda r: r.position)] == [r[0] for r in D.rows()]


def test_mix_of_a_very_long_text(spark):
    docs = D.table(spark, [(1, "word " * 400_000, "en", "a", 1), (2, "b", "en", "b", 1)])
    assert sorted(r.doc_id for r in source_mixing.in_mixed_order(docs).collect()) == [1, 2]


def test_pipeline_of_an_empty_table_and_of_clashing_columns(spark, sf, tmp_path):
    D.empty(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    D.table(spark, extra=True).write.parquet(f"{tmp_path}/more/documents.parquet")
    more = sorted(map(tuple, corpus_pipeline.run(spark, f"{tmp_path}/more").collect()))
    last = {(r[1] or "").translate(D.LOWER): r[0] for r in sorted(D.rows(), key=lambda r: r[0]) if any(c.isalpha() for c in r[1] or "")}
    assert {r[0] for r in more} == {c for _, _, c in plain_components([(i, t) for t, i in last.items()])} and len(more) == len({r[0] for r in more})
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r[0]: r[1] for r in D.rows()}
    for doc, n, ids_sha, text_sha, _ in more:
        ids = sp.encode(texts[doc], add_eos=True)
        assert (n, ids_sha, text_sha) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


def test_pipeline_stages(spark, sf):
    docs = D.table(spark)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf))
        kept.append({r.doc_id for r in out.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out
    texts = {r[0]: r[1] for r in D.rows()}
    assert kept[0] == {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    last = {}
    for i in kept[0]:
        low = texts[i].translate(D.LOWER)
        last[low] = max(last.get(low, -1), i)
    assert kept[1] == set(last.values())
    assert kept[2] == {c for _, _, c in plain_components([(i, texts[i]) for i in kept[1]])}
    assert kept[2] == kept[3] == kept[4]


def test_pipeline_rows_follow_the_mix(spark, tmp_path):
    """run() gives each document its position, and positions follow the slots of the mix."""
    rnd = random.Random(12)
    source = {i: "abc"[(i > 1300) + (i > 1700)] for i in range(1900)}
    rows = [(i, " ".join(f"{rnd.choice(D.WORDS['en'])} {''.join(rnd.choices('abcdefgh', k=6))}" for _ in range(8)), "en", s, 1) for i, s in source.items()]
    spark.createDataFrame(rows, D.SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "position").collect()
    assert sorted(r.position for r in got) == list(range(len(got))) and len(got) == len({r.doc_id for r in got}) > 1800
    kept = spark.createDataFrame([(r.doc_id, source[r.doc_id]) for r in got], "doc_id long, source string")
    slots = {r.doc_id: (r.slot, r.rank) for r in source_mixing.mix(kept).collect()}
    order = [slots[r.doc_id] for r in sorted(got, key=lambda r: r.position)]
    assert order == sorted(order)
