"""Similarity by matching blocks equals the standard library's."""

from __future__ import annotations

import random
from difflib import SequenceMatcher
from itertools import product

from pyspark.sql import functions as F

from ledgerflow.functions import matching, text
from ledgerflow.operators import resolve

ADDRESSES = ["12 NORTH BAY AVE", "12 N BAY AVENUE", "1200 BAY AVE", "12 BAY NORTH AVE", "99 HARBOR DR UNIT 4", "99 HARBOUR DRIVE #4", "", " ", "É RUE 3", "\U0001f600\U0001f600 4"]


def pairs():
    rnd = random.Random(5)
    out = [(a, b) for a in ADDRESSES for b in ADDRESSES]
    out += [("".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 40))), "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 40)))) for _ in range(600)]
    long = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    return [*out, (long, long[50:350]), (long, long[:150]), (long[:150], long), (long[::-1], long[:199]), (long[::-1], long[:200])]


def test_ratios(spark, monkeypatch):
    both = pairs()
    want = [SequenceMatcher(None, a, b).ratio() for a, b in both]
    got = matching.ratios([a for a, _ in both], [b for _, b in both])
    assert got.tolist() == want
    monkeypatch.setattr(matching, "CELLS", 200)
    assert matching.ratios([a for a, _ in both], [b for _, b in both]).tolist() == want
    assert matching.ratios([], []).tolist() == []
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate([*both, (None, "x"), ("x", None)])], "i int, a string, b string").repartition(3)
    told = {r.i: r.ratio for r in rows.select("i", matching.matching_ratio(F.col("a"), F.col("b")).alias("ratio")).collect()}
    assert [told[i] for i in range(len(both) + 2)] == [*want, None, None]


def test_the_crosswalk_takes_its_likeness(spark):
    side = lambda i, address: spark.createDataFrame([(i, None, None, address, "2026-01-01")], "id long, number string, parcel string, address string, d string").selectExpr("id", "number", "parcel", "address", "to_date(d) day")
    left, right = side(1, "12 BAY NORTH AVE"), side(2, "12 BAY NORTHERN AVE")
    (row,) = resolve.crosswalk(left, right).collect()
    assert (row.method, row.score) == ("similar_address_candidate", round(0.55 + 0.25 * SequenceMatcher(None, "12 BAY NORTH AVE", "12 BAY NORTHERN AVE").ratio(), 3))
    (row,) = resolve.crosswalk(left, right, likeness=text.similarity, least_similarity=0.9).collect()
    assert row.method == "none"


def test_the_crosswalk_counts_rows_before_they_meet(spark):
    """Many rows of one address give what pairs of them give, though few rows leave any join; ids with several rows count once."""
    rnd = random.Random(5)
    rows = lambda n, first: [(first + i, rnd.choice(["N1", "N2", None, None]) if i % 9 == 0 else None, rnd.choice(["P1", "P2", None]) if i % 7 == 0 else None, rnd.choice(["12 BAY AVE", "12 BAY AVENU", "13 BAY AVE", None]), rnd.choice([1, 20, 50, 90, None])) for i in range(n)]
    lefts, rights = rows(150, 0), rows(150, 1000)
    lefts += [(3, None, "P1", "12 BAY AVE", 1), (3, None, None, "12 BAY AVENU", 50)] + lefts[:2]
    rights += [(1003, "N2", None, "12 BAY AVE", 20), (1003, None, None, "12 BAY AVENU", 1)] + rights[:2]
    best = {}
    for a, b in product(lefts, rights):
        near = None not in (a[3], a[4], b[3], b[4]) and abs(a[4] - b[4]) <= 45 and a[3][:2] == b[3][:2]
        like = SequenceMatcher(None, a[3], b[3]).ratio() if near else 0.0
        score = max(1.0 * (a[1] is not None and a[1] == b[1]), 0.95 * (a[2] is not None and a[2] == b[2]), (0.9 if a[3] == b[3] else round(0.55 + 0.25 * like, 3) * (like >= 0.84)) if near else 0.0)
        if score:
            best.setdefault(a[0], {}).setdefault(b[0], 0.0)
            best[a[0]][b[0]] = max(best[a[0]][b[0]], score)
    want = []
    for a in lefts:
        of = best.get(a[0], {})
        top = [r for r, s in of.items() if s == max(of.values())]
        want.append((a[0], min(top) if len(top) == 1 else None, len(top), max(of.values(), default=0.0)))
    frame = lambda rows: spark.createDataFrame(rows, "id long, number string, parcel string, address string, d int").selectExpr("id", "number", "parcel", "address", "date_add(date'2026-01-01', d) day")
    out = resolve.crosswalk(frame(lefts), frame(rights))
    key = lambda t: (t[0], t[1] or -1)
    assert sorted(((r.id, r.target_id, r.targets, r.score) for r in out.collect()), key=key) == sorted(want, key=key)
    many = spark.range(40_000).selectExpr("id", "cast(null as string) number", "cast(null as string) parcel", "'12 BAY AVE' address", "date'2026-01-01' day")
    told = resolve.crosswalk(many, many.withColumn("address", F.lit("12 BAY AVENU"))).groupBy("targets", "method").count().collect()  # 1.6e9 pairs
    assert [tuple(r) for r in told] == [(40_000, "similar_address_candidate_ambiguous", 40_000)]
