"""Cells that split: points piled up in one place and in one street, against plain versions."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import spatial, spread


def square(x, y, w):
    return [[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]


def scene(seed=4):
    rnd = random.Random(seed)
    points = [(i, 1.0, 1.0) for i in range(700)]  # one place
    points += [(1000 + i, 2.0 + rnd.random() * 1e-3, 2.0 + rnd.random() * 1e-3) for i in range(900)]  # one street
    points += [(3000 + i, rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for i in range(400)] + [(9000, None, 1.0), (9001, float("nan"), 1.0)]
    shapes = [(i, square(rnd.uniform(-5, 5), rnd.uniform(-5, 5), 0.6)) for i in range(60)]
    shapes += [(100 + i, square(2.0 + rnd.random() * 1e-3, 2.0 + rnd.random() * 1e-3, 1e-4)) for i in range(60)]
    shapes += [(200 + i, square(0.9, 0.9, 0.2)) for i in range(5)]
    return points, shapes


def frames(spark):
    points, shapes = scene()
    return spark.createDataFrame(points, "p_id long, lon double, lat double").where("not isnan(lon) or lon is null"), spark.createDataFrame(shapes, "s_id long, ring array<array<double>>")


def test_contains_in_split_cells(spark, monkeypatch):
    monkeypatch.setattr(spread, "LEAST", 16)
    points, shapes = scene()
    got = [(r.p_id, r.s_id) for r in spatial.contains(*frames(spark), 0.5).select("p_id", "s_id").collect()]
    want = [(p, s) for p, x, y in points if x is not None and x == x for s, ring in shapes if ring[0][0] <= x < ring[1][0] and ring[0][1] <= y < ring[2][1]]
    assert sorted(got) == sorted(want) and len(got) > 3500


def test_piled_up_points_are_dealt_evenly(spark, monkeypatch):
    """No cell or part of one gets more than a few times the limit, whether space parts the points or only numbers do."""
    monkeypatch.setattr(spread, "LEAST", 16)
    seen = {}

    def spied(rows, table, on, by, how="inner", hot=None):
        small = F.broadcast(hot)
        part = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*by), F.col("_parts")))
        seen["sizes"] = [r["count"] for r in rows.join(small, on, "left").groupBy(*on, part.alias("part")).count().collect()]
        seen["levels"] = {r.level for r in rows.select("level").distinct().collect()}
        seen["tiles"] = table.count()
        return spread.spread_join(rows, table, on, by, how, hot)

    monkeypatch.setattr(spatial, "spread_join", spied)
    spatial.contains(*frames(spark), 0.5).count()
    assert max(seen["sizes"]) <= 4 * 16 and sum(seen["sizes"]) == 2000
    assert max(seen["levels"]) > 8 and seen["tiles"] < 4000


def test_footprints_by_container_address_and_nearness(spark):
    meter = 1 / 111_195
    b = [(1, square(0.0, 0.0, 50 * meter), "1 A ST"), (2, square(0.0, 0.0, 60 * meter), None), (3, square(0.001, 0.0, 20 * meter), "3 A ST"), (4, square(0.0011, 0.0, 20 * meter), "3 A ST"), (5, square(0.0, 0.01, 10 * meter), "5 A ST"), (6, square(0.0, 0.01, 10 * meter), "6 A ST")]
    places = [
        ("a", 11, 10 * meter, 10 * meter, "3 A ST"),  # inside of two: its address does not matter
        ("a", 10, 11 * meter, 11 * meter, None),  # the same activity and buildings, from a smaller place
        ("b", 12, 0.001 - 20 * meter, 5 * meter, "3 A ST"),  # two of its address, near enough
        ("c", 13, 0.0 + 5 * meter, 0.01 - 10 * meter, None),  # two equally near: the smaller id
        ("d", 14, 0.0, 0.01 - 100 * meter, None),  # nothing near enough
        ("e", 15, 0.002, 0.002, "3 A ST"),  # its address is a candidate but too far, so the nearest is not looked for
        ("f", 16, None, None, "1 A ST"),
    ]
    df = spark.createDataFrame(places, "activity string, p_id long, lon double, lat double, address string")
    buildings = spark.createDataFrame(b, "s_id long, ring array<array<double>>, address string")
    got = sorted((r.activity, r.s_id, r.p_id, r.method, r.confidence) for r in spatial.footprints(df, buildings, 0.003).collect())
    assert got == [("a", 1, 10, "containing", "high"), ("a", 2, 10, "containing", "high"), ("b", 3, 12, "same_address", "high"), ("b", 4, 12, "same_address", "high"), ("c", 5, 13, "nearest", "medium")]
    assert spatial.footprints(df.limit(0), buildings, 0.003).count() == 0 and spatial.footprints(df, buildings.limit(0), 0.003).count() == 0


def test_meeting_is_once_per_pair(spark):
    points, shapes = frames(spark)
    boxed = spatial._boxed(shapes, "ring")
    got = Counter((r.p_id, r.s_id) for r in spatial.meet(points, boxed, 0.3).select("p_id", "s_id").collect())
    assert max(got.values()) == 1


def test_nearest_meets_few_targets_where_many_are_in_reach(spark, monkeypatch):
    """A town, a hamlet, a pile in one place and the open land: the same as all pairs give, from few of them."""
    rnd = random.Random(9)
    targets = [(i, rnd.gauss(0, 0.002), rnd.gauss(0, 0.002)) for i in range(1500)] + [(2000 + i, rnd.uniform(-0.2, 0.2), rnd.uniform(-0.2, 0.2)) for i in range(60)] + [(3000 + i, 0.1, 0.1) for i in range(300)]
    points = [(i, rnd.gauss(0, 0.003), rnd.gauss(0, 0.003)) for i in range(150)] + [(500 + i, rnd.uniform(-0.3, 0.3), rnd.uniform(-0.3, 0.3)) for i in range(50)] + [(900, 0.1, 0.1001), (901, None, 0.0), (902, 9.0, 9.0)]
    p, s = spark.createDataFrame(points, "p_id long, lon double, lat double"), spark.createDataFrame(targets, "s_id long, s_lon double, s_lat double")
    distance = spatial.haversine_m(F.col("lon"), F.col("lat"), F.col("s_lon"), F.col("s_lat"))
    pairs = p.crossJoin(s).withColumn("m", distance).where("m <= 20000").groupBy("p_id").agg(F.min(F.struct("m", "s_id")).alias("m"))
    want = {r.p_id: r.m.s_id for r in pairs.collect()}
    met, seen = spatial._met, []

    def spied(*args):
        out = met(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(spatial, "_met", spied)
    got = {r.p_id: r.s_id for r in spatial.nearest(p, s, 20000.0).collect()}
    assert got == want and got[900] == 3000 and 902 not in got
    assert seen[0] < 20 * len(points) and sum(seen) < 80_000 and len(seen) > 2  # all within cells of the radius: more than 300,000


def test_rings_that_are_their_boxes_and_others(spark):
    rings = [square(0, 0, 2), [[0, 0], [2, 0], [0, 2], [0, 0]], [[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]], [[0, 0], [2, 0], [0, 0], [0, 2], [0, 0]], list(reversed(square(0, 0, 2))), square(0, 0, 0)]
    shapes = spark.createDataFrame(list(enumerate([[[float(v) for v in p] for p in r] for r in rings])), "s_id long, ring array<array<double>>")
    assert [r.s_id for r in shapes.where(spatial._is_box(F.col("ring"))).orderBy("s_id").collect()] == [0, 4]
    points = spark.createDataFrame([(i * 10 + j, i / 2, j / 2) for i in range(6) for j in range(6)], "p_id long, lon double, lat double")
    want = {(r.p_id, r.s_id) for r in points.crossJoin(shapes).where(spatial.in_ring(F.col("lon"), F.col("lat"), F.col("ring"))).collect()}
    out = spatial.contains(points, shapes, 1.0)
    assert {(r.p_id, r.s_id) for r in out.collect()} == want and "ring" not in out.columns
    boxes = spatial.contains(points, shapes.where("s_id = 0"), 1.0)
    assert "ArrayFilter" not in boxes._jdf.queryExecution().toString() and boxes.count() == 16


def test_a_row_stands_for_several_matches(spark):
    rows = spark.createDataFrame([(1, 7, 5, 0.0), (1, 3, 1, 2.0), (2, 4, 1, 1.0)], "k long, s_id long, n long, m double")
    got = spatial.prioritised(rows, "k", "s_id", F.lit(1), F.col("m"), F.col("n"))
    assert sorted((r.k, r.s_id, r.alternatives) for r in got.collect()) == [(1, 7, 5), (2, 4, 0)]


def test_footprints_meet_few_buildings_of_a_crowded_cell(spark, monkeypatch):
    """Cells of the containment and nearness are as wide as boxes and reaches, not as the candidates' cells."""
    steps, meet = [], spatial.meet

    def spied(points, regions, step, depth=16):
        steps.append(step)
        return meet(points, regions, step, depth)

    monkeypatch.setattr(spatial, "meet", spied)
    meter = 1 / 111_195
    buildings = spark.createDataFrame([(i, square(i % 20 * 30 * meter, i // 20 * 30 * meter, 10 * meter), f"{i % 7} A ST") for i in range(400)], "s_id long, ring array<array<double>>, address string")
    places = spark.createDataFrame([("a" if i % 2 else None, i, i % 20 * 30 * meter + 12 * meter * (i % 3), i // 20 * 30 * meter + 5 * meter, None) for i in range(400)], "activity string, p_id long, lon double, lat double, address string")
    got = spatial.footprints(places, buildings, 0.003).collect()
    inside = [r for r in got if r.method == "containing"]
    assert {(r.activity, r.s_id, r.p_id) for r in inside} == {("a" if i % 2 else None, i, i) for i in range(0, 400) if i % 3 == 0} and len(got) == len({(r.activity, r.s_id) for r in got})
    assert max(steps) < 0.001


def town(seed=7):
    """Places and buildings with piles, heaps of one activity, rings that are no boxes, two boxes of one id, wide ones, no activity and no place."""
    rnd = random.Random(seed)
    at = lambda: rnd.uniform(0, 0.004)
    buildings = [(i, square(at(), at(), 0.0005), "X" if i % 7 == 0 else None) for i in range(60)]
    buildings += [(100 + i, square(at(), at(), 0.0005 * 3**i), None) for i in range(4)] + [(110, square(0.001, 0.001, 1e-6), None)]
    buildings += [(120, square(0.0, 0.0, 0.0005), None), (120, square(0.0002, 0.0, 0.0005), None), (130, [[0.002, 0.002], [0.003, 0.002], [0.002, 0.003], [0.002, 0.002]], "X")]
    places = [(f"a{rnd.randrange(40)}" if i % 9 else None, i, at(), at(), "X" if i % 3 == 0 else None) for i in range(400)]
    places += [("pile", 1000 + i, 0.002, 0.002, None) for i in range(90)] + [(f"b{i}", 2000 + i, 0.001, 0.001, None) for i in range(90)]
    places += [("a1", 3000, None, 0.001, None), ("a1", 3001, 0.001, float("nan"), None), ("a1", 3002, float("-inf"), 0.001, None)]
    # a place beside and a place in a building, the one beside first
    places += [("c", 4000, 0.0500, 0.0507, "Y"), ("c", 4001, 0.0502, 0.0502, None), ("d", 4002, 0.0502, 0.0502, None), ("d", 4003, 0.0500, 0.0507, "Y")]
    return places, buildings + [(140, square(0.05, 0.05, 0.0005), "Y")]


def belonging(places, buildings):
    """activity and s_id to p_id and method, from all pairs."""
    def holds(ring, x, y):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:])) % 2 == 1

    def apart(ring, x, y):
        mx, my = ((min(p[i] for p in ring) + max(p[i] for p in ring)) / 2 for i in (0, 1))
        h = math.sin(math.radians(y - my) / 2) ** 2 + math.cos(math.radians(y)) * math.cos(math.radians(my)) * math.sin(math.radians(x - mx) / 2) ** 2
        return 2 * 6_371_000 * math.asin(math.sqrt(h))

    out = {}
    for activity, p, x, y, address in sorted(places, key=lambda r: r[1]):
        if x is None or not (math.isfinite(x) and math.isfinite(y)):
            continue
        mine = [(s, "containing") for s, ring, _ in buildings if holds(ring, x, y)]
        mine = mine or [(s, "same_address") for s, ring, a in buildings if a == address and a is not None and apart(ring, x, y) <= 150]
        for s, method in mine:
            out.setdefault((activity, s), (p, method))
    return out


@pytest.mark.parametrize("least", [None, 50])
def test_first_places_of_crowded_buildings(spark, monkeypatch, least):
    if least:  # cells, activities and points dealt over parts
        monkeypatch.setattr(spatial, "PART_ROWS", least)
        monkeypatch.setattr(spatial, "TASK_PAIRS", 20 * least)
    places, buildings = town()
    p = spark.createDataFrame(places, "activity string, p_id long, lon double, lat double, address string")
    b = spark.createDataFrame(buildings, "s_id long, ring array<array<double>>, address string")
    out = spatial.footprints(p, b, 0.003, nearest_m=0.001)
    rows = out.collect()
    want = belonging(places, buildings)
    assert {(r.activity, r.s_id): (r.p_id, r.method) for r in rows} == want and len(rows) == len(want) > 500
    assert want["c", 140] == (4000, "same_address") and want["d", 140] == (4002, "containing")
    # places alone of their activity in a cell: what they are in is neither shuffled nor grouped
    head = out._jdf.queryExecution().executedPlan().toString().partition("Join")
    assert "Union" in head[0] and "Exchange" not in head[0] and "Inner" in head[2].split("\n")[0]
    simple = spatial._first_inside(p.where("p_id >= 2000").select("activity", "p_id", "lon", "lat"), spatial._plain(spatial._boxed(b, "ring").withColumn("is_box", spatial._is_box(F.col("ring"))), "ring", 0.0005)[0], out.select("activity", "s_id").limit(0), 0.0005)
    assert simple[0].count() > 90 and simple[1].count() == 0
