"""Running totals, exact quantiles and sketches against plain versions."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerflow.operators import analysis, ranges, sketches, spread


def values(seed=1):
    rnd = random.Random(seed)
    rows = [("hot", float(rnd.choice([1, 1, 2, rnd.randrange(1000)]))) for _ in range(3000)]
    rows += [(g, rnd.random()) for g in ("a", "b", None) for _ in range(rnd.randint(1, 40))]
    return rows + [("one", 5.0), ("none", None), ("none", None), ("some", None), ("some", 2.5), ("some", 3.5), (None, None)]


def test_running_totals_of_a_group_over_many_tasks(spark):
    rows = spark.createDataFrame([(g, v, i % 5) for i, (g, v) in enumerate(values())], "g string, v double, w int")
    got = ranges.running(rows, ["g"], ["v", "w"], ranges.F.col("w")).collect()
    assert len(got) == rows.count() and len(got[0]) == 5
    groups = defaultdict(list)
    for r in got:
        groups[r.g].append(r)
    for rs in groups.values():
        rs.sort(key=lambda r: (r.v is not None, r.v or 0, r.w, r._before))
        total = 0
        for r in rs:
            assert r._before == total and r._total == sum(x.w for x in rs)
            total += r.w
    assert ranges.running(rows.limit(0), ["g"], ["v"]).count() == 0
    place = sorted(r._before for r in ranges.running(rows.where("g = 'hot'"), ["g"], ["v"]).collect())
    assert place == list(range(3000))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranges_do_not_grow_with_the_table(spark, monkeypatch, by):
    """Numbering deals rows into ranges and tasks of a bounded number of rows, whatever the session's partitions; rows come once from their source."""
    monkeypatch.setattr(spread, "PART_ROWS", 100)
    read = spark.sparkContext.accumulator(0)

    def one(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.range(6000, numPartitions=3).selectExpr("if(id % 2 = 0, null, 'a') g", "id * 7919 % 6007 v").mapInArrow(one, "g string, v long")
    got = ranges.running(rows, by, ["v"]) if by else ranges.positions(rows, ["g", "v"])
    sizes = [r["count"] for r in got.groupBy(ranges.F.spark_partition_id()).count().collect()]
    assert len(sizes) > 25 and max(sizes) < 900
    assert by or read.value == 6000
    place = sorted(r[0] for r in got.select("_before" if by else "position").collect())
    assert place == ([i for i in range(3000) for _ in "ab"] if by else list(range(1, 6001)))


def test_quantiles_are_exact(spark):
    data = values()
    rows = spark.createDataFrame(data, "g string, v double")
    shares = {"low": 0.1, "median": 0.5, "high": 0.99, "least": 0.0, "most": 1.0}
    got = {r.g: r for r in ranges.exact_quantiles(ranges.value_counts(rows, ["g"], "v"), ["g"], "v", shares).collect()}
    assert set(got) == {g for g, _ in data}
    for g, r in got.items():
        known = [v for h, v in data if h == g and v is not None]
        for name, share in shares.items():
            assert r[name] == (pytest.approx(np.quantile(known, share)) if known else None)


def test_sketched_medians_stay_within_the_stated_rank_error(spark):
    rnd = random.Random(2)
    data = [(f"m{i % 7}", rnd.choice("ab"), rnd.gauss(0, 1000)) for i in range(30_000)] + [("m1", "c", None)]
    rows = spark.createDataFrame(data, "month string, kind string, v double")
    kept = sketches.quantile_sketches(rows, ["month", "kind"], "v")
    for r in sketches.merged_quantiles(kept, ["kind"], {"median": 0.5, "high": 0.9}).collect():
        known = np.array([v for _, k, v in data if k == r.kind and v is not None])
        assert r.n == len(known)
        for got, share in ((r.median, 0.5), (r.high, 0.9)):
            assert got is None if not len(known) else abs((known <= got).mean() - share) <= sketches.RANK_ERROR


def test_sketched_overlaps_of_any_two_dates(spark, monkeypatch):
    monkeypatch.setattr(sketches, "LOG_PLACES", 10)
    rnd = random.Random(3)
    members = {(d, s): {f"{s}{i}" for i in range(n) if rnd.random() < 0.8} for s, n in (("big", 9000), ("small", 50)) for d in ("2026-01-31", "2026-02-28", "2026-03-31")}
    members["2026-03-31", "new"] = {"x"}
    rows = spark.createDataFrame([(d, s, m) for (d, s), ms in members.items() for m in ms] + [("2026-01-31", "big", None)], "snapshot_date string, source_name string, record_identity string")
    kept = sketches.set_sketches(rows, ["snapshot_date", "source_name"], "record_identity", 10)
    pairs = [("2026-01-31", "2026-03-31"), ("2026-02-28", "2026-03-31")]
    got = {(r.before_date, r.source_name): r for r in sketches.overlaps(kept, "snapshot_date", pairs, ["source_name"]).collect()}
    assert set(got) == {(a, s) for a, _ in pairs for s in ("big", "small", "new")}
    for (day, source), r in got.items():
        a, b = members.get((day, source), set()), members["2026-03-31", source]
        truth = (len(a), len(b), len(a & b), len(b - a), len(a - b))
        told = (r.before_count, r.after_count, r.retained, r.new_records, r.disappeared_records)
        if source == "big":
            assert all(abs(x - y) <= 3 * len(a | b) / 32 + 1 for x, y in zip(told, truth, strict=True)) and told != truth
        else:
            assert told == truth  # fewer members than places: exact
    total = sketches.overlaps(sketches.set_sketches(rows, ["snapshot_date"], "record_identity", 10), "snapshot_date", pairs).collect()
    assert len(total) == 2 and all(r.churn is not None for r in total)
    with pytest.raises(ValueError):
        sketches.overlaps(kept, "snapshot_date", [("2026-03-31", "2026-01-31")])
    exact = analysis.exact_overlap(rows.where("record_identity is not null"), pairs).where("source_name = 'big' and before_date = '2026-01-31'").first()
    a, b = members["2026-01-31", "big"], members["2026-03-31", "big"]
    assert (exact.retained, exact.new_records, exact.disappeared_records) == (len(a & b), len(b - a), len(a - b))
