"""Catalogs, children and studies on small tables."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import portal, resolve, sampling, studies, tracking
from ledgerflow.plans.registry import QUERIES


def test_comparisons_are_named_by_month_or_day(spark):
    days = spark.createDataFrame([("2026-08-23",), ("2026-09-30",), ("2026-10-15",), ("2026-10-31",), ("2026-10-31",)], "snapshot_date string")
    pairs = tracking.consecutive(days)
    assert sorted(map(tuple, pairs.collect())) == [("2026-08-23", "2026-09-30"), ("2026-09-30", "2026-10-15"), ("2026-10-15", "2026-10-31")]
    fresh = {r.after_date: (r.comparison_id, r.conflict) for r in tracking.comparison_ids(pairs).collect()}
    assert fresh == {"2026-09-30": ("2026-09", False), "2026-10-15": ("2026-10-15", False), "2026-10-31": ("2026-10", False)}
    held = spark.createDataFrame([("2026-10", "2026-09-30", "2026-10-15"), ("2026-09", "2026-01-01", "2026-09-30")], "comparison_id string, before_date string, after_date string")
    again = {r.after_date: (r.comparison_id, r.conflict) for r in tracking.comparison_ids(pairs, held).collect()}
    assert again == {"2026-09-30": ("2026-09", True), "2026-10-15": ("2026-10", True), "2026-10-31": ("2026-10", True)}
    assert tracking.comparison_ids(pairs.limit(0)).count() == 0


def test_index_without_snapshots_and_with_one(spark):
    none = spark.createDataFrame([], "before_date string, after_date string, comparison_id string")
    changes = spark.createDataFrame([], "before_date string, after_date string, record_identity string")
    alerts = spark.createDataFrame([], "before_date string, after_date string, severity string")
    for days, status in (([], "empty"), (["2026-08-31"], "baseline_only")):
        catalog = spark.createDataFrame([(d,) for d in days], "snapshot_date string")
        (row,) = tracking.tracker_index(catalog, none, changes, alerts).collect()
        assert (row.status, row.snapshots, row.comparison_id, row.critical_alerts) == (status, len(days), None, 0)


def test_nothing_is_overdue_before_the_first_required_month(spark):
    days = spark.createDataFrame([("2026-09-30",)], "snapshot_date string")
    due = lambda today: [r.month_end for r in tracking.overdue_months(days, F.to_date(F.lit(today)), "2026-08-31").orderBy("month_end").collect()]
    assert due("2026-08-30") == [] and due("2026-09-01") == ["2026-08-31"] and due("2026-11-02") == ["2026-08-31", "2026-10-31"]


def test_details_never_erase(spark):
    records = spark.createDataFrame([(1, "R1", "old"), (2, "R2", "old")], "id int, record_number string, record_status string")
    details = spark.createDataFrame([(1, {"status": "  ", "job value": "($1,234.50)", "address": "12B N Bay Ave, LAKETOWN 33602-1234"})], "id int, values map<string,string>")
    got = {r.id: r for r in portal.enriched(records, details, "id").collect()}
    assert (got[1].record_status, float(got[1].valuation), got[1].street_number, got[1].postal_code) == ("old", -1234.5, "12B", "33602")
    assert got[2].record_number == "R2" and got[2].valuation is None


def test_partitions_merge_once(spark):
    part = spark.createDataFrame([(1, "a", "2020-01-01"), (None, "x", "2020-01-01")], "id int, v string, seen string")
    rows = [df.withColumn("first", F.col("seen")).withColumn("last", F.col("seen")) for df in (part, part, spark.createDataFrame([(1, None, "2021-01-01")], "id int, v string, seen string"))]
    assert [tuple(r) for r in portal.merged_partitions(rows, "id", "seen", "first", "last").select("id", "v", "first", "last").collect()] == [(1, "a", "2020-01-01", "2021-01-01")]
    assert portal.distinct_paths(["/b/", "/a", "/b"]) == ["/a", "/b"]


def test_studies(spark, sf):
    got = QUERIES["study_sample"](spark, sf).collect()
    sizes = Counter(r.sampling_stratum for r in got)
    assert len(got) == 300 and all(sizes[r.sampling_stratum] == r.quota <= r.population for r in got)
    assert sum(r.second_review for r in got) == 75
    assert got and sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["study_sample"](spark, sf).collect()))
    rows = spark.createDataFrame([(i, "x") for i in range(20)], "id int, t string")
    chosen = studies.portfolio(rows, "id", "c", F.col("id") < 3, 5, 4, 1).collect()
    assert Counter(r.risk_tier for r in chosen) == {"elevated": 3, "control": 4} and len({r.id for r in chosen}) == 7


def test_two_phases_share_no_row_and_quotas_add_up(spark, sf):
    draws = QUERIES["two_phase_draw"](spark, sf).collect()
    assert len({r.doc_id for r in draws}) == len(draws) and {r.phase for r in draws} == {"development", "holdout"}
    quotas = QUERIES["proportional_quota"](spark, sf).collect()
    total = sum(r.population for r in quotas)
    assert sum(r.quota for r in quotas) == max(len(quotas), total // 10) and all(1 <= r.quota <= r.population for r in quotas)
    assert all(abs(r.quota - r.population / 10) <= 1.5 or r.quota == 1 for r in quotas)


def test_similar_addresses_meet_across_the_edges_of_spans(spark):
    """Pairs of neighbours on street 12 and up, so many days apart, starting anywhere in a span."""
    gaps = [(start, gap) for start in range(0, 46, 5) for gap in (-46, -45, 0, 44, 45, 46)]
    day = lambda c: F.date_add(F.to_date(F.lit("2026-03-01")), F.col(c)).alias("day")
    rows = spark.createDataFrame([(i, str(1000 + i), s, s + g) for i, (s, g) in enumerate(gaps)], "id long, house string, a int, b int")
    side = lambda street, c: rows.select("id", F.lit(None).cast("string").alias("number"), F.lit(None).cast("string").alias("parcel"), F.concat_ws(" ", "house", F.lit(street)).alias("address"), day(c))
    got = {r.id: r.method for r in resolve.crosswalk(side("NORTH BAY AVE", "a"), side("NORTH BAY AVENUE", "b")).collect()}
    assert got == {i: "similar_address_candidate" if abs(g) <= 45 else "none" for i, (_, g) in enumerate(gaps)}


def test_rows_without_a_stratum_are_drawn_too(spark):
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else "ab"[i % 2]) for i in range(80)], "id long, s string")
    sizes = sampling.stratum_sizes(rows, "s")
    assert sizes == {None: 20, "a": 20, "b": 40}
    quotas = sampling.allocate(sizes, 8)
    assert quotas == {None: 2, "a": 2, "b": 4}
    got = sampling.stratified(rows, "id", "s", quotas, 1, "study").collect()
    assert Counter(r.s for r in got) == quotas and all(r.population == sizes[r.s] for r in got)
    both = sampling.two_phase(rows, "id", "s", 8, 8, 1, "study").collect()
    assert len({r.id for r in both}) == 16 and Counter(r.s for r in both)[None] == 4
    drawn = studies.study(rows, "id", 12, 1, "study", stratum="s").collect()
    assert len(drawn) == 12 and sum(r.second_review for r in drawn) == 3
    only = sampling.stratified(rows, "id", "s", {None: 5}, 1, "study").collect()
    assert len(only) == 5 and {r.s for r in only} == {None}


def test_too_many_strata_are_refused(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MOST_STRATA", 3)
    rows = spark.range(10).selectExpr("id", "cast(id % 5 as string) s")
    with pytest.raises(ValueError, match="more than 3"):
        sampling.stratum_sizes(rows, "s")
    with pytest.raises(ValueError, match="more than 3"):
        sampling.stratified(rows, "id", "s", dict.fromkeys("01234", 1), 1, "study")
