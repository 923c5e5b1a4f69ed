"""Preferred records, categories, positions, usage and rules on small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.text import token
from ledgerflow.operators import audit, portal, quality, ranges, resolve, sampling
from ledgerflow.plans.registry import QUERIES


def test_the_preferred_record_keeps_its_values(spark):
    schema = "id string, module string, number string, url string, note string, other string, seen string, first string, last string"
    rows = [
        ("r1", "B", "x-1", None, "early", None, "2020-01-01", "2020-01-01", "2020-01-05"),
        ("r2", "b ", "X1", "u", " ", None, "2020-02-01", "2020-02-01", "2020-02-01"),  # has a link
        ("r3", "B", "X 1", "", "late", "o", "2020-03-01", None, "2021-01-01"),
        ("r4", "B", None, "u", "n", None, "2020-01-01", "2020-01-01", "2020-01-01"),  # no number: alone
        ("r5", None, "X1", None, None, None, None, None, None),
        ("r6", "C", "9", "u", "n", None, "2020-01-01", "2020-01-01", "2020-01-01"),
        ("r7", "C", "9", "u", "n", None, "2020-01-01", "2020-01-02", "2020-01-01"),  # a tie: the larger id
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.id: r for r in resolve.preferred(df, "module", token(F.col("number")), ("module", "number", "url", "note", "other"), "url", "seen", "id", "first", "last").collect()}
    assert set(got) == {"r2", "r4", "r5", "r7"}
    best = got["r2"]
    assert (best.url, best.note, best.other, best.first, best.last, best.merged_records, best.seen) == ("u", "early", "o", "2020-01-01", "2021-01-01", 3, "2020-02-01")
    assert got["r7"].merged_records == 2 and got["r4"].merged_records == 1
    assert resolve.preferred(df.limit(0), "module", token(F.col("number")), ("module",), "url", "seen", "id", "first", "last").count() == 0


def test_categories_draw_in_order_and_name_all(spark):
    rows = spark.range(100)
    kinds = {"even": F.col("id") % 2 == 0, "tens": F.col("id") % 10 == 0, "unknown": F.lit(None).cast("boolean"), "rest": F.lit(True)}
    got = sampling.by_category(rows.withColumn("m", F.array_join(sampling.matched_categories(kinds), ";")), "id", kinds, {"even": 45, "tens": 9, "unknown": 5, "rest": 1000}, 1, "s").collect()
    assert len(got) == 100 and len({r.id for r in got}) == 100
    by = {k: [r for r in got if r.category == k] for k in kinds}
    assert len(by["even"]) == 45 and all(r.id % 10 == 0 for r in by["tens"]) and not by["unknown"]
    assert all(r.m == ";".join(k for k, ok in (("even", r.id % 2 == 0), ("tens", r.id % 10 == 0), ("rest", True)) if ok) for r in got)


def test_positions_follow_the_order(spark):
    rows = spark.createDataFrame([(i % 7 or None, i) for i in range(500)], "a int, b int").repartition(5)
    got = sorted(ranges.positions(rows, ["a", "b"]).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, 501))
    assert [(r.a, r.b) for r in got] == sorted(((i % 7 or None, i) for i in range(500)), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert ranges.positions(rows.limit(0), ["a"]).count() == 0


def test_unknown_usage_exceeds_nothing(spark):
    calls = spark.createDataFrame([("a", "10", None), ("a", "5", "x"), ("b", "16", "2"), ("b", None, "2"), ("c", "nan", "9")], "run string, tokens string, seconds string")
    got = {r.run: (r.calls, r.tokens, r.seconds, r.exceeded, r.within_limits) for r in audit.usage_limits(calls, "run", {"tokens": 15, "seconds": 5}, once=["seconds"]).collect()}
    assert got == {"a": (2, 15.0, None, "", True), "b": (2, 16.0, 2.0, "tokens", False), "c": (1, None, 9.0, "seconds", False)}


def test_semantic_rules_count_nulls_as_faults(spark):
    truth = spark.createDataFrame([("yes", "A1"), ("yes", "C"), ("no", "C"), (None, None), ("yes", None)], "done string, grade string")
    told = lambda df: {r["check"]: r.faults for r in df.collect()}
    assert told(quality.claim_rules(truth, "done", "grade")) == {"no_completion_without_grade": 2, "derived_grades_only": 3}
    events = spark.createDataFrame([("permit_issued",), (None,), (quality.CLOSING_EVENTS[0],)], "kind string")
    assert told(quality.event_rules(events, "kind")) == {"no_forbidden_events": 2}
    pairs = spark.createDataFrame([(False, "pending"), (True, "pending"), (None, "pending"), (False, None)], "merged boolean, status string")
    assert told(quality.proposal_rules(pairs, "merged", "status", "pending")) == {"proposals_never_merged": 3}


@pytest.mark.parametrize("name", ["ordered_changes", "ordered_alerts"])
def test_ordered_queries_number_every_row_once(spark, sf, name):
    got = [r.position for r in QUERIES[name](spark, sf).collect()]
    assert sorted(got) == list(range(1, len(got) + 1))


def _optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_children_are_read_once_whatever_is_asked_of_them(spark, sf):
    """A condition on named values does not build the map of values anew, and the checks pass once over the rows."""
    rows = spark.range(20).selectExpr("id parent", "map_from_arrays(array('id', 'type'), array(if(id % 2 = 0, ' a  b ', ' '), null)) values")
    kept = portal.children(rows, "parent").where(~portal.is_layout())
    assert _optimised(kept).count("map_from_arrays") == 1
    assert kept.count() == 10 and kept.select("source_id").distinct().collect()[0][0] == "a b"
    assert _optimised(QUERIES["child_checks"](spark, sf)).count("map_from_arrays") == 1


def test_child_checks_of_rows_without_parents(spark):
    rows = spark.createDataFrame([("1", None, "s", "k"), ("2", None, "s", "k"), ("2", "p", "s", "k"), ("3", "q", None, None)], "child_id string, parent string, source_id string, kind string")
    known = spark.createDataFrame([("p",), ("p",), ("1",)], "parent string")
    out = portal.child_checks(rows, known, "parent", rows.columns, ("k",), "kind")
    assert {r["check"]: r["faults"] for r in out.collect()} == {"columns_in_order": 0, "child_ids": 1, "parent_known": 1, "parent_there": 2, "labels": 1, "no_layout_rows": 1}
    assert {r["faults"] for r in portal.child_checks(rows.limit(0), known, "parent", rows.columns, ("k",), "kind").collect()} == {0}


def test_sketched_overlap_deals_its_exact_side_once(spark, sf):
    """The exact counts are made in parts of a bounded number of rows, not in the session's partitions."""
    plan = QUERIES["sketched_overlap"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "hashpartitioning(record_identity" in x and "REPARTITION_BY_NUM" in x]) == 1
    assert not [x for x in plan.splitlines() if "ENSURE_REQUIREMENTS" in x and "record_identity" in x]
