"""Operators on tiny tables whose results are known."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators import analysis, audit, diff, identity, privacy, quality, resolve, review, sampling, spatial
from ledgerflow.sources import readers, sinks

SNAP = "snapshot_date string, source_name string, native_id string, global_id string, object_id string, status string, planned_start string, planned_end string"


def compare(spark, rows):
    df = identity.with_identity(spark.createDataFrame(rows, SNAP))
    return diff.paired(df, [("2026-09-30", "2026-10-31")], ("source_name", "native_id", "status", "planned_start", "planned_end"))


A, B = "2026-09-30", "2026-10-31"


def test_identity_is_told_apart_in_all_snapshots(spark):
    rows = [(A, "s", "X", "g1", "1", "a", None, None), (B, "s", "X", "g1", "9", "b", None, None), (B, "s", "x ", "g2", "2", "c", None, None), (A, "s", "N/A", None, "7", "d", None, None), (A, "s", "OBJECTID-4", "g4", "4", "d", None, None)]
    got = {r.record_identity for r in identity.with_identity(spark.createDataFrame(rows, SNAP)).collect()}
    assert got == {"S|NATIVE|X|GLOBALID|G1", "S|NATIVE|X|GLOBALID|G2", "S|OBJECTID|7", "S|GLOBALID|G4"}
    assert identity.identity_faults(identity.with_identity(spark.createDataFrame(rows, SNAP))).count() == 0


def test_typed_changes(spark):
    rows = [
        (A, "p", "1", "a", "1", "Pending", None, None), (B, "p", "1", "a", "5", "Issued", "2026-01-01", "2026-02-01"),
        (A, "p", "2", "b", "2", "x", "", None), (B, "p", "2", "b", "2", "x", None, ""),
        (A, "p", "3", "c", "3", "x", None, None), (B, "p", "4", "d", "4", "x", None, None),
    ]
    out = diff.changes(compare(spark, rows), semantic={"status_changed": F.when(F.lower("new.status").contains("issued"), "permit_issued").otherwise("")})
    got = {(r.change_type, r.semantic_type, r.changed_fields, r.record_identity) for r in out.collect()}
    assert got == {
        ("status_changed", "permit_issued", "status", "P|NATIVE|1"), ("planned_date_changed", "", "planned_start;planned_end", "P|NATIVE|1"),
        ("record_disappeared", "", "", "P|NATIVE|3"), ("new_record", "", "", "P|NATIVE|4"),
    }
    with pytest.raises(ValueError):
        compare(spark, rows).select() and diff.paired(identity.with_identity(spark.createDataFrame(rows, SNAP)), [(B, A)], ("status",))


def health(spark, before, after, new, gone, source="s"):
    both = spark.createDataFrame([(A, B, i < before, i < before - gone or i >= before, source) for i in range(before + new)], "before_date string, after_date string, o boolean, n boolean, s string")
    side = lambda c: F.when(F.col(c), F.struct(F.col("s").alias("source_name")))
    out = analysis.source_health(both.select("before_date", "after_date", side("o").alias("old"), side("n").alias("new")))
    assert out.first().after_count == after
    return out


def test_churn_and_alerts(spark):
    h = health(spark, 10, 10, 1, 1)
    r = h.first()
    assert (r.retained_records, r.union_size, r.publication_churn) == (9, 11, round(2 / 11, 6))
    assert analysis.source_alerts(h).count() == 0
    fallen = health(spark, 1023, 280, 0, 743)
    codes = {r.alert_code for r in analysis.source_alerts(fallen).collect()}
    assert codes == {"source_count_collapse", "critical_disappearance_rate", "high_publication_churn"}
    assert analysis.alert_levels(fallen, analysis.source_alerts(fallen)).first().alert_level == "critical"
    assert analysis.without_critical(fallen, analysis.source_alerts(fallen)).count() == 0


def test_mass_refresh(spark):
    h = health(spark, 100, 100, 0, 0)
    fields = spark.createDataFrame([(A, B, "status_changed", "s", f"r{min(i, 74)}", "status", "a", "b") for i in range(76)], "before_date string, after_date string, change_type string, source_name string, record_identity string, field string, old_raw string, new_raw string")
    r = analysis.field_concentration(fields, h).first()
    assert (r.identities, r.change_rows, r.affected_rate, r.mass_refresh) == (75, 76, 0.75, True)


def test_components_and_crosswalk_ties(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 60)], "a long, b long")
    got = {r.node: r.component for r in resolve.connected(edges).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 50: 50, 60: 50}
    schema = "id string, number string, parcel string, address string, day date"
    left = spark.createDataFrame([("l1", "N1", None, None, None), ("l2", None, None, "10 A ST", None), ("l3", None, "P9", None, None)], schema)
    right = spark.createDataFrame([("r1", "N1", None, None, None), ("r2", "N1", None, None, None), ("r3", None, "P9", None, None)], schema)
    got = {r.id: (r.target_id, r.method, r.status) for r in resolve.crosswalk(left, right).collect()}
    assert got == {"l1": (None, "exact_number_ambiguous", "candidate"), "l2": (None, "none", "unmatched"), "l3": ("r3", "exact_parcel", "matched")}


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", "2026-01-01", "2026-01-01")], "k long, v string, first_observed string, last_observed string")
    new = spark.createDataFrame([(1, "", "2026-02-01"), (2, "b", "2026-02-01")], "k long, v string, seen string")
    once = resolve.upsert(old, new, "k", ["v"], "seen")
    twice = resolve.upsert(once, new, "k", ["v"], "seen")
    want = {(1, "a", "2026-01-01", "2026-02-01"), (2, "b", "2026-02-01", "2026-02-01")}
    assert set(map(tuple, once.collect())) == set(map(tuple, twice.collect())) == want


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abcd", min_size=1, max_size=3), st.integers(0, 60), min_size=1, max_size=8), st.integers(1, 100), st.integers(0, 3))
def test_allocation(populations, target, least):
    sizes = {k: n for k, n in populations.items() if n}
    floor = sum(min(least, n) for n in sizes.values())
    if not 0 < target <= sum(sizes.values()) or floor > target:
        with pytest.raises(ValueError):
            sampling.allocate(populations, target, least)
        return
    quota = sampling.allocate(populations, target, least)
    assert sum(quota.values()) == target and set(quota) == set(sizes)
    assert all(min(least, sizes[k]) <= q <= sizes[k] for k, q in quota.items())


def test_draws_are_reproducible_and_disjoint(spark):
    df = spark.createDataFrame([(i, "a" if i < 20 else "b") for i in range(25)], "id long, stratum string")
    draw = lambda: sorted(map(tuple, sampling.stratified(df, "id", "stratum", {"a": 8, "b": 2}, 42, "s").select("id", "rank", "weight").collect()))
    assert draw() == draw() and len(draw()) == 10
    phases = sampling.two_phase(df, "id", "stratum", 8, 8, 42, "s").collect()
    assert len({r.id for r in phases}) == 16
    assert quality.sample_design(sampling.stratified(df, "id", "stratum", {"a": 8, "b": 2}, 42, "s"), "stratum").where("not passed").count() == 0


def test_kappa(spark):
    pairs = spark.createDataFrame([("yes", "yes"), ("yes", "no"), ("no", "no"), (None, "no")], "a string, b string")
    r = review.kappa(pairs, "a", "b").first()
    assert (r.pairs, r.agreement, r.kappa) == (3, 0.666667, 0.4)


def test_privacy(spark):
    df = spark.createDataFrame([(1, "mail a@b.org"), (2, "call (813)555-0100"), (3, "123-45-6789"), (4, "1234-45-67890"), (5, None)], "i long, t string")
    got = {r.i: r.label for r in df.select("i", privacy.pii_label(F.col("t")).alias("label")).collect()}
    assert got == {1: "email address", 2: "phone number", 3: "Social Security number", 4: None, 5: None}
    assert spark.range(1).select(privacy.redact(F.lit("Bearer abc.def x?signature=12&a=1 password: hush"))).first()[0] == "Bearer [redacted] x?signature=[redacted]&a=1 password: [redacted]"
    assert privacy.blocked_columns(spark.createDataFrame([("x", 1)], "Owner_Name string, id int")) == ["Owner_Name"]


def test_chain_and_manifest(spark):
    import hashlib

    rows, before = [], None
    for i in range(4):
        own = hashlib.sha256(f"{i}|{before or ''}|c{i}".encode()).hexdigest()
        rows.append(("k", i, f"c{i}", before, own))
        before = own
    schema = "chain string, seq long, content string, previous string, own string"
    check = lambda r: tuple(audit.verify_chain(spark.createDataFrame(r, schema), "chain", "seq", F.col("content"), "previous", "own").first())
    assert check(rows) == ("k", 4, 0, 0, 0)
    rows[2] = ("k", 2, "tampered", rows[2][3], rows[2][4])
    assert check(rows) == ("k", 4, 0, 0, 1)
    assert check([rows[0], rows[3]]) == ("k", 2, 1, 1, 0)


def test_nearest_ties_and_far_points(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0)], "p_id long, lon double, lat double")
    s = spark.createDataFrame([(9, 0.0001, 0.0), (3, -0.0001, 0.0), (4, 40.0, 1.0)], "s_id long, s_lon double, s_lat double")
    got = spatial.nearest(p, s, 150.0).collect()
    assert [(r.p_id, r.s_id) for r in got] == [(1, 3)]


def test_csv_round_trip_and_aliases(spark, tmp_path):
    df = spark.createDataFrame([(2, "=SUM(A1)", "x\ny"), (1, None, "q\"uote")], "Id long, Cell string, Note string")
    sinks.write_csv(df, f"file://{tmp_path}/t.csv", ["Id", "Cell", "Note"], ["Id"], gzip=True)
    back = readers.read_csv(spark, f"file://{tmp_path}/t.csv", restore=True)
    assert [tuple(r) for r in back.orderBy("Id").collect()] == [("1", None, 'q"uote'), ("2", "=SUM(A1)", "x\ny")]
    named = readers.with_aliases(back, {"number": ["record", "ID"], "cell": [], "missing": ["gone"]}, ["number"])
    assert named.columns == ["number", "cell", "missing"]
    with pytest.raises(ValueError):
        readers.with_aliases(back, {"key": ["gone"]}, ["key"])
    good, bad = readers.strict_load(back, ["Id", "Cell"], "Cell")
    assert (good.count(), bad.count()) == (1, 1)
    files = sinks.manifest(spark, f"file://{tmp_path}/t.csv", "*.gz")
    assert audit.manifest_check(files, files).where("status <> 'ok'").count() == 0


def test_features(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"type":"FeatureCollection","features":[{"properties":{"A":"1","n":2.50},"geometry":{"type":"Point","coordinates":[1,2]}},{"properties":{},"geometry":null}]}')
    rows = readers.read_features(spark, f"file://{tmp_path}/f.json").orderBy("ordinal").collect()
    assert rows[0].properties["A"] == "1" and rows[1].properties == {} and rows[1].geometry is None
    assert readers.read_rows(spark, f"file://{tmp_path}/f.json").count() == 2


def test_observations(spark):
    s = "snapshot_date string, id long, v string"
    archive = spark.createDataFrame([("2026-09-30", 1, "a")], s)
    assert readers.load_observations(archive, spark.createDataFrame([("2026-10-31", 1, "b")], s)).count() == 2
    assert readers.load_observations(archive, archive).count() == 1
    with pytest.raises(ValueError):
        readers.load_observations(archive, archive.withColumn("v", F.lit("z")))


def test_parts_of_the_identity_step_do_not_grow(spark, monkeypatch):
    """Tasks of the identity step and of the pairing behind it get a bounded number of rows, whatever the session's partitions."""
    from ledgerflow.operators import spread

    monkeypatch.setattr(spread, "PART_ROWS", 100)
    rows = spark.range(6000).selectExpr("'2026-01-01' snapshot_date", "'s' source_name", "concat('N', id) native_id", "'' global_id", "'' object_id", "'x' status")
    seen = identity.with_identity(rows)
    sizes = [r["count"] for r in seen.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 50 and max(sizes) < 250
    assert diff.paired(seen, [("2025-12-01", "2026-01-01")], ("status",)).groupBy(F.spark_partition_id()).count().count() > 50
