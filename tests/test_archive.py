"""The archive: immutable dates, reuse, broken and competing writers; buckets without an exchange."""

from __future__ import annotations

import io
from concurrent.futures import ThreadPoolExecutor
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import diff, identity
from ledgerflow.plans.snapshots import PAIRS, VALUES, snapshots
from ledgerflow.sources import archive


def snapshot(spark, value="a", when="t1", n=3):
    return spark.createDataFrame([(i, value, when) for i in range(n)], "id long, v string, retrieved_at string")


def test_archive_is_immutable(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    assert archive.archive_snapshot(snapshot(spark), path, "2026-09-30") == "written"
    assert archive.archive_snapshot(snapshot(spark, when="t2"), path, "2026-09-30") == "unchanged"
    with pytest.raises(ValueError, match="other contents"):
        archive.archive_snapshot(snapshot(spark, "b"), path, "2026-09-30")
    assert archive.archive_snapshot(snapshot(spark), path, "2026-10-01") == "reused 2026-09-30"
    with pytest.raises(ValueError, match="under 2026-09-30"):
        archive.archive_snapshot(snapshot(spark, "b"), path, "2026-10-01")
    assert archive.archive_snapshot(snapshot(spark, when="t3"), path, "2026-10-31") == "written"
    assert archive.archive_snapshot(snapshot(spark, n=0), path, "2026-11-30") == "written"
    assert {str(r.snapshot_date): r["count"] for r in archive.load(spark, path).groupBy("snapshot_date").count().collect()} == {"2026-09-30": 3, "2026-10-31": 3}
    assert archive.load(spark, path, ["2026-11-30"]).count() == 0 and archive.load(spark, path, ["2026-10-31"]).count() == 3
    with pytest.raises(ValueError, match="no snapshot"):
        archive.load(spark, path, ["2020-01-01"])
    assert [(r.snapshot_date, r.rows) for r in archive.catalog(spark, path).orderBy("snapshot_date").collect()] == [("2026-09-30", 3), ("2026-10-31", 3), ("2026-11-30", 0)]


def test_a_broken_writer_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/archive"
    rows, write = snapshot(spark, "half"), archive._record

    def killed(row, where, kind, name):
        if kind == "commits":
            raise KeyboardInterrupt
        return write(row, where, kind, name)

    monkeypatch.setattr(archive, "_record", killed)
    with pytest.raises(KeyboardInterrupt):
        archive.archive_snapshot(rows, path, "2026-09-30")
    monkeypatch.undo()
    assert archive.catalog(spark, path).count() == 0 and archive.abandoned(spark, path).count() == 1
    assert archive.archive_snapshot(snapshot(spark), path, "2026-09-30", lease=3) == "written"  # behind the dead writer's lease
    assert {r.v for r in archive.load(spark, path).collect()} == {"a"} and archive.abandoned(spark, path).count() == 1


def test_of_two_writers_one_wins(spark, tmp_path):
    path = f"file://{tmp_path}/archive"

    def write(value):
        try:
            return archive.archive_snapshot(snapshot(spark, value, None), path, "2026-09-30")
        except ValueError:
            return "refused"

    with ThreadPoolExecutor(4) as pool:
        said = list(pool.map(write, ["a", "b", "c", "d"]))
    assert sorted(said) == ["refused", "refused", "refused", "written"]
    assert {r.v for r in archive.load(spark, path).collect()} == {"abcd"[said.index("written")]}
    with ThreadPoolExecutor(4) as pool:
        same = list(pool.map(lambda _: archive.archive_snapshot(snapshot(spark, "e", None), path, "2026-10-31"), range(4)))
    assert sorted(same) == ["unchanged", "unchanged", "unchanged", "written"]


def test_newest_pair_meets_without_an_exchange(spark, sf, tmp_path):
    rows = identity.with_identity(snapshots(spark, sf))
    stored = archive.write_bucketed(rows.where("snapshot_date < '2026-10-01'"), "bucketed_test", f"file://{tmp_path}/b", "record_identity", 4)
    stored = archive.write_bucketed(rows.where("snapshot_date > '2026-10-01'"), "bucketed_test", f"file://{tmp_path}/b", "record_identity", 4)
    both = diff.paired(stored, PAIRS[-1:], VALUES)
    with redirect_stdout(io.StringIO()) as said:
        both.explain("formatted")
    assert "Exchange" not in said.getvalue() and "SelectedBucketsCount: 4 out of 4" in said.getvalue()
    want = diff.paired(rows, PAIRS[-1:], VALUES)
    text = lambda df: sorted(str(r) for r in df.select("record_identity", "old", "new").collect())
    assert text(both) == text(want)
    assert both.where(F.col("old").isNull()).count() > 0
    spark.sql("DROP TABLE bucketed_test")
