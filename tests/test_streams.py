"""Streams over events in several files whose times interleave, against the same events in one table."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerflow.plans.registry import ORACLE_SQL, QUERIES
from ledgerflow.streaming import streams
from tests.test_oracles import plain


@pytest.fixture(scope="module")
def interleaved(spark, sf, tmp_path_factory):
    """Five files that each span all days; the later times of a user often stand in an earlier file."""
    path = str(tmp_path_factory.mktemp("feed"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    for k in range(5):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == k).coalesce(1).write.mode("append").parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("name", ["stream_dedup", "stream_churn", "stream_upsert", "stream_daily"])
def test_interleaved_files(spark, interleaved, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{interleaved}/events.parquet/*.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    assert plain(QUERIES[name](spark, interleaved).toPandas()) == plain(want)


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/feed")


def test_an_upsert_writes_changed_keys_only_and_survives_restarts(spark, tmp_path):
    """Old news, null values, keys of their own and a batch that fails once."""
    schema = "k long, a string, b string, seen string"
    deliveries = [
        [(1, "x", None, "05"), (2, "y", "q", "05"), (None, "n", None, "05")],
        [(1, None, "late", "01"), (3, "z", None, "06")],
        [(1, "old", None, "02"), (1, None, "new", "09")],
    ]
    wrote = []
    for k, rows in enumerate(deliveries):
        land(spark, tmp_path, rows, schema)
        write, tries = streams.changes_to(f"{tmp_path}/out"), []

        def sink(batch, number, write=write, tries=tries, k=k):
            write(batch, number)
            tries.append(number)
            if k == 1 and len(tries) == 1 and not wrote[1:]:
                wrote.append("failed")
                raise RuntimeError("lost")

        def run(sink=sink):
            feed = streams.feed(spark, f"{tmp_path}/feed", schema)
            return streams.drain(streams.latest_by_key(feed, "k", ["a", "b"], "seen"), "update", f"{tmp_path}/checkpoint", sink)

        if k == 1:
            with pytest.raises(Exception, match="lost"):
                run()
        query = run()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == (3 if k == 0 else 4)
        wrote.append("done")
    out = streams.changes(spark, f"{tmp_path}/out", "k long, a string, b string, first_observed string, last_observed string")
    assert sorted((r.batch, r.k or 0) for r in out.collect()) == [(0, 0), (0, 1), (0, 2), (1, 1), (1, 3), (2, 1)]
    got = {r.k: (r.a, r.b, r.first_observed, r.last_observed) for r in streams.newest(out, ["k"]).collect()}
    assert got == {None: ("n", None, "05", "05"), 1: ("x", "new", "01", "09"), 2: ("y", "q", "05", "05"), 3: ("z", None, "06", "06")}


def test_settings_come_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError), streams.settings(spark, streams.STATE_STORE):
        assert "RocksDB" in spark.conf.get(key)
        1 / 0  # noqa: B018
    assert spark.conf.get(key, None) == before


def test_dedup_keeps_a_flat_state_and_loses_nothing(spark, tmp_path):
    """Thirty days of events, each day with replays of yesterday and of all days before; some without a time or from the future."""
    schema, kept = "id long, ts timestamp, arrived timestamp", "id long, ts timestamp, arrived timestamp"
    day = 86_400
    sizes, everything = [], set()
    for d in range(0, 30, 3):  # a delivery every third day
        rows = [(1000 * d + i, (d - 1) * day + i, d * day) for i in range(100)]
        rows += [(1000 * e + i, (e - 1) * day + i, d * day) for e in range(0, d, 3) for i in range(0, 100, 9)]  # replays
        rows += [(1000 * d + 500, None, d * day), (1000 * d + 501, (d + 5) * day, d * day)]
        rows += [(1000 * e + 500, None, d * day) for e in range(0, d, 3)] + [(1000 * e + 501, (e + 5) * day, d * day) for e in range(0, d, 3)]
        everything |= {r[0] for r in rows}
        raw = spark.createDataFrame(rows + rows[:5], "id long, t long, a long").selectExpr("id", "timestamp_seconds(t + 1e9) ts", "timestamp_seconds(a + 1e9) arrived")
        raw.coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
        feed = streams.feed(spark, f"{tmp_path}/feed", schema)
        sink = streams.keep_fresh(f"{tmp_path}/out", kept, ["id"], "ts", "arrived", "4 days")
        query = streams.drain(streams.first_arrivals(feed, ["id"], "arrived", "4 days"), "append", f"{tmp_path}/checkpoint", sink)
        sizes.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    got = [r.id for r in spark.read.parquet(f"{tmp_path}/out").select("id").collect()]
    assert sorted(got) == sorted(everything)
    assert max(sizes[4:]) <= 1.5 * sizes[3] < len(everything)  # replays of old days come into the state, days do not pile up
    out = spark.read.parquet(f"{tmp_path}/out")
    again = out.where("batch = 3").select("id", "ts", "arrived")
    n = (out.count(), out.where("batch = 3").count())
    streams.keep_fresh(f"{tmp_path}/out", kept, ["id"], "ts", "arrived", "4 days")(again, 3)  # a batch that is run again
    assert (spark.read.parquet(f"{tmp_path}/out").count(), spark.read.parquet(f"{tmp_path}/out").where("batch = 3").count()) == n


def test_late_rows_are_counted_apart(spark, tmp_path):
    schema = "ts timestamp, kind string"
    for rows in ([("2024-01-01 05:00:00", "a"), ("2024-01-02 05:00:00", "a"), ("2024-01-04 01:00:00", "b")], [("2024-01-01 06:00:00", "a"), ("2024-01-01 06:00:00", "c"), ("2024-01-03 06:00:00", "a"), ("2024-01-06 00:00:00", "a")]):
        spark.createDataFrame(rows, "ts string, kind string").selectExpr("cast(ts as timestamp) ts", "kind").coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
        feed = streams.feed(spark, f"{tmp_path}/feed", schema)
        streams.drain(streams.daily_counts(feed, "ts", ["kind"], "1 day"), "append", f"{tmp_path}/c1", streams.changes_to(f"{tmp_path}/final"))
        streams.drain(streams.all_daily_counts(feed, "ts", ["kind"]), "update", f"{tmp_path}/c2", streams.changes_to(f"{tmp_path}/all"))
    final = streams.changes(spark, f"{tmp_path}/final", "day string, kind string, n long").drop("batch")
    every = streams.newest(streams.changes(spark, f"{tmp_path}/all", "day string, kind string, n_all long"), ["day", "kind"])
    got = {(r.day[-2:], r.kind): (r.n, r.late) for r in streams.with_late(final, every, ["kind"]).collect()}
    assert got == {("01", "a"): (1, 1), ("01", "c"): (0, 1), ("02", "a"): (1, 0), ("03", "a"): (1, 0), ("04", "b"): (1, 0)}
