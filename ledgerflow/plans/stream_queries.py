"""Streaming queries: each drains the events (or documents) as a stream and returns what it has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.plans.snapshots import table
from ledgerflow.sources.workspace import work_folder
from ledgerflow.streaming import streams

_EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(spark: SparkSession, path: str) -> DataFrame:
    """The events as a stream, with ts as an instant."""
    raw = streams.feed(spark, path, _EVENTS, 1 << 20)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


#: Events land in three deliveries of ten days each; every tenth comes with the delivery after its own.
_DELIVERIES = 3
_DELIVERY = "least(2, cast(floor((day(ts) - 1) / 10) as int) + case when event_id % 10 = 0 then 1 else 0 end)"


def _deliveries(spark: SparkSession, sf_dir: str, feed: str, run: Callable[[], None], replays: bool = False) -> None:
    """Write one delivery after the other to a folder and run a stream to its end behind each.

    Column arrived is the (nominal) time of a delivery. With replays, a delivery repeats a seventh of all before it.
    """
    events = table(spark, sf_dir, "events").withColumn("delivery", F.expr(_DELIVERY))
    for k in range(_DELIVERIES):
        mine = events.where((F.col("delivery") == k) | ((F.col("delivery") < k) & (F.col("event_id") % 7 == 3)) if replays else F.col("delivery") == k)
        arrived = F.timestamp_seconds(F.lit(1_704_067_200 + 864_000 * (k + 1)))
        mine.withColumn("arrived", arrived).drop("delivery").write.mode("append").parquet(feed)
        run()


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest state of every user; the stream is started anew for each delivery."""
    work = work_folder(spark)

    def run() -> None:
        rows = _events(spark, f"{work}/feed").withColumn("seen", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        streams.drain(streams.latest_by_key(rows, "user_id", ["event_type"], "seen"), "update", f"{work}/checkpoint", streams.changes_to(f"{work}/changes"))

    _deliveries(spark, sf_dir, f"{work}/feed", run)
    return streams.newest(streams.changes(spark, f"{work}/changes", "user_id long, event_type string, first_observed string, last_observed string"), ["user_id"])


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice in its delivery, and many again in later ones: each is kept once, in the folder of its day."""
    work, kept = work_folder(spark), _EVENTS.replace("timestamp_ntz", "timestamp") + ", arrived timestamp"

    def run() -> None:
        raw = streams.feed(spark, f"{work}/feed", f"{_EVENTS}, arrived timestamp", 1 << 20).withColumn("ts", F.col("ts").cast("timestamp"))
        twice = raw.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
        sink = streams.keep_fresh(f"{work}/out", kept, ["event_id"], "ts", "arrived", "2 days")
        streams.drain(streams.first_arrivals(twice, ["event_id"], "arrived", "2 days"), "append", f"{work}/checkpoint", sink)

    _deliveries(spark, sf_dir, f"{work}/feed", run, replays=True)
    out = spark.read.schema(f"{kept}, day string, batch int").option("basePath", f"{work}/out").parquet(f"{work}/out")
    return out.select("event_id", "event_type", "day")


def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final days of the events by type (a day late at most), and what came too late for them."""
    work = work_folder(spark)

    def run() -> None:
        rows = _events(spark, f"{work}/feed")
        streams.drain(streams.daily_counts(rows, "ts", ["event_type"], "1 day"), "append", f"{work}/checkpoint", streams.changes_to(f"{work}/final"))
        streams.drain(streams.all_daily_counts(rows, "ts", ["event_type"]), "update", f"{work}/checkpoint_all", streams.changes_to(f"{work}/all"))

    _deliveries(spark, sf_dir, f"{work}/feed", run)
    final = streams.changes(spark, f"{work}/final", "day string, event_type string, n long").drop("batch")
    every = streams.newest(streams.changes(spark, f"{work}/all", "day string, event_type string, n_all long"), ["day", "event_type"])
    return streams.with_late(final, every, ["event_type"])


def stream_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_folder(spark)
    boundary = table(spark, sf_dir, "events").agg(F.percentile(F.unix_timestamp(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    out = streams.labelled(_events(spark, f"{sf_dir}/events.parquet*"), "ts", F.timestamp_seconds(F.lit(int(boundary)))).select("event_id", "temporal_label")
    streams.drain(out, "append", f"{work}/checkpoint", f"{work}/out")
    return spark.read.schema("event_id long, temporal_label string").parquet(f"{work}/out").groupBy("temporal_label").agg(F.count("*").alias("n"))


def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations' turns: rows held for personal data and rows passed on, by reason."""
    work = work_folder(spark)
    # the pattern finds a single file as well as a folder of them
    turns = streams.feed(spark, f"{sf_dir}/conversations.parquet*", "conv_id long, turn long, role string, text string")
    streams.drain(turns, "append", f"{work}/checkpoint", streams.gate(["text"], f"{work}/clean", f"{work}/held"))
    passed = spark.read.schema("conv_id long, batch int").parquet(f"{work}/clean").select(F.lit("passed").alias("reason"))
    held = spark.read.schema("reason string, batch int").parquet(f"{work}/held").select("reason")
    return passed.unionByName(held).groupBy("reason").agg(F.count("*").alias("n"))


def stream_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each delivery by event type: how many no delivery before had."""
    work = work_folder(spark)

    def run() -> None:
        met = streams.met_keys(_events(spark, f"{work}/feed"), "event_type", "user_id")
        streams.drain(met, "update", f"{work}/checkpoint", streams.churn_to(f"{work}/churn", "event_type"))

    _deliveries(spark, sf_dir, f"{work}/feed", run)
    return streams.changes(spark, f"{work}/churn", "event_type string, keys long, new_keys long, churn double")


QUERIES = {f.__name__: f for f in (stream_upsert, stream_dedup, stream_daily, stream_labels, stream_gate, stream_churn)}

ORACLE_SQL = {
    "stream_upsert": "SELECT user_id, arg_max(event_type, ts) AS event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_observed, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_observed FROM events GROUP BY user_id",
    "stream_dedup": "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events",
    # a row is late if its day was a day and more before the latest of the deliveries before; a day is final by the same rule for all
    "stream_daily": f"""WITH e AS (SELECT *, {_DELIVERY} AS k, date_trunc('day', ts) AS d FROM events),
        m AS (SELECT i AS k, (SELECT max(ts) FROM e WHERE k < i) - INTERVAL 1 DAY AS closed FROM range(4) t(i)),
        c AS (SELECT d, event_type, coalesce(d + INTERVAL 1 DAY <= closed, false) AS late FROM e JOIN m USING (k)),
        f AS (SELECT closed FROM m WHERE k = 3)
        SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS late FROM c, f WHERE d + INTERVAL 1 DAY <= f.closed GROUP BY ALL""",
    "stream_labels": """WITH b AS (SELECT make_timestamp(floor(quantile_cont(floor(epoch(ts)), 0.5))::BIGINT * 1000000) AS t FROM events)
        SELECT CASE WHEN ts < t THEN 'retrospective' ELSE 'prospective' END AS temporal_label, count(*) AS n FROM events, b GROUP BY ALL""",
    "stream_gate": r"""SELECT coalesce(CASE WHEN regexp_matches(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b') THEN 'email address'
        WHEN regexp_matches(text, '(^|[^0-9])(\+?1[-. ]?)?(\([0-9]{3}\)|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}($|[^0-9])') THEN 'phone number'
        WHEN regexp_matches(text, '(^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}($|[^0-9])') THEN 'Social Security number' END, 'passed') AS reason, count(*) AS n FROM conversations GROUP BY ALL""",
    "stream_churn": f"""WITH e AS (SELECT DISTINCT event_type, user_id, {_DELIVERY} AS k FROM events),
        n AS (SELECT *, k = min(k) OVER (PARTITION BY event_type, user_id) AS fresh FROM e)
        SELECT event_type, count(*) AS keys, count(*) FILTER (fresh) AS new_keys, round(count(*) FILTER (fresh) / count(*)::DOUBLE, 6) AS churn, (dense_rank() OVER (ORDER BY k) - 1)::INTEGER AS batch FROM n GROUP BY event_type, k""",
}
