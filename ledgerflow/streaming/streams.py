"""Structured Streaming forms: incremental feeds, upserts, replay-safe deduplication, counts, gates, churn."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.functions.classify import temporal_label
from ledgerflow.operators.privacy import pii_label


def feed(spark: SparkSession, path: str, schema: str, files_per_batch: int = 64, **options: str) -> DataFrame:
    """A stream of the Parquet files under a path (new ones as they appear)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**options).parquet(path)


#: State on the executors' disks, its changes in the checkpoint; Spark keeps versions and recovers them.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block; those before it come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drain(stream: DataFrame, mode: str, checkpoint: str, sink: str | Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run a stream over all that is there now; ``sink`` is a Parquet path or a function of each batch.

    Started again with the same checkpoint, it goes on behind the last finished batch with the state
    that this batch has left.
    """
    with settings(stream.sparkSession, STATE_STORE):  # a stream keeps the settings it starts with
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = (writer.foreachBatch(sink) if callable(sink) else writer.format("parquet").option("path", sink)).start()
        query.awaitTermination()
    return query


def changes_to(path: str) -> Callable[[DataFrame, int], None]:
    """A batch function that writes the rows of each batch to a folder of its own; a batch run again replaces it."""

    def apply(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return apply


def changes(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What changes_to has written, with the number of the batch."""
    return spark.read.schema(f"{schema}, batch int").option("basePath", path).parquet(f"{path}/batch=*")


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the changes of each key, the last."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def latest_by_key(stream: DataFrame, key: str, values: Sequence[str], seen: str) -> DataFrame:
    """The newest value that is not null of each column, and when the key was first and last observed.

    For update mode: a batch gives the keys it has touched, whatever the order in which times come. The
    state is one row for each key, in Spark's state store. Of values seen at one time the largest
    counts; a value whose time is null counts only where there is no other; rows without key are one key.
    """
    newest_of = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(seen, c)))[c].alias(c)
    return stream.groupBy(key).agg(*[newest_of(c) for c in values], F.min(seen).alias("first_observed"), F.max(seen).alias("last_observed"))


def first_arrivals(stream: DataFrame, keys: Sequence[str], arrived: str, delay: str) -> DataFrame:
    """Each key once among what arrives within the delay; the state forgets keys that are older.

    ``arrived`` must not run backwards from batch to batch, so that no row is too late. Where the feed
    has no such column, take current_timestamp().
    """
    return stream.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(list(keys))


def keep_fresh(path: str, schema: str, keys: Sequence[str], time: str, arrived: str, delay: str) -> Callable[[DataFrame, int], None]:
    """A batch function that drops what has been kept before, and keeps the rest by the day of its time.

    The second tier behind first_arrivals: an event that happened within the delay before it arrived
    cannot have been kept longer ago than the state reaches back. All others (older ones, those without a time,
    those ahead of their arrival) are compared with the days they belong to, and only with these. The days of a
    batch pass through the driver, one value for each calendar day. Replays must carry the time of the
    event they repeat. A batch that is run again replaces its own rows and nothing else.
    """

    def kept(spark: SparkSession, days: list[str], before: int) -> DataFrame | None:
        try:
            found = spark.read.schema(f"{schema}, day string, batch int").option("basePath", path).parquet(f"{path}/day={{{','.join(days)}}}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        return found.where(F.col("batch") < before).select(*keys)

    def apply(batch: DataFrame, number: int) -> None:
        recent = F.coalesce(F.col(time).between(F.col(arrived) - F.expr(f"interval {delay}"), F.col(arrived)), F.lit(False))
        rows = batch.withColumn("day", F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("none"))).withColumn("_recent", recent).persist()
        try:
            older = rows.where("not _recent")
            days = [r["day"] for r in older.select("day").distinct().collect()]
            known = kept(batch.sparkSession, days, number) if days else None
            if known is not None:
                same = [older[k].eqNullSafe(known[k]) for k in keys]
                older = older.join(known, same, "left_anti")
            fresh = rows.where("_recent").unionByName(older).drop("_recent")
            writer = fresh.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("day", "batch").parquet(path)
        finally:
            rows.unpersist()

    return apply


def daily_counts(stream: DataFrame, time: str, by: list[str], delay: str) -> DataFrame:
    """Counts per calendar day, for append mode: final once no row less than ``delay`` late can belong to the day.

    Rows of a day that is final already are left out; days that are still open come later.
    """
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, "1 day"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), *by, "n")


def all_daily_counts(stream: DataFrame, time: str, by: list[str]) -> DataFrame:
    """Counts per calendar day of all rows, late ones too, for update mode; the state has a row for each day and group."""
    return stream.groupBy(F.date_format(time, "yyyy-MM-dd").alias("day"), *by).agg(F.count("*").alias("n_all"))


def with_late(final: DataFrame, every: DataFrame, by: Sequence[str]) -> DataFrame:
    """Final days with the number of rows that came too late for them (late), groups that only came late too."""
    last = final.agg(F.max("day").alias("_last"))  # one row
    every = every.join(F.broadcast(last), F.col("day") <= F.col("_last")).drop("_last")
    n = F.coalesce("n", F.lit(0).cast("long"))
    return every.join(final, ["day", *by], "left").select("day", *by, n.alias("n"), (F.col("n_all") - n).alias("late"))


def met_keys(stream: DataFrame, source: str, key: str) -> DataFrame:
    """The keys of each source with the times of the first and the last batch that had them, for update mode.

    A row of state for each source and key, so that a source of any size is dealt over all tasks.
    """
    now = stream.withColumn("_now", F.current_timestamp())  # one value for all rows of a batch, also if it is run again
    return now.groupBy(source, key).agg(F.min("_now").alias("first_met"), F.max("_now").alias("last_met"))


def churn_to(path: str, source: str) -> Callable[[DataFrame, int], None]:
    """A batch function over met_keys: the keys of a batch, those that no batch before had, and their share, per source."""
    write = changes_to(path)

    def apply(batch: DataFrame, number: int) -> None:
        fresh = F.count_if(F.col("first_met") == F.col("last_met"))
        n = batch.groupBy(source).agg(F.count("*").alias("keys"), fresh.alias("new_keys"))
        write(n.withColumn("churn", F.round(F.col("new_keys") / F.col("keys"), 6)), number)

    return apply


def labelled(stream: DataFrame, time: str, boundary: Column) -> DataFrame:
    """Late events keep their row and are labelled retrospective."""
    return stream.withColumn("temporal_label", temporal_label(F.col(time), boundary))


def gate(text: list[str], clean_path: str, held_path: str) -> Callable[[DataFrame, int], None]:
    """A batch function that sends rows with personal data to quarantine, with the reason, and the rest on."""

    def apply(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("reason", pii_label(*[F.col(c) for c in text])).persist()
        try:
            marked.where("reason is null").drop("reason").write.mode("overwrite").parquet(f"{clean_path}/batch={number}")
            marked.where("reason is not null").write.mode("overwrite").parquet(f"{held_path}/batch={number}")
        finally:
            marked.unpersist()

    return apply
