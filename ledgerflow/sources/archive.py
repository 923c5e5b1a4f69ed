"""An immutable archive of dated snapshots, with the commit record last; and snapshots in buckets, for comparison.

A snapshot's rows go to a folder of their own attempt, then an intent is written for the date, and the commit
record that names the attempt comes last. Readers follow commits only, so what a broken writer leaves is not
seen. Of several writers of one date the one whose intent the store has stamped first may commit. Plain
files know no lock, so this rests on times, each measured: an intent counts only if it was written within
``settle`` seconds, and a writer looks at the others that long after its own; then whoever looks sees all
intents before its own. An intent older than ``lease`` seconds is that of a dead writer.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.dates import local_date
from ledgerflow.functions.ids import fingerprint

_RECORD = "snapshot_date string, attempt string, rows long, content string, state string, retrieved string"


def _records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """All commits or intents with the time at which the store has stamped them."""
    try:
        return spark.read.schema(_RECORD).option("recursiveFileLookup", True).parquet(f"{path}/{kind}").select("*", F.col("_metadata.file_modification_time").alias("stamped"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], f"{_RECORD}, stamped timestamp")
        raise


def _record(row: DataFrame, path: str, kind: str, name: str) -> float:
    """Write one record in a folder of its own; the seconds it took."""
    began = time.monotonic()
    row.coalesce(1).write.parquet(f"{path}/{kind}/{name}")
    return time.monotonic() - began


def catalog(spark: SparkSession, path: str, zone: str | None = None) -> DataFrame:
    """A row for each archived date: rows, hashes of content and state, retrieval time, attempt.

    With a zone, well_labelled tells whether the date is the local day of the retrieval (null where that is unknown).
    """
    record = F.struct("attempt", "rows", "content", "state", "retrieved")
    won = _records(spark, path, "commits").groupBy("snapshot_date").agg(F.min_by(record, F.struct("stamped", "attempt")).alias("r")).select("snapshot_date", "r.*")
    if zone is None:
        return won
    day = local_date(F.col("retrieved"), zone)
    return won.withColumn("well_labelled", day.cast("string") == F.col("snapshot_date"))


def load(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """The rows of all archived snapshots, or of some, with their snapshot_date; other folders are not read.

    One record for each date passes through the driver.
    """
    rows = catalog(spark, path)
    if days is not None:
        rows = rows.where(F.col("snapshot_date").isin(*days))
    found = {r["attempt"]: r["snapshot_date"] for r in rows.select("attempt", "snapshot_date").collect()}
    if not found:
        raise ValueError(f"{path} has no snapshot" + (f" of {', '.join(days)}" if days else ""))
    data = spark.read.option("mergeSchema", True).option("basePath", f"{path}/data").parquet(*[f"{path}/data/attempt={a}" for a in found])
    dates = F.create_map(*[F.lit(x) for pair in found.items() for x in pair])
    return data.withColumn("snapshot_date", F.to_date(dates[F.col("attempt")])).drop("attempt")


def _hashes(df: DataFrame, ignore: Sequence[str], retrieved: str) -> tuple[int, str, str, str | None]:
    """Rows, hash of all columns, hash without the ignored ones, and the retrieval time if all rows have one and the same."""
    content, state = fingerprint(df).first(), fingerprint(df, *ignore).first()
    when = None
    if retrieved in df.columns:
        seen = df.select(F.col(retrieved).cast("string").alias("r")).distinct().limit(2).collect()
        when = seen[0]["r"] if len(seen) == 1 else None
    return content["rows"], "-".join(map(str, content)), "-".join(map(str, state)), when


def archive_snapshot(df: DataFrame, path: str, day: str, ignore: Sequence[str] = ("retrieved_at",), retrieved: str = "retrieved_at", settle: float = 2.0, lease: float = 600.0) -> str:
    """Store a snapshot under its date, once.

    "unchanged" if the date holds the same state (all columns but the ignored); an error if it holds another.
    "reused <date>" if the same retrieval is archived under another date; an error if its contents differ there.
    Else "written". Rows are compared by hashes that do not depend on their order. ``settle`` must be more
    than the store's time stamps are apart; a writer that waits for one before it that has died waits for
    ``lease`` at most.
    """
    spark = df.sparkSession
    df = df.persist()
    try:
        rows, content, state, when = _hashes(df, ignore, retrieved)

        def standing() -> bool:
            held = catalog(spark, path).where(F.col("snapshot_date") == day).first()
            if held is not None and held["state"] != state:
                raise ValueError(f"{day} is archived with other contents")
            return held is not None

        if standing():
            return "unchanged"
        prior = catalog(spark, path).where(F.col("retrieved") == when).orderBy("snapshot_date").first() if when is not None else None
        if prior is not None:
            if prior["content"] != content:
                raise ValueError(f"the retrieval of {when} is archived under {prior['snapshot_date']} with other contents")
            return f"reused {prior['snapshot_date']}"
        attempt = uuid.uuid4().hex
        df.write.parquet(f"{path}/data/attempt={attempt}")
        stored = spark.read.parquet(f"{path}/data/attempt={attempt}").count()
        if stored != rows:
            raise ValueError(f"{day}: {rows} rows came, {stored} are stored")
        record = spark.createDataFrame([(day, attempt, rows, content, state, when)], _RECORD)
        began = time.monotonic()
        mine = _intent(record, path, settle)
        while True:
            time.sleep(settle)
            if standing():
                return "unchanged"
            alive = _records(spark, path, "intents").where((F.col("snapshot_date") == day) & (F.col("stamped") > F.current_timestamp() - F.make_dt_interval(secs=F.lit(lease))))
            first = alive.orderBy("stamped", "attempt").first()
            if first is not None and first["attempt"] == mine:
                break
            if first is None or time.monotonic() - began > 2 * lease:
                raise TimeoutError(f"{day}: this writer has come to nothing within its lease")
        _record(record, path, "commits", attempt)
        return "written"
    finally:
        df.unpersist()


def _intent(record: DataFrame, path: str, settle: float, tries: int = 5) -> str:
    """Announce a commit; the name of an intent that was there in time. One that took longer is announced anew."""
    for _ in range(tries):
        name = uuid.uuid4().hex
        if _record(record.withColumn("attempt", F.lit(name)), path, "intents", name) <= settle:
            return name
    raise TimeoutError(f"{path}: no intent could be written within {settle} seconds")


def abandoned(spark: SparkSession, path: str) -> DataFrame:
    """attempt and files of data that no valid record names: left by broken writers, or by those that came second."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{path}/data")
    of = files.select(F.regexp_extract("path", r"attempt=([0-9a-f]+)", 1).alias("attempt"))
    return of.join(catalog(spark, path).select("attempt"), "attempt", "left_anti").groupBy("attempt").agg(F.count("*").alias("files"))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, date: str = "snapshot_date") -> DataFrame:
    """Add identified snapshots to a table in buckets of their key, one folder per date; returns the table.

    Rows are dealt once, when they are written: aggregations and joins by the key (and more columns) over any
    dates need no exchange after that. The number of buckets stays that of the first write.
    """
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.format("parquet").mode("append").partitionBy(date).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
