"""Queries that write tables with the sinks, read them with the scans and compare; and on scalar functions not used elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import classify, dates, geo, ids, jsonmap, text, urls
from ledgerflow.operators import cohort, sampling
from ledgerflow.plans.snapshots import CTE, snapshots, table
from ledgerflow.sources import pages as page_source
from ledgerflow.sources import archive, filetree, readers, sinks
from ledgerflow.sources.workspace import work_folder


def _text(c: str) -> Column:
    return F.col(c).cast("string")


# --- sinks and scans --------------------------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations and formula-like cells through a gzipped CSV file and back."""
    work = work_folder(spark, "csv")
    cell = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("=sum "), F.col("role"))).when(F.col("turn") % 3 == 1, F.concat(F.lit("-"), _text("turn"))).otherwise(F.lit('a "b",\nc'))
    rows = table(spark, sf_dir, "conversations").select(_text("conv_id").alias("conv_id"), _text("turn").alias("turn"), cell.alias("cell"), F.when(F.col("turn") % 2 == 0, "x").alias("blank"))
    sinks.write_csv(rows, f"{work}/rows.csv", ("conv_id", "turn", "cell", "blank"), ("conv_id", "turn"), gzip=True)
    return readers.read_csv(spark, f"{work}/rows.csv", restore=True)


_RANGE, _FAN, _LEVELS = 256, 4, 10


def file_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a text file per nation, and the roots of the files' hash trees (small ranges, so that trees have levels)."""
    work = work_folder(spark, "trees")
    lines = table(spark, sf_dir, "customer").select("c_nationkey", F.concat_ws(" ", "c_custkey", "c_name").alias("line"), "c_custkey")
    dealt = lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    dealt.select("c_nationkey", "line").write.partitionBy("c_nationkey").text(work)
    roots = filetree.file_roots(filetree.range_hashes(spark, work, "*.txt", _RANGE), _RANGE, _FAN)
    return roots.select(F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int").alias("c_nationkey"), "bytes", "root")


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a feature collection per nation, written as JSON text and read again."""
    work = work_folder(spark, "features")
    props = F.struct(_text("s_suppkey").alias("OBJECTID"), F.col("s_name").alias("Name"))
    point = F.struct(F.lit("Point").alias("type"), F.array(F.col("s_nationkey").cast("double"), F.lit(0.5)).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), point.alias("geometry"))
    rows = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(feature)).alias("features"))
    rows.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.text(f"{work}/features")
    out = readers.feature_rows(spark.read.text(f"{work}/features")).withColumn("points", geo.vertices(F.col("geometry")))
    return out.select(F.element_at("properties", "OBJECTID").cast("long").alias("s_suppkey"), F.element_at("properties", "Name").alias("s_name"), F.col("points")[0][0].alias("lon"), F.size("points").cast("long").alias("n"))


def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts through JSON lines, by the reader that goes by names."""
    work = work_folder(spark, "json")
    table(spark, sf_dir, "part").select("p_partkey", "p_name").write.json(f"{work}/part.jsonl")
    return readers.read_rows(spark, f"{work}/part.jsonl").select("p_partkey", "p_name")


def aliased_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under names of an export, and those without a key apart."""
    raw = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 9 != 0, _text("c_custkey")).alias(" Permit Number "), F.col("c_name").alias("NAME"), F.when(F.col("c_custkey") % 9 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("Segment"))
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    named = readers.with_aliases(raw, {"permit_id": ("permit number", "record id"), "name": (), "segment": ("market",), "issued": ("issue date",)}, ("permit_id",))
    kept, keyless = readers.strict_load(named.withColumn("name", F.when(F.col("permit_id").isNull() & F.col("name").endswith("0"), "").otherwise(F.col("name"))), ("permit_id", "name", "segment", "issued"), "permit_id")
    mark = lambda df, name: df.select(F.lit(name).alias("kind"), "permit_id", "name", "segment", "issued")
    return mark(kept, "kept").unionByName(mark(keyless, "no_key"))


def archived_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots archived under their dates; what is said to the same rows again, to other rows, and to one retrieval under two dates."""
    work = work_folder(spark, "archive")
    rows = snapshots(spark, sf_dir).withColumn("retrieved_at", F.concat("snapshot_date", F.lit("T06:00:00Z")))
    of = lambda day: rows.where(F.col("snapshot_date") == day).drop("snapshot_date")
    said = []
    for day, source in (("2026-08-31", "2026-08-31"), ("2026-09-30", "2026-09-30"), ("2026-10-31", "2026-10-31"), ("2026-08-31", "2026-08-31"), ("2026-09-01", "2026-08-31")):
        said.append((source, archive.archive_snapshot(of(source), work, day)))
    try:
        archive.archive_snapshot(of("2026-09-30"), work, "2026-10-31")
    except ValueError:
        said.append(("2026-10-31", "refused"))
    told = spark.createDataFrame(said, "snapshot_date string, said string").groupBy("snapshot_date").agg(F.array_join(F.array_sort(F.collect_list("said")), ";").alias("said"))
    stored = archive.load(spark, work).groupBy(_text("snapshot_date").alias("snapshot_date")).agg(F.count("*").alias("rows"), F.countDistinct("global_id").alias("ids"))
    one = archive.load(spark, work, ["2026-09-30"]).agg(F.count("*").alias("of_september"))
    return stored.join(told, "snapshot_date").join(F.broadcast(one))  # one row


def archive_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of an archive, one under a wrong label: rows, whether label and retrieval agree, and the dates that hold each content."""
    work = work_folder(spark, "archive")
    rows = snapshots(spark, sf_dir).withColumn("retrieved_at", F.concat("snapshot_date", F.lit("T18:00:00Z")))
    for label, day, at in (("2026-08-31", "2026-08-31", None), ("2026-09-29", "2026-09-30", None), ("2026-10-31", "2026-10-31", None), ("2026-11-30", "2026-10-31", "2026-11-30T18:00:00Z")):
        own = rows.where(F.col("snapshot_date") == day).drop("snapshot_date")
        archive.archive_snapshot(own.withColumn("retrieved_at", F.lit(at)) if at else own, work, label)
    kept = archive.catalog(spark, work, "America/New_York")
    copies = kept.groupBy("state").agg(F.max("snapshot_date").alias("newest_of_content"), F.count("*").alias("dates_with_content"))
    return kept.join(copies, "state").select("snapshot_date", "rows", "retrieved", "well_labelled", "newest_of_content", "dates_with_content")


def observed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archived snapshots with the current one, whose date is new."""
    rows = snapshots(spark, sf_dir)
    day = F.col("snapshot_date")
    return readers.load_observations(rows.where(day < "2026-10-01"), rows.where(day >= "2026-10-01")).groupBy("snapshot_date").agg(F.count("*").alias("rows"))


def month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written by month (after a write with one more month), read with their index."""
    work = work_folder(spark, "months")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("event_month"), F.lower("o_orderpriority").alias("source_name"), "o_orderstatus")
    sinks.write_months(rows.limit(1).withColumn("event_month", F.lit("1900-01")), work)
    sinks.write_months(rows, work)
    stored = spark.read.parquet(work).withColumn("event_month", F.date_format("event_month", "yyyy-MM"))
    return cohort.monthly_index(stored, "event_month", "source_name", "o_orderstatus")


def split_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a folder per priority, checked on writing, and all of them listed in a manifest."""
    work = work_folder(spark, "split")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    written = sinks.write_checked(rows, f"{work}/checked")
    sinks.write_split(rows, f"{work}/split", "o_orderpriority")
    parts = readers.change_universe(spark, [f"{work}/checked"]).agg(F.count("*").alias("n"))
    files = sinks.manifest(spark, f"{work}/split", "*.parquet")
    sound = files.agg(F.bool_and((F.length("sha256") == 64) & (F.col("bytes") > 0)).alias("sound"), F.countDistinct(F.regexp_extract("path", r"o_orderpriority=([^/]*)", 1)).alias("folders"))
    stored = spark.read.parquet(f"{work}/split").groupBy("o_orderpriority").agg(F.count("*").alias("rows"))
    return stored.join(F.broadcast(sound.join(parts))).withColumn("written", F.lit(written).cast("long"))  # one row


def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of all tables in pages, and of tables made of the line items of orders."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("items"))
    row = lambda x: F.concat(F.lit("<tr><td>"), x["l_linenumber"].cast("string"), F.lit("</td><td><b>"), x["l_partkey"].cast("string"), F.lit("</b> </td></tr>"))
    html = F.concat(F.lit("<table class='r'><tr><th>Line</th><TH>Part</TH></tr>"), F.array_join(F.transform("items", row), "\n"), F.lit("</table>"))
    cells = page_source.table_cells(items.select(F.col("l_orderkey").alias("page_id"), html.alias("html")))
    return cells.groupBy("page_id", "column").agg(F.count("*").alias("cells"), F.max("row").cast("long").alias("last_row"), F.max(F.when(F.col("row") > 0, F.col("text").cast("long"))).alias("largest"))


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled values of detail pages made of orders; a label that lacks gives null."""
    line = lambda label, value: F.concat(F.lit(f"<p>{label}: "), value, F.lit("</p>"))
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("page_id"),
        F.concat(F.lit("<html><body>"), line("Record Status", F.col("o_orderstatus")), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(line("Priority", F.col("o_orderpriority"))), F.lit("</body></html>")).alias("html"),
    )
    return page_source.labelled(page_source.texts(o), ["Record Status", "Priority"])


# --- scalar functions -------------------------------------------------------------------------


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in text, prefixes, parcel numbers, query values, outcomes of inspections."""
    key = F.col("o_orderkey")
    link = F.concat(F.lit("https://example.org/a?k="), _text("o_orderkey"), F.lit("&m=2"))
    anchor = F.when(key % 3 == 0, F.concat(F.lit('<a href="'), link, F.lit('">x</a>'))).when(key % 3 == 1, F.lit(" plain  text ")).otherwise(F.lit(None).cast("string"))
    result = F.element_at(F.array(*[F.lit(x) for x in ("Passed", "Final - approved", "Rejected", "Pending", "Denied")]), (key % 5 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.extract_url(anchor, F.lit("none")).alias("url"),
        text.strip_prefix(F.concat(F.lit("/data/raw/"), _text("o_orderkey")), "/data/raw/").alias("stripped"),
        text.parcel_folio(F.concat(F.lit("F "), (key + 1_000_000).cast("string"))).alias("folio"),
        urls.query_value(link, "k").alias("k"),
        urls.query_value(link, "none").alias("missing"),
        classify.inspection_outcome(result).alias("outcome"),
        F.lit(text.header_name("  Record   NUMBER ")).alias("header"),
    )


def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in several forms, days of a zone, first valid dates."""
    key, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    seconds = F.unix_timestamp(ts)
    form = F.when(key % 4 == 0, seconds.cast("string")).when(key % 4 == 1, (seconds * 1000).cast("string")).when(key % 4 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("no time")
    parsed = dates.parse_timestamp(form)
    first = dates.first_valid(("a", dates.parse_date(F.when(key % 5 == 0, F.date_format(ts, "MM/dd/yyyy")))), ("b", dates.parse_date(F.when(key % 3 == 0, "2020-02-31").otherwise("2020-02-03"))))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_timestamp(parsed).alias("seconds"), day(dates.local_date(ts, "America/New_York")).alias("local_day"), day(first["date"]).alias("first_date"), first["field"].alias("first_field")
    )


def map_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-ups in maps of text, hashes of maps, child ids."""
    user = _text("user_id")
    m = F.create_map(F.lit("b"), F.when(F.col("user_id") % 2 == 0, "  ").otherwise(user), F.lit("a"), F.col("event_type"))
    swapped = F.create_map(F.lit("a"), F.col("event_type"), F.lit("b"), F.when(F.col("user_id") % 2 == 0, "  ").otherwise(user))
    return table(spark, sf_dir, "events").select(
        "event_id",
        jsonmap.lookup(m, "B", "A").alias("looked_up"),
        jsonmap.combined(m, "a", "b").alias("combined"),
        jsonmap.field_value(F.to_json(m), "A").alias("field"),
        jsonmap.field_value(F.lit("no object"), "A").alias("no_field"),
        (ids.map_hash(m) == ids.map_hash(swapped)).alias("same_hash"),
        ids.child_id(user, F.when(F.col("event_id") % 2 == 0, _text("event_id")), F.col("event_type")).alias("child_id"),
    )


def multipolygon_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points against two squares, one with a hole, as one geometry; and its vertices."""
    square = lambda x, y, w: f"[[{x},{y}],[{x + w},{y}],[{x + w},{y + w}],[{x},{y + w}],[{x},{y}]]"
    shape = F.lit(f'{{"type":"MultiPolygon","coordinates":[[{square(0, 0, 10)},{square(2, 2, 4)}],[{square(20, 0, 5)}]]}}')
    polygons = F.from_json(F.get_json_object(shape, "$.coordinates"), "array<array<array<array<double>>>>")
    x, y = (F.col("c_custkey") % 27).cast("double") + 0.5, (F.floor(F.col("c_custkey") / 27) % 11).cast("double") + 0.5
    return table(spark, sf_dir, "customer").select("c_custkey", geo.in_multipolygon(x, y, polygons).alias("inside"), F.size(geo.vertices(shape)).cast("long").alias("vertices"))


def frame_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frozen universe has the same fingerprint in any order; numbered samples count from one."""
    o = table(spark, sf_dir, "orders")
    a, b = (sampling.universe_fingerprint(df, "o_orderkey", "o_orderpriority").first() for df in (o, o.repartition(7, "o_custkey")))
    top = sampling.numbered(o.orderBy("o_orderkey").limit(20), "s", "o_orderkey").select("sample_id", "o_orderkey")
    return top.withColumn("same", F.lit(a == b)).withColumn("rows", F.lit(a["rows"]).cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        csv_round_trip, file_roots, feature_rows, json_rows, aliased_rows, archived_snapshots, archive_catalog, observed_snapshots, month_partitions, split_by_source, page_tables, page_labels,
        text_functions, time_functions, map_functions, multipolygon_points, frame_fingerprint,
    )
}

_LISTED = "(SELECT string_agg(k || '=' || n, ';' ORDER BY k) FROM (SELECT {c} AS k, count(*) AS n FROM m AS i WHERE i.event_month = m.event_month GROUP BY {c}))"

_FOLDS = ", ".join(f"l{k} AS (SELECT c_nationkey, bytes, part // {_FAN} AS part, ceil(parts / {_FAN})::BIGINT AS parts, CASE WHEN parts = 1 THEN any_value(h) ELSE sha256('\\x01'::BLOB || unhex(string_agg(h, '' ORDER BY l{k - 1}.part))) END AS h FROM l{k - 1} GROUP BY c_nationkey, bytes, part // {_FAN}, parts)" for k in range(1, _LEVELS + 1))

ORACLE_SQL = {
    "file_roots": f"""WITH f AS (SELECT c_nationkey, encode(string_agg(c_custkey || ' ' || c_name || chr(10), '' ORDER BY c_custkey)) AS b FROM customer GROUP BY c_nationkey),
        l0 AS (SELECT c_nationkey, octet_length(b) AS bytes, part, ceil(octet_length(b) / {_RANGE})::BIGINT AS parts, sha256('\\x00'::BLOB || b[part * {_RANGE} + 1:(part + 1) * {_RANGE}]) AS h FROM (SELECT *, unnest(range(0, ceil(octet_length(b) / {_RANGE})::BIGINT)) AS part FROM f)),
        {_FOLDS}
        SELECT c_nationkey, bytes, h AS root FROM l{_LEVELS}""",
    "csv_round_trip": """SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, CASE turn % 3 WHEN 0 THEN '=sum ' || role WHEN 1 THEN '-' || turn ELSE 'a "b",' || chr(10) || 'c' END AS cell, CASE WHEN turn % 2 = 0 THEN 'x' END AS blank FROM conversations""",
    "feature_rows": "SELECT s_suppkey, s_name, s_nationkey::DOUBLE AS lon, 1::BIGINT AS n FROM supplier",
    "json_rows": "SELECT p_partkey, p_name FROM part",
    "aliased_rows": """SELECT CASE WHEN c_custkey % 9 <> 0 THEN 'kept' ELSE 'no_key' END AS kind, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey::VARCHAR END AS permit_id, c_name AS name, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS segment, NULL::VARCHAR AS issued
        FROM customer WHERE c_custkey % 9 <> 0 OR c_name NOT LIKE '%0'""",
    "archived_snapshots": CTE + """ SELECT snapshot_date, count(*) AS rows, count(DISTINCT global_id) AS ids, CASE snapshot_date WHEN '2026-08-31' THEN 'reused 2026-08-31;unchanged;written' WHEN '2026-09-30' THEN 'written' ELSE 'refused;written' END AS said,
        (SELECT count(*) FROM snap WHERE snapshot_date = '2026-09-30') AS of_september FROM snap GROUP BY snapshot_date""",
    "archive_catalog": CTE + """, n AS (SELECT snapshot_date AS day, count(*) AS rows FROM snap GROUP BY snapshot_date)
        SELECT label AS snapshot_date, rows, retrieved, ok AS well_labelled, newest AS newest_of_content, copies AS dates_with_content FROM n JOIN (VALUES ('2026-08-31', '2026-08-31', '2026-08-31T18:00:00Z', true, '2026-08-31', 1::BIGINT),
          ('2026-09-29', '2026-09-30', '2026-09-30T18:00:00Z', false, '2026-09-29', 1), ('2026-10-31', '2026-10-31', '2026-10-31T18:00:00Z', true, '2026-11-30', 2), ('2026-11-30', '2026-10-31', '2026-11-30T18:00:00Z', true, '2026-11-30', 2)) v(label, day, retrieved, ok, newest, copies) USING (day)""",
    "observed_snapshots": CTE + " SELECT snapshot_date, count(*) AS rows FROM snap GROUP BY snapshot_date",
    "month_partitions": f"""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS event_month, lower(o_orderpriority) AS source_name, o_orderstatus FROM orders)
        SELECT event_month, count(*) AS rows, {_LISTED.format(c='source_name')} AS by_source, {_LISTED.format(c='o_orderstatus')} AS by_type FROM m GROUP BY event_month""",
    "split_by_source": "SELECT o_orderpriority, count(*) AS rows, true AS sound, (SELECT count(DISTINCT o_orderpriority) FROM orders) AS folders, (SELECT count(*) FROM orders) AS n, (SELECT count(*) FROM orders) AS written FROM orders GROUP BY o_orderpriority",
    "page_tables": """WITH n AS (SELECT l_orderkey AS page_id, count(*) AS n, max(l_linenumber)::BIGINT AS line, max(l_partkey) AS part FROM lineitem GROUP BY l_orderkey)
        SELECT page_id, c::INTEGER AS "column", n + 1 AS cells, n AS last_row, CASE c WHEN 0 THEN line ELSE part END AS largest FROM n, (VALUES (0), (1)) t(c)""",
    "page_labels": "SELECT o_orderkey AS page_id, o_orderstatus AS record_status, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority FROM orders",
    "text_functions": """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'https://example.org/a?k=' || o_orderkey || '&m=2' WHEN 1 THEN 'plain text' ELSE 'none' END AS url, o_orderkey::VARCHAR AS stripped,
        regexp_replace((o_orderkey + 1000000)::VARCHAR, '^(\\d+)(\\d{4})$', '\\1.\\2') AS folio, o_orderkey::VARCHAR AS k, NULL::VARCHAR AS missing, ['passed', 'final', 'failed', NULL, 'failed'][o_orderkey % 5 + 1] AS outcome, 'record number' AS header FROM orders""",
    "time_functions": """SELECT event_id, CASE WHEN event_id % 4 < 3 THEN floor(epoch(ts))::BIGINT END AS seconds, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d') AS local_day,
        CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%Y-%m-%d') WHEN event_id % 3 <> 0 THEN '2020-02-03' END AS first_date, CASE WHEN event_id % 5 = 0 THEN 'a' WHEN event_id % 3 <> 0 THEN 'b' END AS first_field FROM events""",
    "map_functions": """SELECT event_id, CASE WHEN user_id % 2 = 0 THEN event_type ELSE user_id::VARCHAR END AS looked_up, CASE WHEN user_id % 2 = 0 THEN event_type ELSE event_type || ' | ' || user_id END AS combined, event_type AS field, 'no object' AS no_field, true AS same_hash,
        CASE WHEN event_id % 2 = 0 THEN sha256('own|' || user_id || '|' || event_id) ELSE sha256('content|' || user_id || '|' || event_type) END AS child_id FROM events""",
    "multipolygon_points": """WITH p AS (SELECT c_custkey, c_custkey % 27 + 0.5 AS x, (c_custkey // 27) % 11 + 0.5 AS y FROM customer)
        SELECT c_custkey, (x < 10 AND y < 10 AND NOT (x > 2 AND x < 6 AND y > 2 AND y < 6)) OR (x > 20 AND x < 25 AND y < 5) AS inside, 15::BIGINT AS vertices FROM p""",
    "frame_fingerprint": "SELECT 's-' || lpad((row_number() OVER (ORDER BY o_orderkey))::VARCHAR, 4, '0') AS sample_id, o_orderkey, true AS same, (SELECT count(*) FROM orders) AS rows FROM orders ORDER BY o_orderkey LIMIT 20",
}
