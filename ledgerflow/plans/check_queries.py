"""Queries on derived events, samples, reviews, data quality, privacy, audits, pages, places and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.functions import dates, geo, ids, jsonmap, numbers, text, urls
from ledgerflow.operators import audit, derive, privacy, quality, review, sampling, spatial
from ledgerflow.plans.snapshots import table
from ledgerflow.sources import pages as page_source

# --- derived events ---------------------------------------------------------------------------


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered, shipped, returned and finished events of line items' orders."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.withColumn("item", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    items = [
        ("ordered", F.col("o_orderdate"), F.col("l_linenumber") == 1),
        ("shipped", F.col("l_shipdate"), F.lit(True)),
        ("returned", F.date_add(F.col("l_shipdate").cast("date"), 30), F.col("l_returnflag") == "R"),
        ("finished", F.last_day(F.col("l_shipdate").cast("date")), (F.col("o_orderstatus") == "F") & (F.col("l_linenumber") == 1)),
    ]
    return derive.events(rows, "item", items)


def amounts_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = derive.amounts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_discount", "l_tax"])
    return out.groupBy("measure").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


def match_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.match_diagnostics(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", "l_partkey")


def parcel_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 100).alias("activity"), (F.col("l_suppkey") % 7).alias("folio"), "l_returnflag", "l_linestatus")
    return derive.grouped_links(links, ["activity", "folio"], "l_returnflag", "l_linestatus", {"O": 1, "F": 2})


def census_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer")
    return derive.universe_counts(people.where("c_acctbal > 0 or c_nationkey % 6 = 0"), people.where("c_nationkey % 6 <> 0"), ["c_nationkey", "c_mktsegment"])


def investigation_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    claims = {"completion": F.col("o_orderstatus") != "F", "price": F.col("o_totalprice") > 300000}
    return derive.cases(o, "o_orderkey", claims, {"customer": F.col("o_custkey"), "status": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))})


# --- samples and reviews ----------------------------------------------------------------------


def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("stratum"))


def stratified_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in ten of each language by hash rank."""
    u = _universe(spark, sf_dir)
    quotas = {k: -(-n // 10) for k, n in sampling.stratum_sizes(u, "stratum").items()}
    return sampling.stratified(u, "doc_id", "stratum", quotas, 42, "study")


def two_phase_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phases of two disjoint draws of a twentieth each: sizes per stratum."""
    u = _universe(spark, sf_dir)
    n = max(8, sum(sampling.stratum_sizes(u, "stratum").values()) // 20)
    return sampling.two_phase(u, "doc_id", "stratum", n, n, 42, "study").select("doc_id", "stratum", "phase", "rank")


def category_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sampling.by_category(docs.select("doc_id", "lang", "n_chars"), "doc_id", {"long": F.col("n_chars") > 2000, "german": F.col("lang") == "de", "any": F.lit(True)}, 25, 42, "study").select("doc_id", "category")


def second_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second draw among the drawn, without the reviewers' columns."""
    first = stratified_draw(spark, sf_dir).select("doc_id", "stratum")
    quotas = {k: -(-n // 5) for k, n in sampling.stratum_sizes(first, "stratum").items()}
    return sampling.stratified(first, "doc_id", "stratum", quotas, 42, "study", "second").select("doc_id", "stratum", "rank")


def proportional_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas of a tenth of the documents over sources, one at least."""
    sizes = sampling.stratum_sizes(table(spark, sf_dir, "documents"), "source")
    quota = sampling.allocate(sizes, max(len(sizes), sum(sizes.values()) // 10), 1)
    return spark.createDataFrame([(k, sizes[k], q) for k, q in quota.items()], "source string, population long, quota long")


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")


def claim_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.precision(_reviews(spark, sf_dir), ["lang"], F.when(F.col("doc_id") % 9 != 0, F.col("quality") == 1))


def weighted_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.weighted_precision(_reviews(spark, sf_dir).withColumn("weight", F.col("doc_id") % 7 + 1), ["lang"], F.col("quality") == 1, "weight")


def kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.kappa(_reviews(spark, sf_dir).withColumn("clean", 1 - F.col("toxic")), "quality", "clean")


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.confusion(_reviews(spark, sf_dir), "quality", "toxic")


def recall_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _reviews(spark, sf_dir).withColumn("size", F.when(F.col("n_chars") > 2000, "long").otherwise("short"))
    return review.recall(rows.where("quality = 1"), rows.where("toxic = 0 and doc_id % 4 <> 0"), "doc_id", ["lang", "size"])


def review_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.coverage(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").where("doc_id % 20 <> 3"), "doc_id", "source")


def category_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.proportions(table(spark, sf_dir, "documents").where("lang is not null"), "lang", ["en", "de", "fr", "es", "it"])


def pooled_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return review.pooled_weights(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi"), docs, "source")


# --- data quality -----------------------------------------------------------------------------


def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, references, vocabularies, ranges, dates and sets of the trade tables as check rows."""
    t = lambda n: table(spark, sf_dir, n)
    o, li, c = t("orders"), t("lineitem"), t("customer")
    odd, even = o.where("o_orderkey % 2 = 1"), o.where("o_orderkey % 2 = 0")
    return quality.together(
        [
            quality.unique(o, ["o_orderkey"], "orders_key_unique"),
            quality.unique(li, ["l_orderkey"], "lineitem_order_unique"),
            quality.foreign_key(li, "l_orderkey", o, "o_orderkey", "lineitem_order_exists"),
            quality.foreign_key(li, "l_suppkey", t("supplier").where("s_suppkey % 3 <> 0"), "s_suppkey", "lineitem_supplier_exists"),
            quality.vocabulary(o, "o_orderstatus", ["F", "O"], "order_status_known"),
            quality.in_range(li, "l_discount", 0.0, 0.05, "discount_in_range"),
            quality.rule(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")), F.col("l_shipdate") >= F.col("o_orderdate"), "shipped_after_ordered"),
            quality.same_keys(c.select(F.col("c_custkey").alias("k")), o.select(F.col("o_custkey").alias("k")), "k", "customers_equal_buyers"),
            quality.subset(o.select(F.col("o_custkey").alias("k")), c.select(F.col("c_custkey").alias("k")), "k", "buyers_are_customers"),
            quality.disjoint(odd.select("o_custkey"), even.select("o_custkey"), "o_custkey", "odd_and_even_buyers_differ"),
            quality.partition([odd, even], o, "o_orderkey", "odd_and_even_make_all"),
        ]
    )


def dq_added_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return quality.added_removed(e.where("event_id % 3 <> 0").select("event_id"), e.where("event_id % 5 <> 0").select("event_id"), "event_id")


def dq_copy_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer")
    copy = raw.withColumn("c_name", F.when(F.col("c_custkey") % 10 == 0, F.upper("c_name")).otherwise(F.col("c_name"))).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 50 != 0, F.col("c_mktsegment")))
    return quality.copy_fidelity(raw, copy, "c_custkey", ("c_name", "c_nationkey", "c_mktsegment"))


def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    declared = o.groupBy("year").agg((F.count("*") + F.when(F.col("year") == 1995, 1).otherwise(0)).alias("expected"))
    return quality.reconcile_counts(declared, o, "year")


def dq_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "orders").select(F.lower("o_orderstatus").alias("source"), F.col("o_orderkey").alias("id"))
    declared = li.groupBy("source").agg(F.count("*").alias("expected"))
    fetched = li.where("not (source = 'o' and id % 50 = 0)").unionByName(li.where("source = 'f' and id % 70 = 0"))
    return quality.collection(declared, li, fetched, "source", "id")


def dq_partition_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: months of a window without an order, and orders outside it."""
    return quality.partition_gaps(table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date"), "o_custkey", "1995-01-01", "1999-12-01")


def fingerprint_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return quality.same_contents(o, o.repartition(3, "o_custkey").withColumn("read_at", F.lit("later")).select("read_at", *reversed(o.columns)), "read_at")


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"), F.when(F.col("value") > 50, F.col("value")).alias("value"), F.when(F.col("event_id") % 2 == 0, " ").alias("note"))
    return quality.completeness(e, e.columns)


def small_group_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return quality.suppress_small(counts, "n", 3)


def qa_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"rows": F.count("*"), "customers": F.countDistinct("o_custkey"), "finished": F.count_if(F.col("o_orderstatus") == "F"), "largest": F.round(F.max("o_totalprice"), 2)}
    return quality.summary(table(spark, sf_dir, "orders"), measures)


def dq_sample_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sample_design(stratified_draw(spark, sf_dir), "stratum")


# --- privacy ----------------------------------------------------------------------------------


def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", privacy.pii_label(F.col("source"), F.col("text")).alias("label"))
    return docs.where("label is not null")


def redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("redacted", privacy.redact(F.col("text")))
    return docs.where("redacted <> text").select("doc_id", F.sha2("redacted", 256).alias("redacted_sha256"))


def scrub_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    attrs = F.map_concat(jsonmap.json_map(F.col("props")), F.create_map(F.lit("Owner"), F.concat(F.lit("user "), F.col("user_id").cast("string")), F.lit("kind"), F.col("event_type")))
    out = privacy.scrubbed(e.select("event_id", attrs.alias("attrs")), "attrs", ["owner"])
    return out.select("event_id", F.array_join(F.array_sort(F.map_keys("attrs")), ";").alias("keys"), F.element_at("attrs", F.lit("k")).alias("k"))


def scrub_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.create_map(F.lit("Owner"), F.when(F.col("event_id") % 3 == 0, F.lit("x")), F.lit("Phone"), F.lit("1"), F.lit("kind"), F.col("event_type")).alias("attrs"))
    return privacy.removal_counts(e, "attrs", ["owner", "phone"])


def leak_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("props", F.when(F.col("event_id") % 11 == 1, '{"OWNER": "x"}').otherwise(F.col("props")))
    return privacy.leaks(e, "props", ["owner"]).select("event_id")


def csv_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells made from customers: safe form, and whether it comes back."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    start = F.element_at(F.array(*[F.lit(x) for x in ("=", "-", "", "@", "+1.5", "'", "'+2", "-3e5", " =")]), (key % 9 + 1).cast("int"))
    cell = F.when(start.rlike("[0-9]"), start).otherwise(F.concat(start, "c_name"))
    safe = text.neutralize_csv_cell(cell)
    return c.select("c_custkey", safe.alias("safe"), (text.restore_csv_cell(safe) == cell).alias("restored"))


# --- audits -----------------------------------------------------------------------------------


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as hash chains; one in thirteen turns has been tampered with."""
    t = table(spark, sf_dir, "conversations").where("turn is not null")
    content = F.sha2(F.coalesce("text", F.lit("")), 256)
    link = lambda turn, body: ids.hash_id(F.lit("turn"), turn.cast("string"), body)
    by = Window.partitionBy("conv_id").orderBy("turn")
    rows = t.withColumn("content", content)
    rows = rows.withColumn("previous_hash", F.coalesce(F.lag(link(F.col("turn"), F.col("content"))).over(by), F.lit("")))
    rows = rows.withColumn("event_hash", link(F.col("turn"), F.col("content")))
    return rows.withColumn("content", F.when((F.col("conv_id") + F.col("turn")) % 13 == 0, F.lit("changed")).otherwise(F.col("content")))


def chain_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chain(spark, sf_dir)
    stored = rows.withColumn("event_hash", audit.chain_hash(F.col("turn"), F.col("previous_hash"), F.sha2(F.coalesce("text", F.lit("")), 256)))
    return audit.verify_chain(stored, "conv_id", "turn", F.col("content"), "previous_hash", "event_hash")


def budget_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("value", F.round(F.col("value"), 2))
    out = audit.budgets(e, "user_id", "event_type", "value", 70, 20, 4000.0)
    return out.withColumn("cost", F.round("cost", 2))


def repeatability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.repeatability(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_linenumber", ["l_returnflag", "l_linestatus"])


def source_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    url = F.when(F.col("page_id") % 5 == 0, F.regexp_replace("url", "^https?", "http")).otherwise(F.regexp_replace("url", "^https?", "https"))
    out = p.withColumn("t", urls.source_tier(url, {"example.com": 1, "example.org": 2}))
    return out.select("page_id", "t.tier", "t.reason")


def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a listing of two thirds of them against the texts, some changed."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    listed = docs.where("doc_id % 3 <> 0").withColumn("sha256", F.when(F.col("doc_id") % 10 == 1, "0").otherwise(F.col("sha256")))
    return audit.manifest_check(listed, docs.where("doc_id % 7 <> 0"))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.when(F.col("o_orderstatus") == "F", "done").otherwise("open").alias("status"), F.when(~((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 100 == 0)), F.round("o_totalprice", 2)).alias("cost"))
    return audit.run_metrics(o, "o_orderpriority", "status", "cost").withColumn("mean_cost", F.round("mean_cost", 2)).withColumn("total_cost", F.round("total_cost", 2))


def forbidden_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("out", F.when(F.col("event_id") % 9 == 0, F.concat(F.lit('{"a": {"Verdict": 1}, "p": '), "props", F.lit("}"))).otherwise(F.col("props")))
    return audit.forbidden(e, "event_id", "out", ["verdict"], "event_type", ["click", "view", "purchase"])


# --- pages ------------------------------------------------------------------------------------


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.titles(table(spark, sf_dir, "pages"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.links(table(spark, sf_dir, "pages")).select("page_id", "position", "href")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.texts(table(spark, sf_dir, "pages")).select("page_id", F.sha2("text", 256).alias("text_sha256"), F.length("text").alias("n"))


def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.elements(table(spark, sf_dir, "pages"), "p").groupBy("page_id").agg(F.count("*").alias("paragraphs"))


# --- places -----------------------------------------------------------------------------------


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("p_id"), (F.col("embedding")[0].cast("double") * 10).alias("lon"), (F.col("embedding")[1].cast("double") * 10).alias("lat"))


def _squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    spread = lambda factor, modulus: F.round(F.col("c_custkey") * factor % modulus / float(modulus) * 8.0 - 4.0, 3)
    x, y = spread(2741, 10007), spread(6029, 10009)
    corner = lambda a, b: F.array(x + a, y + b)
    return c.select(F.col("c_custkey").alias("s_id"), F.array(corner(0.0, 0.0), corner(0.5, 0.0), corner(0.5, 0.5), corner(0.0, 0.5), corner(0.0, 0.0)).alias("ring"))


def spatial_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.contains(_points(spark, sf_dir), _squares(spark, sf_dir), 0.5).select("p_id", "s_id")


def footprint_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as places at and around their customers' buildings, some with the building's address: which buildings an activity has."""
    small, width = 100.0, 0.0005
    squares = _squares(spark, sf_dir).select(F.col("s_id"), (F.col("ring")[0][0] / small).alias("x"), (F.col("ring")[0][1] / small).alias("y"))
    corner = lambda a, b: F.array(F.col("x") + a, F.col("y") + b)
    ring = F.array(corner(0.0, 0.0), corner(width, 0.0), corner(width, width), corner(0.0, width), corner(0.0, 0.0))
    address = lambda k: F.concat_ws(" ", (k % 500).cast("string"), F.lit("BAY AVE"))
    buildings = squares.select("s_id", ring.alias("ring"), F.when(F.col("s_id") % 9 != 0, address(F.col("s_id"))).alias("address"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("s_id")).join(squares, "s_id")
    # inside, beside with and without the address, at a corner, and far off
    kind = F.col("o_orderkey") % 5
    away = lambda *d: F.element_at(F.array(*[F.lit(v) for v in d]), (kind + 1).cast("int"))
    places = orders.select(
        (F.col("o_orderkey") % 2000).alias("activity"), F.col("o_orderkey").alias("p_id"), (F.col("x") + away(0.0001, 0.0008, 0.0008, 0.00051, 0.003)).alias("lon"), (F.col("y") + away(0.0002, 0.0002, 0.0002, 0.00025, 0.003)).alias("lat"),
        F.when(kind.isin(1, 4), address(F.col("s_id"))).when(kind == 2, "1 OTHER ST").alias("address"),
    )
    return spatial.footprints(places, buildings, 0.003).select("activity", "s_id", "p_id", "method", "confidence", F.round("distance_m", 1).alias("distance_m"))


def spatial_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = _squares(spark, sf_dir).select("s_id", F.col("ring")[0][0].alias("s_lon"), F.col("ring")[0][1].alias("s_lat"))
    return spatial.nearest(_points(spark, sf_dir), corners, 30000.0).withColumn("distance_m", F.round("distance_m", 1))


def geometry_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroid and box of squares that come as GeoJSON text."""
    rows = _squares(spark, sf_dir).select("s_id", F.concat(F.lit('{"type":"Polygon","coordinates":['), F.to_json("ring"), F.lit("]}")).alias("g"))
    pts = rows.withColumn("v", geo.vertices(F.col("g"))).withColumn("c", geo.centroid(F.col("v"))).withColumn("b", geo.bbox(F.col("v")))
    return pts.select("s_id", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"), F.round("b.west", 6).alias("west"), F.round("b.north", 6).alias("north"))


# --- scalar functions -------------------------------------------------------------------------


def address_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    raw = F.concat_ws(" ", F.col("c_custkey").cast("string"), F.lit("north"), "c_name", F.when(F.col("c_custkey") % 2 == 0, "Street.").otherwise("boulevard"))
    return c.select("c_custkey", text.normalize_address(raw).alias("address"), text.token(F.col("c_name")).alias("token"), text.address_parts(F.concat(raw, F.lit(", 33602"))).getField("postal_code").alias("postal_code"))


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    seconds = F.unix_date(day).cast("long") * 86400
    raw = (
        F.when(key % 6 == 0, seconds.cast("string")).when(key % 6 == 1, (seconds * 1000).cast("string")).when(key % 6 == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 6 == 3, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T05:00:00Z"))).when(key % 6 == 4, "13/45/2020").otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    out = dates.parse_date(raw, 1993, 2100)
    return o.select("o_orderkey", F.date_format(out, "yyyy-MM-dd").alias("day"), dates.period_bucket(out, 3, 1994).alias("bucket"))


def parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    plain = F.round(F.abs("c_acctbal"), 2).cast("decimal(18,2)").cast("string")
    raw = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("($"), plain, F.lit(")"))).when(F.col("c_custkey") % 10 == 0, "n/a").otherwise(F.concat(F.lit("$ "), plain))
    return c.select("c_custkey", numbers.money(raw).cast("double").alias("amount"))


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(
        "o_orderkey", ids.short_id("src", F.lit("orders"), key).alias("src_id"), ids.record_id([F.col("o_custkey"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus"))], F.concat(F.lit("ord-"), key)).alias("record_id"),
        ids.sample_rank(42, "s", "p", F.col("o_orderstatus"), key).alias("rank_token"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        lifecycle_events, amounts_unpivot, match_diagnostics, parcel_links, census_universe, investigation_cases, stratified_draw, two_phase_draw, category_draw, second_review,
        proportional_quota, claim_precision, weighted_precision, kappa, confusion, recall_ci, review_coverage, category_shares, pooled_weights, dq_checks, dq_added_removed,
        dq_copy_fidelity, dq_reconcile, dq_collection, dq_partition_gaps, fingerprint_equal, completeness, small_group_suppression, qa_summary, dq_sample_design, pii_scan,
        redact, scrub_map, scrub_counts, leak_scan, csv_safety, chain_verify, budget_audit, repeatability, source_tier, manifest_check, run_metrics, forbidden_audit, page_title,
        page_links, page_text, page_paragraphs, spatial_contains, footprint_matches, spatial_nearest, geometry_functions, address_normalize, parse_dates, parse_money, stable_ids,
    )
}

_W = "1.959963984540054"


def _wilson(k: str, n: str) -> str:
    p = f"({k} / {n}::DOUBLE)"
    half = f"{_W} * sqrt({p} * (1 - {p}) / {n} + {_W} * {_W} / (4.0 * {n} * {n})) / (1 + {_W} * {_W} / {n})"
    mid = f"({p} + {_W} * {_W} / (2.0 * {n})) / (1 + {_W} * {_W} / {n})"
    return f"CASE WHEN {n} > 0 THEN round({p}, 6) END AS estimate, CASE WHEN {n} > 0 THEN round(greatest(0, {mid} - {half}), 6) END AS lower, CASE WHEN {n} > 0 THEN round(least(1, {mid} + {half}), 6) END AS upper"


_RANKED = """WITH u AS (SELECT doc_id, coalesce(lang, 'none') AS stratum FROM documents), n AS (SELECT stratum, count(*) AS population, ceil(count(*) / 10.0)::BIGINT AS quota FROM u GROUP BY ALL),
r AS (SELECT u.doc_id, u.stratum, quota, population, (row_number() OVER (PARTITION BY u.stratum ORDER BY sha256(concat_ws('|', '42', 'study', 'primary', u.stratum, u.doc_id::VARCHAR)), doc_id))::INTEGER AS rank FROM u JOIN n USING (stratum))"""


def quota_sql(name: str, sizes: str, target: str, least: int, rounds: int = 8) -> str:
    """CTEs that hand out target over strata (k, n) of a table: in proportion, never beyond n, remainders last; ``name`` has k, n and q."""
    out = [f"{name}0 AS (SELECT k, n, least({least}, n)::BIGINT AS q, {target} AS t FROM {sizes} WHERE n > 0)"]
    for i in range(rounds):
        shared = f"SELECT *, t - sum(q) OVER () AS rest, sum(CASE WHEN q < n THEN n END) OVER () AS open FROM {name}{i}"
        given = f"SELECT *, CASE WHEN q < n AND rest > 0 THEN rest * n / open::DOUBLE ELSE 0 END AS share FROM ({shared})"
        whole = f"SELECT *, CASE WHEN q < n THEN least(n - q, floor(share)) ELSE 0 END AS more FROM ({given})"
        ranked = f"SELECT *, sum(more) OVER () AS got, row_number() OVER (ORDER BY (q >= n), floor(share) - share, k) AS place FROM ({whole})"
        step = "CASE WHEN rest <= 0 THEN 0 WHEN got > 0 THEN more WHEN q < n AND place <= rest THEN 1 ELSE 0 END"
        out.append(f"{name}{i + 1} AS MATERIALIZED (SELECT k, n, (q + {step})::BIGINT AS q, t FROM ({ranked}))")
    return ", ".join([*out, f"{name} AS (SELECT k, n, q FROM {name}{rounds})"])


def _phase_sql(name: str, rows: str, purpose: str) -> str:
    """CTEs: the quotas of a phase and its draw."""
    token = f"sha256(concat_ws('|', '42', 'study', '{purpose}', stratum, doc_id::VARCHAR))"
    return f"""n_{name} AS (SELECT stratum AS k, count(*) AS n FROM {rows} GROUP BY stratum), {quota_sql(f"q_{name}", f"n_{name}", "(SELECT t FROM target)", 0)},
        {name} AS MATERIALIZED (SELECT doc_id, stratum, '{purpose}' AS phase, rank FROM (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY {token}, doc_id))::INTEGER AS rank FROM {rows}) JOIN q_{name} ON stratum = k WHERE rank <= q)"""


_REVIEWS = "WITH r AS (SELECT l.*, lang, source, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
POINTS_SQL = """WITH pt AS (SELECT vec_id AS p_id, embedding[1]::DOUBLE * 10 AS lon, embedding[2]::DOUBLE * 10 AS lat FROM embeddings),
sq AS (SELECT c_custkey AS s_id, round((c_custkey * 2741 % 10007) / 10007::DOUBLE * 8::DOUBLE - 4, 3) AS x, round((c_custkey * 6029 % 10009) / 10009::DOUBLE * 8::DOUBLE - 4, 3) AS y FROM customer)"""

ORACLE_SQL = {
    "lifecycle_events": """WITH r AS (SELECT l_orderkey || '-' || l_linenumber AS item, * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        e AS (SELECT item, 'ordered' AS event_type, o_orderdate::DATE AS d FROM r WHERE l_linenumber = 1 UNION ALL SELECT item, 'shipped', l_shipdate::DATE FROM r
          UNION ALL SELECT item, 'returned', l_shipdate::DATE + 30 FROM r WHERE l_returnflag = 'R' UNION ALL SELECT item, 'finished', last_day(l_shipdate) FROM r WHERE o_orderstatus = 'F' AND l_linenumber = 1)
        SELECT 'evt-' || left(sha1(concat_ws('|', item, event_type, strftime(d, '%Y-%m-%d'))), 16) AS event_id, item, event_type, strftime(d, '%Y-%m-%d') AS event_date FROM e WHERE d IS NOT NULL""",
    "amounts_unpivot": """SELECT measure, count(*) AS n, round(sum(amount), 2) AS amount FROM (SELECT 'l_extendedprice' AS measure, l_extendedprice AS amount FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem) WHERE amount > 0 GROUP BY measure""",
    "match_diagnostics": "SELECT l_returnflag, l_linestatus, count(*) AS rows, count(DISTINCT l_partkey) AS keys, round(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 6) AS share FROM lineitem GROUP BY ALL",
    "parcel_links": """SELECT l_orderkey % 100 AS activity, l_suppkey % 7 AS folio, count(*) AS links, string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS evidence, CASE WHEN bool_or(l_linestatus = 'F') THEN 'F' ELSE 'O' END AS best FROM lineitem GROUP BY ALL""",
    "census_universe": """WITH u AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer WHERE c_nationkey % 6 <> 0 GROUP BY ALL), m AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 OR c_nationkey % 6 = 0 GROUP BY ALL)
        SELECT coalesce(u.c_nationkey, m.c_nationkey) AS c_nationkey, coalesce(u.c_mktsegment, m.c_mktsegment) AS c_mktsegment, coalesce(u.n, 0) AS universe, coalesce(m.n, 0) AS members, greatest(0, coalesce(u.n, 0) - coalesce(m.n, 0)) AS missing, u.n IS NULL AS stray
        FROM u FULL JOIN m ON u.c_nationkey = m.c_nationkey AND u.c_mktsegment = m.c_mktsegment""",
    "investigation_cases": """SELECT 'case-' || left(sha1(o_orderkey::VARCHAR), 16) AS case_id, o_orderkey, concat_ws(';', CASE WHEN o_orderstatus <> 'F' THEN 'completion' END, CASE WHEN o_totalprice > 300000 THEN 'price' END) AS claims,
        1 + (o_orderkey % 3 <> 0)::BIGINT AS known_evidence, '[{"name":"customer","value":"' || o_custkey || '"}' || CASE WHEN o_orderkey % 3 <> 0 THEN ',{"name":"status","value":"' || o_orderstatus || '"}' ELSE '' END || ']' AS known_json
        FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 300000""",
    "proportional_quota": "WITH s AS (SELECT source AS k, count(*) AS n FROM documents GROUP BY source), " + quota_sql("a", "s", "(SELECT greatest(count(*), sum(n) // 10) FROM s)", 1) + " SELECT k AS source, n AS population, q AS quota FROM a",
    "two_phase_draw": "WITH u AS MATERIALIZED (SELECT doc_id, coalesce(lang, 'none') AS stratum FROM documents), target AS (SELECT greatest(8, count(*) // 20) AS t FROM u), "
        + _phase_sql("a", "u", "development") + ", rest AS MATERIALIZED (SELECT * FROM u WHERE doc_id NOT IN (SELECT doc_id FROM a)), " + _phase_sql("b", "rest", "holdout") + " SELECT * FROM a UNION ALL SELECT * FROM b",
    "stratified_draw": _RANKED + " SELECT *, round(quota / population::DOUBLE, 12) AS probability, round(population / quota::DOUBLE, 12) AS weight FROM r WHERE rank <= quota",
    "category_draw": """WITH d AS (SELECT doc_id, lang, n_chars FROM documents), a AS (SELECT doc_id FROM d WHERE n_chars > 2000 ORDER BY sha256(concat_ws('|', '42', 'study', 'long', 'long', doc_id::VARCHAR)), doc_id LIMIT 25),
        b AS (SELECT doc_id FROM d WHERE lang = 'de' AND doc_id NOT IN (SELECT doc_id FROM a) ORDER BY sha256(concat_ws('|', '42', 'study', 'german', 'german', doc_id::VARCHAR)), doc_id LIMIT 25),
        c AS (SELECT doc_id FROM d WHERE doc_id NOT IN (SELECT doc_id FROM a UNION ALL SELECT doc_id FROM b) ORDER BY sha256(concat_ws('|', '42', 'study', 'any', 'any', doc_id::VARCHAR)), doc_id LIMIT 25)
        SELECT doc_id, 'long' AS category FROM a UNION ALL SELECT doc_id, 'german' FROM b UNION ALL SELECT doc_id, 'any' FROM c""",
    "second_review": _RANKED + """, f AS (SELECT doc_id, stratum FROM r WHERE rank <= quota), s AS (SELECT doc_id, stratum, ceil(count(*) OVER (PARTITION BY stratum) / 5.0) AS q,
        (row_number() OVER (PARTITION BY stratum ORDER BY sha256(concat_ws('|', '42', 'study', 'second', stratum, doc_id::VARCHAR)), doc_id))::INTEGER AS rank FROM f) SELECT doc_id, stratum, rank FROM s WHERE rank <= q""",
    "claim_precision": _REVIEWS + f", c AS (SELECT lang, count(*) FILTER (doc_id % 9 <> 0) AS reviewed, count(*) FILTER (doc_id % 9 <> 0 AND quality = 1) AS correct FROM r GROUP BY lang) SELECT lang, reviewed, correct, {_wilson('correct', 'reviewed')} FROM c",
    "weighted_precision": _REVIEWS + " SELECT lang, round(sum(CASE WHEN quality = 1 THEN w ELSE 0 END) / sum(w)::DOUBLE, 6) AS weighted_precision, round(sum(w)::DOUBLE * sum(w) / sum(w * w), 6) AS effective_n FROM (SELECT *, doc_id % 7 + 1 AS w FROM r) GROUP BY lang",
    "kappa": _REVIEWS + """, p AS (SELECT quality AS a, 1 - toxic AS b FROM r), n AS (SELECT count(*)::DOUBLE AS n, sum((a = b)::INT) AS agree, sum(a)::DOUBLE AS a1, sum(b)::DOUBLE AS b1 FROM p)
        SELECT n::BIGINT AS pairs, round(agree / n, 6) AS agreement, round((agree / n - e) / (1 - e), 6) AS kappa FROM (SELECT *, (a1 * b1 + (n - a1) * (n - b1)) / (n * n) AS e FROM n)""",
    "confusion": _REVIEWS + " SELECT quality AS predicted, toxic AS reviewed, count(*) AS n FROM r GROUP BY ALL",
    "recall_ci": _REVIEWS + f", c AS (SELECT lang, CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS size, count(*) AS total, count(*) FILTER (toxic = 0 AND doc_id % 4 <> 0) AS found FROM r WHERE quality = 1 GROUP BY ALL) SELECT lang, size, total, found, {_wilson('found', 'total')} FROM c",
    "review_coverage": """SELECT source, count(*) AS assigned, count(l.doc_id) AS reviewed, CASE WHEN count(l.doc_id) > 0 THEN round(count(l.doc_id) / count(*)::DOUBLE, 6) END AS coverage, count(l.doc_id) = count(*) AS complete
        FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE doc_id % 20 <> 3) l ON d.doc_id = l.doc_id GROUP BY source""",
    "category_shares": f"WITH c AS (SELECT v.lang, count(d.doc_id) AS n, (SELECT count(*) FROM documents WHERE lang IS NOT NULL) AS total FROM (VALUES ('en'), ('de'), ('fr'), ('es'), ('it')) v(lang) LEFT JOIN documents d ON d.lang = v.lang GROUP BY v.lang) SELECT lang, n, total, {_wilson('n', 'total')} FROM c",
    "pooled_weights": "SELECT source, population, drawn, round(population / drawn::DOUBLE, 12) AS weight FROM (SELECT source, count(*) AS population, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS drawn FROM documents GROUP BY source) WHERE drawn > 0",
    "dq_checks": """WITH c AS (
        SELECT 'orders_key_unique' AS check, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS faults
        UNION ALL SELECT 'lineitem_order_unique', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))
        UNION ALL SELECT 'lineitem_order_exists', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
        UNION ALL SELECT 'lineitem_supplier_exists', (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0))
        UNION ALL SELECT 'order_status_known', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
        UNION ALL SELECT 'discount_in_range', (SELECT count(*) FROM lineitem WHERE NOT (l_discount BETWEEN 0 AND 0.05))
        UNION ALL SELECT 'shipped_after_ordered', (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate)
        UNION ALL SELECT 'customers_equal_buyers', (SELECT count(*) FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL)
        UNION ALL SELECT 'buyers_are_customers', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
        UNION ALL SELECT 'odd_and_even_buyers_differ', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 2 = 1 AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0))
        UNION ALL SELECT 'odd_and_even_make_all', 0)
        SELECT check, faults = 0 AS passed, faults FROM c""".replace("'orders_key_unique' AS check", "'orders_key_unique' AS \"check\"").replace("SELECT check,", 'SELECT "check",'),
    "dq_added_removed": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'added' ELSE 'removed' END AS side FROM events WHERE (event_id % 3 = 0) <> (event_id % 5 = 0)",
    "dq_copy_fidelity": """SELECT 'c_name' AS field, count(*) AS compared, count(*) FILTER (c_custkey % 10 = 0 AND upper(c_name) <> c_name) AS differing FROM customer UNION ALL SELECT 'c_nationkey', count(*), 0 FROM customer UNION ALL SELECT 'c_mktsegment', count(*), count(*) FILTER (c_custkey % 50 = 0) FROM customer""",
    "dq_reconcile": "SELECT year(o_orderdate)::INTEGER AS year, count(*) + (year(o_orderdate) = 1995)::BIGINT AS expected, count(*) AS actual, year(o_orderdate) <> 1995 AS passed FROM orders GROUP BY year(o_orderdate)",
    "dq_collection": """WITH l AS (SELECT lower(o_orderstatus) AS source, o_orderkey AS k FROM orders), s AS (SELECT source, count(*) AS n, count(*) FILTER (source = 'o' AND k % 50 = 0) AS missing, count(*) FILTER (source = 'f' AND k % 70 = 0) AS repeated FROM l GROUP BY source)
        SELECT source, n AS expected, n AS inventory, n - missing + repeated AS fetched, missing, 0::BIGINT AS foreign, repeated, missing + repeated = 0 AS passed FROM s""".replace("AS foreign", 'AS "foreign"'),
    "dq_partition_gaps": """WITH o AS (SELECT o_custkey, o_orderdate::DATE AS d FROM orders)
        SELECT o_custkey, count(*) AS rows, count(*) FILTER (NOT (d BETWEEN DATE '1995-01-01' AND DATE '1999-12-31')) AS outside,
          60 - count(DISTINCT strftime(d, '%Y-%m')) FILTER (d BETWEEN DATE '1995-01-01' AND DATE '1999-12-31') AS missing_months FROM o GROUP BY o_custkey""",
    "fingerprint_equal": "SELECT count(*) AS rows_a, count(*) AS rows_b, true AS equal FROM orders",
    "completeness": """WITH e AS (SELECT count(*) AS rows, count(event_id) AS event_id, count(*) FILTER (event_id % 7 <> 0) AS event_type, count(*) FILTER (value > 50) AS value, 0 AS note FROM events)
        SELECT c AS column, p AS populated, rows - p AS blank, round(100 * p / rows::DOUBLE, 1) AS percent FROM (SELECT rows, 'event_id' AS c, event_id AS p FROM e UNION ALL SELECT rows, 'event_type', event_type FROM e UNION ALL SELECT rows, 'value', value FROM e UNION ALL SELECT rows, 'note', note FROM e)""".replace("c AS column", 'c AS "column"'),
    "small_group_suppression": """WITH g AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) SELECT c_nationkey, c_mktsegment, n, 0::BIGINT AS suppressed_groups FROM g WHERE n >= 3
        UNION ALL SELECT NULL, NULL, NULL, (SELECT count(*) FROM g WHERE n < 3)""",
    "qa_summary": """SELECT 'rows' AS metric, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'customers', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'finished', count(*) FILTER (o_orderstatus = 'F') FROM orders UNION ALL SELECT 'largest', round(max(o_totalprice), 2) FROM orders""",
    "dq_sample_design": _RANKED + " SELECT stratum, quota AS drawn, population, true AS passed FROM n",
    "pii_scan": r"""WITH d AS (SELECT doc_id, concat_ws(chr(31), source, text) AS t FROM documents), l AS (SELECT doc_id,
        CASE WHEN regexp_matches(t, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b') THEN 'email address'
             WHEN regexp_matches(t, '(^|[^0-9])(\+?1[-. ]?)?(\([0-9]{3}\)|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}($|[^0-9])') THEN 'phone number'
             WHEN regexp_matches(t, '(^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}($|[^0-9])') THEN 'Social Security number' END AS label FROM d) SELECT * FROM l WHERE label IS NOT NULL""",
    "redact": r"""WITH r AS (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(text, '(?i)\b(bearer)[ \t]+[A-Za-z0-9\-._~+/]+=*', '\1 [redacted]', 'g'),
          '(?i)([?&;](?:access_token|refresh_token|id_token|token|signature|sig|api_key|apikey|client_secret)=)[^&;#\s]+', '\1[redacted]', 'g'),
        '(?i)\b(passphrase|password|passwd|pwd|secret|token|api_key|apikey)(\s*[:=]\s*)["'']?[^\s"'']+', '\1\2[redacted]', 'g') AS t FROM documents) SELECT doc_id, sha256(t) AS redacted_sha256 FROM r WHERE t <> text""",
    "scrub_map": """SELECT event_id, 'k;kind' AS keys, regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS k FROM events""",
    "scrub_counts": "SELECT 'owner' AS key, count(*) FILTER (event_id % 3 = 0) AS removed FROM events UNION ALL SELECT 'phone', count(*) FROM events",
    "leak_scan": "SELECT event_id FROM events WHERE event_id % 11 = 1",
    "csv_safety": """WITH c AS (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN '=' || c_name WHEN 1 THEN '-' || c_name WHEN 2 THEN c_name WHEN 3 THEN '@' || c_name WHEN 4 THEN '+1.5' WHEN 5 THEN '''' || c_name WHEN 6 THEN '''+2' WHEN 7 THEN '-3e5' ELSE ' =' || c_name END AS cell FROM customer)
        SELECT c_custkey, CASE WHEN c_custkey % 9 IN (0, 1, 3, 6, 8) THEN '''' || cell ELSE cell END AS safe, true AS restored FROM c""",
    "chain_verify": """WITH t AS (SELECT conv_id, turn, sha256(coalesce(text, '')) AS good, CASE WHEN (conv_id + turn) % 13 = 0 THEN 'changed' ELSE sha256(coalesce(text, '')) END AS content FROM conversations WHERE turn IS NOT NULL),
        p AS (SELECT *, coalesce(lag(sha256(concat_ws('|', 'turn', turn::VARCHAR, good))) OVER w, '') AS previous FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        h AS (SELECT *, sha256(concat_ws('|', turn::VARCHAR, previous, good)) AS own FROM p),
        v AS (SELECT *, coalesce(lag(own) OVER w, '') AS before, row_number() OVER w AS place, min(turn) OVER (PARTITION BY conv_id) AS first FROM h WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        SELECT conv_id, count(*) AS rows, count(*) FILTER (turn <> first + place - 1) AS gaps, count(*) FILTER (previous <> before) AS broken_links, count(*) FILTER (own <> sha256(concat_ws('|', turn::VARCHAR, previous, content))) AS wrong_hashes FROM v GROUP BY conv_id""",
    "budget_audit": """WITH p AS (SELECT user_id, event_type, count(*) AS n, sum(round(value, 2)) AS c FROM events GROUP BY ALL), u AS (SELECT user_id, sum(n)::BIGINT AS calls, count(*) AS queries, max(n) AS most_repeats, sum(c) AS cost FROM p GROUP BY user_id)
        SELECT user_id, calls, queries, most_repeats, round(cost, 2) AS cost, calls <= 70 AND most_repeats <= 20 AND cost <= 4000 AS within_budget FROM u""",
    "repeatability": """WITH r AS (SELECT l_suppkey, l_linenumber, string_agg(DISTINCT l_returnflag || '|' || l_linestatus, chr(10) ORDER BY l_returnflag || '|' || l_linestatus) AS v FROM lineitem GROUP BY ALL)
        SELECT l_suppkey, count(*) AS repeats, count(DISTINCT v) = 1 AS repeatable FROM r GROUP BY l_suppkey""",
    "source_tier": r"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) AS h FROM pages)
        SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL WHEN h = 'example.org' OR h LIKE '%.example.org' THEN 2 WHEN h = 'example.com' OR h LIKE '%.example.com' THEN 1 END::INTEGER AS tier,
          CASE WHEN h = '' THEN 'invalid_url' WHEN page_id % 5 = 0 THEN 'not_https' WHEN h = 'example.org' OR h LIKE '%.example.org' OR h = 'example.com' OR h LIKE '%.example.com' THEN 'allowed' ELSE 'host_not_listed' END AS reason FROM p""",
    "manifest_check": """SELECT doc_id::VARCHAR AS path, CASE WHEN doc_id % 7 = 0 THEN 'missing' WHEN doc_id % 3 = 0 THEN 'unlisted' WHEN doc_id % 10 = 1 THEN 'changed' ELSE 'ok' END AS status FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 7 <> 0""",
    "run_metrics": """WITH o AS (SELECT o_orderpriority, o_orderstatus, CASE WHEN NOT (o_orderpriority = '1-URGENT' AND o_orderkey % 100 = 0) THEN round(o_totalprice, 2) END AS cost FROM orders)
        SELECT o_orderpriority, count(*) AS runs, round(count(*) FILTER (o_orderstatus = 'F') / count(*)::DOUBLE, 6) AS done_rate, round(avg(cost), 2) AS mean_cost, CASE WHEN count(cost) = count(*) THEN round(sum(cost), 2) END AS total_cost FROM o GROUP BY o_orderpriority""",
    "forbidden_audit": """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'verdict' ELSE '' END AS forbidden_keys, event_type NOT IN ('click', 'view', 'purchase') AS bad_status FROM events WHERE event_id % 9 = 0 OR event_type NOT IN ('click', 'view', 'purchase')""",
    "page_title": "SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages",
    "page_links": r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>') AS l FROM pages), u AS (SELECT page_id, unnest(l) AS a, generate_subscripts(l, 1) - 1 AS position FROM a)
        SELECT page_id, position::INTEGER AS position, regexp_extract(a, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) AS href FROM u""",
    "page_text": r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g') AS t FROM pages),
        b AS (SELECT page_id, regexp_replace(regexp_replace(t, '(?i)<br\s*/?>|</(p|div|li|tr|h[1-6])\s*>', chr(10), 'g'), '(?s)<[^>]*>', ' ', 'g') AS t FROM a),
        c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS t FROM b),
        d AS (SELECT page_id, trim(regexp_replace(regexp_replace(t, '[ \t\x0B\f\r]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g')) AS t FROM c)
        SELECT page_id, sha256(t) AS text_sha256, length(t)::INTEGER AS n FROM d""",
    "page_paragraphs": r"SELECT page_id, len(p) AS paragraphs FROM (SELECT page_id, regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p\s*>') AS p FROM pages) WHERE len(p) > 0",
    "spatial_contains": POINTS_SQL + " SELECT p_id, s_id FROM pt JOIN sq ON lon >= x AND lon < x + 0.5 AND lat >= y AND lat < y + 0.5",
    "footprint_matches": POINTS_SQL + """, b AS (SELECT s_id, x / 100.0 AS x, y / 100.0 AS y, CASE WHEN s_id % 9 <> 0 THEN (s_id % 500) || ' BAY AVE' END AS s_address FROM sq),
        l AS (SELECT o_orderkey % 2000 AS activity, o_orderkey AS p_id, x + [0.0001, 0.0008, 0.0008, 0.00051, 0.003][o_orderkey % 5 + 1]::DOUBLE AS lon, y + [0.0002, 0.0002, 0.0002, 0.00025, 0.003][o_orderkey % 5 + 1]::DOUBLE AS lat,
          CASE WHEN o_orderkey % 5 IN (1, 4) THEN (s_id % 500) || ' BAY AVE' WHEN o_orderkey % 5 = 2 THEN '1 OTHER ST' END AS address FROM orders JOIN b ON o_custkey = s_id),
        g AS (SELECT *, (x + (x + 0.0005::DOUBLE)) / 2 AS mx, (y + (y + 0.0005::DOUBLE)) / 2 AS my, floor(x / 0.003::DOUBLE) - 1 AS cw, floor((x + 0.0005::DOUBLE) / 0.003::DOUBLE) + 1 AS ce, floor(y / 0.003::DOUBLE) - 1 AS cs, floor((y + 0.0005::DOUBLE) / 0.003::DOUBLE) + 1 AS cn FROM b),
        c AS (SELECT activity, p_id, s_id, lon >= x AND lon < x + 0.0005::DOUBLE AND lat >= y AND lat < y + 0.0005::DOUBLE AS inside, coalesce(address = s_address, false) AS same, pow(sin(radians(my - lat) / 2), 2) + cos(radians(lat)) * cos(radians(my)) * pow(sin(radians(mx - lon) / 2), 2) AS h
          FROM l JOIN g ON floor(lon / 0.003::DOUBLE) BETWEEN cw AND ce AND floor(lat / 0.003::DOUBLE) BETWEEN cs AND cn),
        d AS (SELECT *, 6371000.0 * 2 * atan2(sqrt(h), sqrt(greatest(0, 1 - h))) AS m FROM c),
        w AS (SELECT *, bool_or(inside) OVER q AS any_inside, bool_or(same) OVER q AS any_same, row_number() OVER (PARTITION BY p_id ORDER BY m, s_id) AS place FROM d WINDOW q AS (PARTITION BY p_id)),
        k AS (SELECT *, CASE WHEN any_inside THEN CASE WHEN inside THEN 'containing' END WHEN any_same THEN CASE WHEN same AND m <= 150 THEN 'same_address' END WHEN place = 1 AND m <= 35 THEN 'nearest' END AS method FROM w)
        SELECT activity, s_id, p_id, method, CASE WHEN method = 'nearest' THEN 'medium' ELSE 'high' END AS confidence, round(CASE WHEN method = 'containing' THEN 0 ELSE round(m, 2) END, 1) AS distance_m
        FROM k WHERE method IS NOT NULL QUALIFY row_number() OVER (PARTITION BY activity, s_id ORDER BY p_id) = 1""",
    "spatial_nearest": POINTS_SQL + """, d AS (SELECT p_id, s_id, 6371000.0 * 2 * atan2(sqrt(a), sqrt(greatest(0, 1 - a))) AS m FROM (SELECT p_id, s_id, pow(sin(radians(y - lat) / 2), 2) + cos(radians(lat)) * cos(radians(y)) * pow(sin(radians(x - lon) / 2), 2) AS a FROM pt, sq))
        SELECT p_id, arg_min(s_id, (m, s_id)) AS s_id, round(round(min(m), 3), 1) AS distance_m FROM d WHERE m <= 30000 GROUP BY p_id""",
    "geometry_functions": POINTS_SQL + " SELECT s_id, round(round(x + 0.2, 7), 6) AS lon, round(round(y + 0.2, 7), 6) AS lat, round(x, 6) AS west, round(y + 0.5, 6) AS north FROM sq",
    "address_normalize": r"""SELECT c_custkey, c_custkey || ' N ' || trim(regexp_replace(upper(c_name), '[^A-Z0-9]+', ' ', 'g')) || CASE WHEN c_custkey % 2 = 0 THEN ' ST' ELSE ' BLVD' END AS address, regexp_replace(upper(c_name), '[^A-Z0-9]', '', 'g') AS token, '33602' AS postal_code FROM customer""",
    "parse_dates": """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 4 AND year(o_orderdate) >= 1993 THEN o_orderdate::DATE END AS d FROM orders), y AS (SELECT *, 1994 + floor((year(d) - 1994) / 3.0)::INTEGER * 3 AS s FROM d)
        SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day, CASE WHEN d IS NULL THEN 'unknown' WHEN year(d) < 1994 THEN 'before_1994' ELSE s || '_' || (s + 2) END AS bucket FROM y""",
    "parse_money": "SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_custkey % 10 <> 0 THEN round(c_acctbal, 2) END AS amount FROM customer",
    "stable_ids": """SELECT o_orderkey, 'src-' || left(sha1('orders|' || o_orderkey), 16) AS src_id, CASE WHEN o_orderkey % 4 <> 0 THEN sha256('parts|' || o_custkey || '|' || o_orderstatus) ELSE sha256('number|ORD' || o_orderkey) END AS record_id,
        sha256('42|s|p|' || o_orderstatus || '|' || o_orderkey) AS rank_token FROM orders""",
}
