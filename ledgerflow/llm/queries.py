"""The registered queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import bpe_codec, conversation_trie, exact_dedup, jaccard_join, language_id, license_scan, metric_search, periodic_runs, piece_codec, quality_sampling, secret_scan, source_mixing, suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def sha256_text(value: Column) -> Column:
    return F.sha2(F.encode(value, "utf-8"), 256)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op3_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_RULES))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secret_scan.BASE_RULES],
        sha256_text(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op5_quality_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_sampling.quality_sample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def token_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: encode, decode, and digest both."""
    both = piece_codec.round_trip(docs, model_file)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_text(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256_text(F.col("text")).alias("decoded_sha256"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(documents(spark, sf_dir), digest=True).withColumnRenamed("content_sha256", "text_sha256")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(documents(spark, sf_dir))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(documents(spark, sf_dir))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe_codec.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return both.select(
        "doc_id",
        (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        sha256_text(F.col("text")).alias("decoded_sha256"),
    )


def repeating_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of about a tenth of the documents repeat from some word on.

    With h = crc32(doc_id), g = floor(h / 10) and n words: if h % 10 = 0, the p words from word
    a = g % n on follow each other again and again to the end, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 0)).alias("w"))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    cut = words.withColumn("a", F.when(n > 0, g % n).cast("int")).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    m = n - F.col("a")
    times = F.ceil(m / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)), 1, m)
    text = F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.slice("w", 1, F.col("a")), tail), " ")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(repeating_tails(documents(spark, sf_dir)))
    # by start and period, so that the first of equal exponents stays
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(more(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        sha256_text(F.array_join(lines, "")).alias("runs_sha256"),
        sha256_text(F.col("collapsed")).alias("collapsed_sha256"),
    )


def forked(keys: DataFrame) -> DataFrame:
    """Every conversation c rebuilt: the first crc32(c) % 9 turns of conversation c - c % 5, then its own behind so many."""
    cut = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int") * conversation_trie.WIDTH
    family = keys.select("conv_id", "key", (F.col("conv_id") - F.col("conv_id") % 5).alias("leader"), cut.alias("cut"))
    led = F.max(F.when(F.col("conv_id") == F.col("leader"), F.substr("key", F.lit(1), F.lit(8 * conversation_trie.WIDTH)))).over(Window.partitionBy("leader"))
    head = F.substr(F.coalesce(led, F.lit(b"")), F.lit(1), F.col("cut"))
    return family.select("conv_id", F.concat(head, F.substr("key", F.col("cut") + 1)).alias("key"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = conversation_trie.turn_keys(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_trie.prefix_trie(forked(keys)).drop("turn_id")


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_metric_search": op3_metric_search,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality_sampling": op5_quality_sampling,
    "op6_piece_codec": op6_piece_codec,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_source_mixing": op10_source_mixing,
    "op11_bpe_codec": op11_bpe_codec,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_trie": op13_conversation_trie,
}

def _license_sql() -> str:
    """Diagonal voting over words as a query: the same templates, all else by itself."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"
    rows = [(i, label, i < len(license_scan.PHRASES), size, text) for i, (text, label, size) in enumerate(license_scan.template_list())]
    templates = ", ".join(f"({i}, '{label}', {base}, {size}, {quoted(text)})" for i, label, base, size, text in rows)
    listed = lambda where: f"coalesce(string_agg(DISTINCT label, ',' ORDER BY label){where}, '')"
    return rf"""
        WITH t AS (SELECT * FROM (VALUES {templates}) v(template, label, base, size, words)),
        tp AS (SELECT template, size, i - 1 AS p, array_to_string(words[i:i + size - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM t)),
        d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        g AS (SELECT doc_id, size, i - 1 AS p, array_to_string(w[i:i + size - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM d, (VALUES (2), (4)) z(size))),
        m AS (SELECT doc_id, template, g.p - tp.p AS diagonal, tp.p AS p FROM g JOIN tp ON g.size = tp.size AND g.gram = tp.gram),
        f AS (SELECT *, CASE WHEN NOT base AND diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {license_scan.NEIGHBOUR} THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT doc_id, template, diagonal FROM m) JOIN t USING (template)),
        c AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM f),
        s AS (SELECT doc_id, label, base, min(diagonal) AS first, count(DISTINCT p) / (any_value(len(words) - size) + 1)::DOUBLE AS coverage FROM c JOIN m USING (doc_id, template, diagonal) GROUP BY doc_id, template, span, label, base),
        k AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word, {listed(" FILTER (base)")} AS base_labels, {listed("")} AS labels, max(coverage) AS score
          FROM s WHERE CASE WHEN base THEN coverage = 1 ELSE coverage >= {license_scan.COVERAGE} END GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN k USING (doc_id)"""


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII string, bit by bit."""
    one = "list_reduce(list_prepend(xor(c, b), [0::BIGINT for _ in range(8)]), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"[ascii(x)::BIGINT for x in string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {one}), 4294967295)"


_RUNS_SQL = rf"""
        WITH d AS (SELECT doc_id, {_crc32_sql("doc_id::VARCHAR")} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        o AS (SELECT doc_id, i - 1 AS i, w[i] AS word, h, len(w) AS n, CASE WHEN h % 10 = 0 THEN (h // 10) % len(w) END AS a FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d)),
        t AS (SELECT doc_id, i, coalesce(CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END, i) AS j, n FROM o),
        x AS MATERIALIZED (SELECT t.doc_id, t.i, word, t.n FROM t JOIN o ON t.doc_id = o.doc_id AND t.j = o.i),
        m AS (SELECT y.doc_id, y.i, y.i - x.i AS q FROM x JOIN x y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        s AS (SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m) GROUP BY doc_id, q, island),
        r AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
        k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM x WHERE NOT EXISTS (FROM r WHERE r.doc_id = x.doc_id AND x.i >= start + period AND x.i < start + length) GROUP BY doc_id),
        a AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
        b AS (SELECT r.* FROM r ANTI JOIN r z ON r.doc_id = z.doc_id AND (z.length * r.period > r.length * z.period OR z.length * r.period = r.length * z.period AND (z.start, z.period) < (r.start, r.period)))
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
        FROM d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)"""


_TRIE_SQL = f"""
        WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS k, md5(concat(octet_length(encode(coalesce(role, ''))), ':', role, text)) AS id, octet_length(encode(coalesce(text, ''))) AS size FROM conversations),
        c AS (SELECT conv_id, conv_id - conv_id % 5 AS leader, {_crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM conversations)),
        r AS (SELECT c.conv_id, k, id, size FROM c JOIN t ON t.conv_id = leader AND k < h UNION ALL SELECT conv_id, k, id, size FROM c JOIN t USING (conv_id) WHERE k >= h),
        s AS MATERIALIZED (SELECT conv_id, coalesce(list(id ORDER BY k) FILTER (id IS NOT NULL), []) AS ids, list(size ORDER BY k) AS sizes FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
        m AS (SELECT conv_id, d, ids[1:d] AS path, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(ids) AS ends FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM s)),
        n AS MATERIALIZED (SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY path),
        k AS MATERIALIZED (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
        u AS (SELECT n.path, unnest(range(0, depth + 1)) AS up, (n_convs - 1) * size AS saved, n_children IS NULL AS leaf FROM n LEFT JOIN k USING (path)),
        a AS (SELECT path[1:up] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM u GROUP BY 1)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM n JOIN a USING (path) LEFT JOIN k USING (path) LEFT JOIN n p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]"""


#: Rounds in which labels spread along links; near copies of one text lie a few links apart.
_ROUNDS = 12

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": _license_sql(),
    "op3_metric_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op12_periodic_runs": _RUNS_SQL,
    "op13_conversation_trie": _TRIE_SQL,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
              FROM documents)
        WINDOW w AS (PARTITION BY t)""",
    "op7_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        w AS (SELECT doc_id, s, b[s + 1:s + 100] AS w FROM (SELECT doc_id, b, unnest(range(0, n - 99)) AS s FROM d WHERE n >= 100)),
        r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
        i AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh FROM r)),
        g AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS e FROM i GROUP BY doc_id, island),
        p AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM g UNION ALL SELECT doc_id, max(e), NULL FROM g GROUP BY doc_id),
        k AS (SELECT p.doc_id, sha256(unhex(string_agg(hex(b[x + 1:coalesce(y, n)]), '' ORDER BY x))) AS kept FROM p JOIN d USING (doc_id) GROUP BY p.doc_id),
        t AS (SELECT doc_id, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans FROM g GROUP BY doc_id)
        SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept, sha256(b)) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op9_jaccard_join": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
        e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n, y.n AS m, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id AND 4 * least(x.n, y.n) >= 3 * greatest(x.n, y.n) GROUP BY ALL),
        l AS MATERIALIZED (SELECT a, b FROM p WHERE 100 * c >= 75 * (n + m - c) UNION ALL SELECT doc_id, doc_id FROM s),
        c0 AS MATERIALIZED (SELECT doc_id AS a, doc_id AS c FROM s), """
    + ", ".join(f"c{k} AS MATERIALIZED (SELECT l.a, min(c) AS c FROM l JOIN c{k - 1} x ON l.b = x.a GROUP BY l.a)" for k in range(1, _ROUNDS + 1))
    + f" SELECT doc_id, len(s) AS n_shingles, c AS component_id FROM s JOIN c{_ROUNDS} ON doc_id = a",
}
