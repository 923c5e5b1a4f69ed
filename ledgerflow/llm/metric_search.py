"""Exact top-k search by inner product in a forest of M-trees.

Inner product is no metric, so every vector x of a shard gets one more coordinate,
sqrt(M - |x|^2) with M the largest squared length there, and a query a zero; then
d(q, x)^2 = |q|^2 + M - 2 q.x, and the nearest vectors are those with the largest product.

The rows are dealt into regions by the nearest of up to ``MOST_PIVOTS`` rows (those of least hash), and
a region by a hash into shards of about ``SHARD_ROWS``. Each shard becomes one M-tree, stored as a
table of pages: an inner page holds the routing objects of its children
with their covering radii and their distances to the page's own routing object; a leaf page
holds vectors with their distances to its routing object. The search visits pages best first by
the largest product they can hold, each once for all queries of a block that it can hold something for. A stored parent distance bounds the distance to an entry from
both sides by the triangle inequality, so most entries are ruled out without computing it. What
is left is scored exactly, on integers.

The regions are searched best first, too. A query is first held against one shard of its own
region; the k-th score it finds there rules out, by the regions' pivots and radii, all those that
cannot hold a better one. Only then it visits the others, and takes that score along.

Queries of a region are dealt into blocks of ``BLOCK_QUERIES``; a task holds one tree and one block,
whatever the number of rows and queries. The pivots, with a radius and a length per region, are what
is broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.shared import small_batches, written

SHARD_ROWS, BLOCK_QUERIES = 8192, 2048
MOST_PIVOTS = 256
PAGE, FANOUT = 128, 16
SCALE = 256

_PAGE = pa.schema(
    [
        ("dim", pa.int32()),
        ("shard", pa.int32()),
        ("page", pa.int32()),
        ("leaf", pa.bool_()),
        ("top", pa.float64()),
        ("entry", pa.list_(pa.int64())),  # leaf: ids of vectors; inner: numbers of child pages
        ("vectors", pa.list_(pa.float64())),  # row by row, without the lifted coordinate
        ("norms", pa.list_(pa.float64())),
        ("radius", pa.list_(pa.float64())),
        ("parent", pa.list_(pa.float64())),
    ]
)
_PAGE_SQL = "dim int, shard int, page int, leaf boolean, top double, entry array<long>, vectors array<double>, norms array<double>, radius array<double>, parent array<double>"
_HIT = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component, as doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))


def takes_part(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


@dataclass
class Regions:
    """Of one dimension: the pivots, and how far from it and how long the rows of each may be."""

    pivots: np.ndarray
    radius: np.ndarray
    length: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(region, distance to its pivot, length) of some vectors."""
        square = (vectors * vectors).sum(axis=1)
        far = square[:, None] + (self.pivots * self.pivots).sum(axis=1) - 2.0 * (vectors @ self.pivots.T)
        region = far.argmin(axis=1)
        return region, np.sqrt(np.maximum(far[np.arange(len(region)), region], 0.0)), np.sqrt(square)

    def most(self, queries: np.ndarray) -> np.ndarray:
        """The largest product that each query can have with a row of each region."""
        size = np.sqrt((queries * queries).sum(axis=1))[:, None]
        bound = np.minimum(queries @ self.pivots.T + size * self.radius, size * self.length)
        return bound + 1e-9 * (1.0 + size * (self.length + self.radius)) + 1e-6


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, vectors) of a batch."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield int(dim), rows, _matrix(batch.column("vector").take(pa.array(rows)), int(dim))


def _assign(batches: Iterator[pa.RecordBatch], regions: dict[int, Regions]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        region, far, length = np.zeros(n, np.int32), np.zeros(n), np.zeros(n)
        for dim, rows, vectors in _by_dim(batch):
            region[rows], far[rows], length[rows] = regions[dim].nearest(vectors)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region), pa.array(far), pa.array(length)], names=[*batch.schema.names, "region", "far", "length"])


def _wanted(batches: Iterator[pa.RecordBatch], regions: dict[int, Regions]) -> Iterator[pa.RecordBatch]:
    """Queries with the regions that may hold a score of at least their floor."""
    for batch in batches:
        floor = batch.column("floor").to_numpy(zero_copy_only=False)
        lists: list[np.ndarray] = [np.zeros(0, np.int32)] * batch.num_rows
        for dim, rows, vectors in _by_dim(batch):
            some = regions[dim].most(vectors) >= floor[rows][:, None]
            for i, mine in zip(rows.tolist(), some, strict=True):
                lists[i] = np.flatnonzero(mine).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*batch.schema.names, "wanted"])


def _distance(vectors: np.ndarray, norms: np.ndarray, at: int, top: float) -> np.ndarray:
    """Lifted distances of some vectors to the one numbered at."""
    lift = np.sqrt(np.maximum(top - norms, 0.0))
    square = norms + norms[at] - 2.0 * (vectors @ vectors[at]) + (lift - lift[at]) ** 2
    return np.sqrt(np.maximum(square, 0.0))


def build_pages(ids: np.ndarray, vectors: np.ndarray) -> list[dict]:
    """The pages of the M-tree over some vectors; page 0 is the root, whose router is its first object."""
    norms = (vectors * vectors).sum(axis=1)
    top = float(norms.max(initial=0.0))
    order = np.lexsort((ids,))
    ids, vectors, norms = ids[order], vectors[order], norms[order]
    pages: list[dict] = []

    def add(members: np.ndarray, router: int, distance: np.ndarray) -> tuple[int, float]:
        """Store the subtree of some members; their distances to its router are given."""
        number = len(pages)
        pages.append({})
        if len(members) <= PAGE or not distance.any():  # equal vectors cannot be split
            pages[number] = {"leaf": True, "top": top, "entry": ids[members], "vectors": vectors[members].ravel(), "norms": norms[members], "radius": np.zeros(len(members)), "parent": distance}
            return number, float(distance.max(initial=0.0))
        seeds = members[np.linspace(0, len(members) - 1, FANOUT).astype(int)]
        every = np.stack([_distance(vectors[np.append(members, s)], norms[np.append(members, s)], len(members), top)[:-1] for s in seeds])
        nearest = every.argmin(axis=0)
        if (nearest == nearest[0]).all():  # the seeds do not tell the members apart: halve by distance to the first
            nearest = (np.argsort(np.argsort(every[0], kind="stable")) >= len(members) // 2).astype(int)
        children = []
        for k in np.unique(nearest):
            mine = nearest == k
            child, radius = add(members[mine], int(seeds[k]), every[k][mine])
            to_router = _distance(vectors[[router, seeds[k]]], norms[[router, seeds[k]]], 0, top)[1]
            children.append((child, int(seeds[k]), radius, to_router))
        who = np.array([c[1] for c in children])
        pages[number] = {"leaf": False, "top": top, "entry": np.array([c[0] for c in children]), "vectors": vectors[who].ravel(), "norms": norms[who], "radius": np.array([c[2] for c in children]), "parent": np.array([c[3] for c in children])}
        return number, float(distance.max(initial=0.0))

    everyone = np.arange(len(ids))
    add(everyone, 0, _distance(vectors, norms, 0, top))
    pages[0]["router"] = vectors[0]
    return pages


def search(pages: dict[int, dict], root_router: np.ndarray, query: np.ndarray, own: int, k: int, least: float = -np.inf) -> tuple[list[tuple[int, int]], int]:
    """((score, id) of the k best vectors of a tree that score ``least`` or more, best first; how many products were computed)."""
    scores, ids, computed = search_all(pages, root_router, query[None, :], np.array([own]), k, np.array([least], np.float64))
    return [(int(s), int(i)) for s, i in zip(scores[0], ids[0], strict=True) if np.isfinite(s)], computed


def search_all(pages: dict[int, dict], root_router: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The same for many queries in one walk: (scores, best first and -inf where there are fewer; ids; products).

    A page is visited once, with all queries that it can still hold something for, in the order of the best
    that it can hold for any of them.
    """
    top = pages[0]["top"]
    whole = (queries * queries).sum(axis=1) + top
    slack = 1e-9 * (whole + 1.0) + 1e-6
    scores, ids = np.full((len(queries), k), -np.inf), np.full((len(queries), k), np.iinfo(np.int64).max)
    floor = np.array(least, np.float64)
    computed = len(queries)
    to_root = np.sqrt(np.maximum(whole - 2.0 * (queries @ root_router), 0.0))
    todo = [(-np.inf, 0, 0, np.arange(len(queries)), np.full(len(queries), np.inf), to_root)]
    pushed = 0  # tells entries of equal bounds apart
    while todo:
        _, _, number, who, bound, to_router = heapq.heappop(todo)
        live = bound + slack[who] >= floor[who]
        who, to_router = who[live], to_router[live]
        page = pages[number]
        # what the stored distances allow: d(q, entry) >= |d(q, router) - d(router, entry)| - radius
        near = np.maximum(np.abs(to_router[:, None] - page["parent"]) - page["radius"], 0.0)
        may = (whole[who, None] - near * near) / 2.0 + slack[who, None] >= floor[who, None]
        rows, at = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
        if not len(rows):
            continue
        who, may = who[rows], may[np.ix_(rows, at)]
        products = queries[who] @ page["vectors"][at].T
        computed += products.size
        if page["leaf"]:
            some = page["entry"][at]
            products = np.where((products >= floor[who, None]) & (some != own[who, None]), products, -np.inf)
            better = np.flatnonzero((products > -np.inf).any(axis=1))
            if len(better):
                who = who[better]
                found = np.concatenate([scores[who], products[better]], axis=1)
                names = np.concatenate([ids[who], np.broadcast_to(some, (len(who), len(some)))], axis=1)
                best = np.lexsort((names, -found), axis=1)[:, :k]
                scores[who], ids[who] = np.take_along_axis(found, best, axis=1), np.take_along_axis(names, best, axis=1)
                floor[who] = np.maximum(floor[who], scores[who, -1])
            continue
        distance = np.sqrt(np.maximum(whole[who, None] - 2.0 * products, 0.0))
        near = np.maximum(distance - page["radius"][at], 0.0)
        most = (whole[who, None] - near * near) / 2.0
        may &= most + slack[who, None] >= floor[who, None]
        for j, child in enumerate(page["entry"][at].tolist()):
            mine = np.flatnonzero(may[:, j])
            if len(mine):
                pushed += 1
                heapq.heappush(todo, (-float(most[mine, j].max()), pushed, child, who[mine], most[mine, j], distance[mine, j]))
    return scores, ids, computed


def _build(table: pa.Table) -> pa.Table:
    dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
    pages = build_pages(table["vec_id"].to_numpy(), _matrix(table["vector"], dim))
    root = pages[0].pop("router")
    columns = {n: [p[n] for p in pages] for n in ("leaf", "top", "entry", "vectors", "norms", "radius", "parent")}
    # the root's routing object stands in a page of its own, numbered -1
    columns["leaf"].append(True)
    columns["top"].append(pages[0]["top"])
    for name in ("entry", "norms", "radius", "parent"):
        columns[name].append([])
    columns["vectors"].append(root)
    n = len(pages)
    return pa.table({"dim": [dim] * (n + 1), "shard": [shard] * (n + 1), "page": [*range(n), -1]} | columns, schema=_PAGE)


def _search(k: int, trees: pa.Table, queries: pa.Table) -> pa.Table:
    if not trees.num_rows or not queries.num_rows:
        return _HIT.empty_table()
    dim = trees["dim"][0].as_py()
    pages, root = {}, None
    for p in trees.select(["page", "leaf", "top"]).to_pylist():
        pages[p["page"]] = p
    for name in ("entry", "vectors", "norms", "radius", "parent"):
        for number, values in zip(trees["page"].to_pylist(), trees[name], strict=True):
            pages[number][name] = values.values.to_numpy(zero_copy_only=False)
    root = pages.pop(-1)["vectors"]
    for p in pages.values():
        p["vectors"] = p["vectors"].reshape(-1, dim)
    who, key = queries["vec_id"].to_numpy(), queries["query_key"].to_numpy()
    scores, ids, _ = search_all(pages, root, _matrix(queries["vector"], dim), who, k, queries["floor"].to_numpy())
    q, at = np.nonzero(np.isfinite(scores))
    return pa.table([pa.array(c, pa.int64()) for c in (who[q], key[q], ids[q, at], scores[q, at].astype(np.int64))], schema=_HIT)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every query row.

    All rows are candidates of all queries of their dimension, but for rows with the query's
    own id. Equal scores go to the smaller id; a query with fewer candidates gets all of them.
    Null ids, and vectors that are null, empty or hold null or non-finite components, take no
    part. Query rows that repeat both id and vector are asked once; those that repeat only the
    id are asked each. Scores are exact as long as they are below 2**53. Other columns play no
    part. An empty table, or one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.where(takes_part(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked")
    )
    rows = rows.select(F.size("vector").alias("dim"), "vec_id", "vector", "asked", F.xxhash64("vec_id", "vector").alias("query_key"))
    regions = {r["dim"]: _pivots(rows, r["dim"], r["n"]) for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not regions:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dealt = rows.mapInArrow(lambda it: _assign(it, regions), "dim int, vec_id long, vector array<double>, asked boolean, query_key long, region int, far double, length double")
    dealt = written(dealt)
    plan = F.broadcast(_plan(dealt, regions))  # a row per region
    shards = dealt.join(plan, ["dim", "region"]).withColumn("shard", F.col("first") + F.pmod("query_key", F.col("parts")).cast("int"))
    trees = written(shards.select("dim", "shard", "vec_id", "vector").groupBy("dim", "shard").applyInArrow(_build, _PAGE_SQL))
    asked = dealt.where("asked").select("dim", "region", "vec_id", "vector", "query_key").dropDuplicates(["dim", "vec_id", "query_key"]).join(plan, ["dim", "region"])
    asked = asked.withColumn("block", F.col("first_block") + F.pmod(F.xxhash64("query_key"), F.col("block_parts")).cast("int"))
    asked = written(asked.select("dim", "vec_id", "vector", "query_key", "block", F.col("first").alias("home")))

    near = _visit(trees, asked.withColumn("shard", F.col("home")).withColumn("floor", F.lit(float("-inf"))), k)
    near = written(near)
    full = near.groupBy(F.col("query_id").alias("vec_id"), "query_key").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    floor = F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf")))
    floors = full.select("vec_id", "query_key", floor.alias("floor"))
    going = asked.join(floors, ["vec_id", "query_key"], "left").select("dim", "vec_id", "vector", "query_key", "block", "home", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    kind = "dim int, vec_id long, vector array<double>, query_key long, block int, home int, floor double, wanted array<int>"
    going = going.mapInArrow(lambda it: _wanted(it, regions), kind).withColumn("region", F.explode("wanted")).join(plan, ["dim", "region"])
    going = going.withColumn("shard", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1))).where("shard <> home")
    hits = near.unionByName(_visit(trees, going, k))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _pivots(rows: DataFrame, dim: int, n: int) -> Regions:
    """The rows of least hash as pivots, radii still open. MOST_PIVOTS vectors at most reach the driver."""
    number = min(MOST_PIVOTS, max(1, -(-n // SHARD_ROWS)))
    some = rows.where(F.col("dim") == dim).orderBy("query_key", "vec_id").limit(number).select("vector").collect()
    pivots = np.unique(np.array([r["vector"] for r in some], np.float64), axis=0)
    return Regions(pivots, np.zeros(len(pivots)), np.zeros(len(pivots)))


def _plan(dealt: DataFrame, regions: dict[int, Regions]) -> DataFrame:
    """dim, region, first, parts, first_block and block_parts: the numbers of its shards and blocks. Sets the regions' radii."""
    counted = dealt.groupBy("dim", "region").agg(F.count("*").alias("n"), F.count_if("asked").alias("asked"), F.max("far").alias("far"), F.max("length").alias("length"))
    out, shard, block = [], 0, 0
    for r in sorted(counted.collect(), key=lambda r: (r["dim"], r["region"])):
        regions[r["dim"]].radius[r["region"]], regions[r["dim"]].length[r["region"]] = r["far"], r["length"]
        parts, blocks = -(-r["n"] // SHARD_ROWS), max(1, -(-r["asked"] // BLOCK_QUERIES))
        out.append((r["dim"], r["region"], shard, parts, block, blocks))
        shard, block = shard + parts, block + blocks
    return dealt.sparkSession.createDataFrame(out, "dim int, region int, first int, parts int, first_block int, block_parts int")


def _visit(trees: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best rows that each query finds in the shard it is sent to; a tree is copied to the blocks that visit it."""
    by = ("dim", "shard", "block")
    queries = queries.select(*by, "vec_id", "vector", "query_key", "floor")
    copies = trees.join(queries.select(*by).distinct(), ["dim", "shard"])
    copies = copies.select(*[F.col(c).alias(c) for c in copies.columns])  # the grouped sides share no column
    found = copies.groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(lambda left, right: _search(k, left, right), "query_id long, query_key long, vec_id long, score long")
    return found
