"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are numbered and dealt into blocks of exactly ``BLOCK_ROWS``. A
source of weight w gets its j-th block (from 0) into a window of slots: it is released at
floor(j / w) and due at ceil((j + 1) / w). Among the released blocks, the one that is due first
takes the next slot. With weights that add up to 1 every block meets its deadline, so after any
number t of slots each source has had less than one block more or less than t * w, and less than
BLOCK_ROWS rows.

Weights are rounded to shares of a period of ``period`` slots. All lags are zero at its end, so
one period, which the number of sources bounds, is scheduled on the driver, and every row works
out its block's slot from it by arithmetic; no list of blocks is made. When a source has no block
left, a new phase begins with the weights of the sources that remain; nothing is dropped.

What passes through the driver and is broadcast: a row per source, one per phase and source, and
the slots of one period per phase. It grows with the square of the number of sources, of which
there may be MOST_SOURCES (a million short rows), and not with the number of rows; sources are
meant to be collections, not hosts.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.shared import written
from ledgerflow.operators.spread import frequent

BLOCK_ROWS = 64
LEAST_PERIOD = 1024
#: Sources of a mix, at most: what the driver schedules grows with their square.
MOST_SOURCES = 1000
#: Rows of one range of hashes of a source, about.
RANGE_ROWS = 4096


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole slots per period, at least one each, that add up to period (largest remainders)."""
    names = sorted(weights)
    total = sum(weights.values())
    spare = period - len(names)
    exact = {n: weights[n] / total * spare for n in names}
    out = {n: 1 + int(exact[n]) for n in names}
    for n in sorted(names, key=lambda n: (int(exact[n]) - exact[n], n))[: period - sum(out.values())]:
        out[n] += 1
    return out


def one_period(share: dict[str, int]) -> dict[str, list[int]]:
    """The slots of the blocks of each source in one period, earliest deadline first."""
    period = sum(share.values())
    waiting = [(0, -(-period // a), n, 0) for n, a in sorted(share.items())]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {n: [] for n in share}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, due, n, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, n, j))
        due, n, j = heapq.heappop(ready)
        assert slot < due
        slots[n].append(slot)
        if j + 1 < share[n]:
            heapq.heappush(waiting, ((j + 1) * period // share[n], -(-(j + 2) * period // share[n]), n, j + 1))
    return slots


@dataclass
class Phase:
    """Blocks first[n] .. first[n] + blocks[n] of each source, from slot start on."""

    start: int
    share: dict[str, int]
    slots: dict[str, list[int]]
    first: dict[str, int]
    blocks: dict[str, int]


def phases(blocks: dict[str, int], weights: dict[str, float]) -> list[Phase]:
    left = {n: b for n, b in blocks.items() if b > 0}
    done = dict.fromkeys(left, 0)
    start, out = 0, []
    while left:
        period = LEAST_PERIOD
        while period < 4 * len(left):
            period *= 2
        share = shares({n: weights[n] for n in left}, period)
        slots = one_period(share)
        # the phase ends at the first slot that asks for a block which is not there
        end = min(left[n] // share[n] * period + slots[n][left[n] % share[n]] for n in left)
        cycles, rest = divmod(end, period)
        had = {n: cycles * share[n] + sum(s < rest for s in slots[n]) for n in left}
        out.append(Phase(start, share, slots, {n: done[n] for n in left}, had))
        start += end
        done |= {n: done[n] + had[n] for n in left}
        left = {n: left[n] - had[n] for n in left if left[n] > had[n]}
    return out


def tempered(counts: dict[str, int], power: float = 0.5) -> dict[str, float]:
    """Weights in proportion to a power of the sources' sizes: smaller sources count for more."""
    return {n: c**power for n, c in counts.items()}


def _source(source: str) -> Column:
    return F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))


def schedule(docs: DataFrame, source: str = "source", weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(the phases' runs of blocks; the slots of one period of each).

    Weights may be given for some sources; others get the least of those given. Without any,
    they are the square roots of the sources' numbers of rows. Null sources count as the source
    ''; an empty table gives empty ones; more than MOST_SOURCES sources are an error.
    """
    spark = docs.sparkSession
    rows = docs.groupBy(_source(source).alias("s")).agg(F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: mix collections of them")
    counts = {r["s"]: r["n"] for r in rows}
    use = tempered(counts)
    if weights:
        use = {n: weights.get(n, min(weights.values())) for n in counts}
    blocks = {n: -(-c // block_rows) for n, c in counts.items()}
    runs, period = [], []
    for number, p in enumerate(phases(blocks, use)):
        length = sum(p.share.values())
        runs += [(number, n, p.first[n], p.blocks[n], p.start, p.share[n], length) for n in p.share if p.blocks[n]]
        period += [(number, n, i, s) for n in p.share for i, s in enumerate(p.slots[n][: min(p.share[n], p.blocks[n])])]
    return (
        spark.createDataFrame(runs, "phase int, m_source string, first long, blocks long, start long, share long, length long"),
        spark.createDataFrame(period, "phase int, m_source string, i long, at long"),
    )


def _numbered(docs: DataFrame, key: str, source: str) -> DataFrame:
    """docs as a struct column row, with m_source and m_rank, the row's number among its source's rows in the order of hashes.

    Hashes are cut into ranges of about RANGE_ROWS rows of a source. Rows are counted by range first; a row is
    numbered within its range and the rows in earlier ranges are added. So no task sees more than a range, and
    what is carried over is one number for each range.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(row.alias("row"), _source(source).alias("m_source"), F.col(f"`{key}`").alias("m_key"), F.monotonically_increasing_id().alias("m_at"))
    alone = F.col("m_key").isNotNull()
    hot = frequent(docs.select(F.col(f"`{key}`").alias("m_key")), "m_key")
    if hot is not None:
        rows = rows.join(F.broadcast(hot), "m_key", "left")
        alone &= F.col("_parts").isNull()
    rows = rows.withColumn("m_hash", F.when(alone, F.xxhash64("m_key")).otherwise(F.xxhash64("m_key", "m_at")))
    sizes = docs.groupBy(_source(source).alias("m_source")).agg(F.count("*").alias("n"))  # MOST_SOURCES rows, as schedule has seen
    bits = F.greatest(F.ceil(F.log2(F.col("n") / RANGE_ROWS)), F.lit(0)).cast("int")
    rows = rows.join(F.broadcast(sizes.select("m_source", bits.alias("m_bits"))), "m_source")
    # the first bits of the hash, from the smallest (negative) on
    first = F.when(F.col("m_bits") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftright(m_hash, 64 - m_bits)"))
    rows = rows.withColumn("m_range", first)
    earlier = Window.partitionBy("m_source").orderBy("m_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("m_source", "m_range").agg(F.count("*").alias("m_n"))
    carried = counts.select("m_source", "m_range", F.coalesce(F.sum("m_n").over(earlier), F.lit(0)).alias("m_carried"))
    inside = F.row_number().over(Window.partitionBy("m_source", "m_range").orderBy("m_hash", "m_key", "m_at"))
    return rows.withColumn("m_inside", inside).join(carried, ["m_source", "m_range"]).select("row", "m_source", (F.col("m_carried") + F.col("m_inside") - 1).alias("m_rank"))


def _placed(docs: DataFrame, key: str, source: str, weights: dict[str, float] | None, block_rows: int) -> DataFrame:
    """docs as a struct column row, with m_source, m_rank, m_block, slot, release and deadline."""
    runs, slots = schedule(docs, source, weights, block_rows)
    rows = _numbered(docs, key, source).withColumn("m_block", F.expr(f"m_rank div {block_rows}"))
    runs = runs.withColumnRenamed("m_source", "r_source")
    here = (F.col("m_source") == F.col("r_source")) & (F.col("m_block") >= F.col("first")) & (F.col("m_block") < F.col("first") + F.col("blocks"))
    placed = rows.join(F.broadcast(runs), here).withColumn("j", F.col("m_block") - F.col("first")).withColumn("i", F.col("j") % F.col("share"))
    placed = placed.join(F.broadcast(slots), ["phase", "m_source", "i"])
    base = F.col("start") + F.expr("j div share") * F.col("length")
    return placed.select(
        "row",
        "m_source",
        "m_rank",
        "m_block",
        (base + F.col("at")).alias("slot"),
        (base + F.expr("i * length div share")).alias("release"),
        (base + F.expr("((i + 1) * length + share - 1) div share")).alias("deadline"),
    )


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """key, source, block, slot, release, deadline and rank (in its source, from 0) of every row of docs.

    Null sources count as the source ''. Rows of a source are numbered in the order of their keys' hashes; those
    without a key, or with one that very many rows share, by their place in the table. Slots are whole
    numbers from 0, one block of exactly ``block_rows`` rows each, but for the last of a source. Other columns
    play no part; an empty table gives an empty result; more than MOST_SOURCES sources are an error.
    """
    out = _placed(docs.select(*dict.fromkeys((f"`{key}`", f"`{source}`"))), key, source, weights, block_rows)
    return out.select(F.col("row.c0").alias(key), F.col("m_source").alias("source"), F.col("m_block").alias("block"), "slot", "release", "deadline", F.col("m_rank").alias("rank"))


def in_mixed_order(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows of docs in the order of the mix (by slot, then by their number in the source); columns as they are."""
    out = _placed(docs, key, source, weights, block_rows).orderBy("slot", "m_rank")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def with_positions(docs: DataFrame, position: str = "position") -> DataFrame:
    """All rows of docs with their place (from 0) in the order in which their files were written.

    For tables that in_mixed_order has made: written files keep its order, file by file. What is no table
    of files is written first. A row for each file is counted and carried over.
    """
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    file = {"m_part": number, "m_path": F.xxhash64("_metadata.file_path"), "m_index": F.col("_metadata.row_index")}
    try:
        rows = docs.select("*", *[c.alias(name) for name, c in file.items()])
    except AnalysisException as e:
        if "_metadata" not in str(e):
            raise
        return with_positions(written(docs), position)
    own = ["m_part", "m_path"]
    files = rows.groupBy(*own).agg(F.count("*").alias("m_n"))
    before = Window.orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(*own, F.coalesce(F.sum("m_n").over(before), F.lit(0)).alias("m_before"))
    placed = rows.join(F.broadcast(files), own)  # three numbers for each file
    return placed.withColumn(position, F.col("m_before") + F.col("m_index")).drop(*own, "m_index", "m_before")
