"""Spatial joins on cells: containment, nearest neighbour, footprints."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.geo import cell, in_ring
from ledgerflow.functions.numbers import haversine_m
from ledgerflow.operators.spread import MOST, PART_ROWS, deal, frequent, spread_join
from ledgerflow.sources.workspace import cut


def _sub(value: Column, step: float, level: Column) -> Column:
    """The number of the cell of a level that a value lies in; cells halve from level to level."""
    return F.floor(value * F.pow(F.lit(2.0), level) / step)


def _touched(west: Column, east: Column, step: float, level: Column) -> Column:
    return F.sequence(_sub(west, step, level), _sub(east, step, level))


def meet(points: DataFrame, regions: DataFrame, step: float, depth: int = 16) -> DataFrame:
    """Pairs of points (p_id, lon, lat) and regions (s_id, west, south, east, north) whose boxes touch the point's cell.

    Cells form a quadtree: one that holds more than a fixed share of all points is split in four, down to
    ``depth`` levels, and regions follow into those parts that they touch. Points piled up in one place, which
    no cell parts, are dealt over several tasks. At most as many cells of a level are split as ``spread.frequent``
    allows, and only these pass through the driver. Boxes are closed; callers add the exact test. Rows with
    a null coordinate meet nothing.
    """
    at, tiles = _parted(points, regions, step, depth)
    hot = frequent(at, *CELL)
    if hot is None:  # few points in each cell: a task keeps its points, and the regions stream past them unsorted
        return at.hint("shuffle_hash").join(tiles, CELL).drop(*CELL)
    return spread_join(at, tiles, CELL, [F.col("p_id")], hot=hot).drop(*CELL)


#: The key of a cell of the quadtree, and the sides of a box.
CELL, SIDES = ["level", "cx", "cy"], ["west", "south", "east", "north"]


def _parted(points: DataFrame, regions: DataFrame, step: float, depth: int = 16) -> tuple[DataFrame, DataFrame]:
    """Points and regions with the cells in which they meet: a point has one cell, a region all that it touches."""
    zero = F.lit(0)
    at = points.where("lon is not null and lat is not null").withColumns({"level": zero, "cx": _sub(F.col("lon"), step, zero), "cy": _sub(F.col("lat"), step, zero)})
    tiles = regions.withColumn("level", zero).withColumn("cx", F.explode(_touched(F.col("west"), F.col("east"), step, zero))).withColumn("cy", F.explode(_touched(F.col("south"), F.col("north"), step, zero)))
    done_at, done_tiles = [], []
    for level in range(depth):
        counts = _cells(at, CELL)
        full = frequent(at, *CELL, counts=counts)
        split = full.join(counts.where("apart"), CELL).select(*CELL).collect() if full is not None else []  # no more rows than full has
        if not split:
            break
        small = F.broadcast(at.sparkSession.createDataFrame(split, at.select(*CELL).schema))
        done_at.append(at.join(small, CELL, "left_anti"))
        done_tiles.append(tiles.join(small, CELL, "left_anti"))
        below = F.lit(level + 1)
        part = lambda c, west, east: F.filter(F.array(2 * F.col(c), 2 * F.col(c) + 1), lambda x: (x >= _sub(F.col(west), step, F.lit(level + 1))) & (x <= _sub(F.col(east), step, F.lit(level + 1))))  # noqa: B023, E731
        # only what goes on is written, so that each level reads the level before
        at = cut(at.join(small, CELL).withColumns({"level": below, "cx": _sub(F.col("lon"), step, below), "cy": _sub(F.col("lat"), step, below)}), "cells")
        tiles = tiles.join(small, CELL).withColumn("cx", F.explode(part("cx", "west", "east"))).withColumn("cy", F.explode(part("cy", "south", "north")))
        tiles = cut(tiles.withColumn("level", below), "cells")
    for a, t in zip(done_at, done_tiles, strict=True):
        at, tiles = at.unionByName(a), tiles.unionByName(t)
    return at, tiles


def in_some(points: DataFrame, boxes: DataFrame, step: float) -> DataFrame:
    """The points (p_id, lon, lat) that lie in some box (west, south, east, north), half-open; the search of a point ends at the first."""
    at, tiles = _parted(points, boxes.select(*SIDES), step)
    at, tiles = deal(at, tiles, CELL, [F.col("p_id")], frequent(at, *CELL))
    on = [*CELL, "_part"]
    met = reduce(Column.__and__, [F.col(k) == F.col(f"t_{k}") for k in on]) & _in_box(F.col("lon"), F.col("lat"))
    return at.join(tiles.withColumnsRenamed({k: f"t_{k}" for k in on}), met, "left_semi").select(*points.columns)


def _in_box(lon: Column, lat: Column) -> Column:
    return (lon >= F.col("west")) & (lon < F.col("east")) & (lat >= F.col("south")) & (lat < F.col("north"))


def _cells(at: DataFrame, keys: list[str]) -> DataFrame:
    """Points of each cell, and whether they stand apart."""
    apart = (F.min("lon") != F.max("lon")) | (F.min("lat") != F.max("lat"))
    return at.groupBy(*keys).agg(F.count("*").alias("n"), apart.alias("apart"))


def contains(points: DataFrame, shapes: DataFrame, step: float, ring: str = "ring") -> DataFrame:
    """Pairs of points (p_id, lon, lat) and shapes (s_id, ring) that contain them, without the ring.

    Points and the shapes' boxes meet in the cells of a quadtree; the exact test follows. ``step``, the width of
    the widest cells, should be about a shape's size. A shape that is its own box needs no other test than that of
    the box; its ring is not sent along.
    """
    boxed = _boxed(shapes, ring).withColumn("_box", _is_box(F.col(ring)))
    lon, lat = F.col("lon"), F.col("lat")
    within = lambda pairs: pairs.where((lon >= F.col("west")) & (lat >= F.col("south")) & (lon <= F.col("east")) & (lat <= F.col("north")))
    sides = ("west", "south", "east", "north", "_box")
    out = within(meet(points, boxed.where("_box").drop(ring), step)).where((lon < F.col("east")) & (lat < F.col("north"))).drop(*sides)
    others = boxed.where("not _box")
    if others.isEmpty():
        return out
    return out.unionByName(within(meet(points, others, step)).where(in_ring(lon, lat, F.col(ring))).drop(*sides, ring))


def _is_box(ring: Column) -> Column:
    """Is a closed ring a rectangle along the axes? For such, the even-odd rule is that of half-open intervals."""
    x, y = (lambda i: ring[i][0]), (lambda i: ring[i][1])
    corner = lambda i, a, b: (x(i) == x(a)) & (y(i) == y(b))
    turns = (corner(1, 0, 2) & corner(3, 2, 0)) | (corner(1, 2, 0) & corner(3, 0, 2))
    finite = ~F.exists(ring, lambda p: F.isnan(p[0]) | F.isnan(p[1]))
    return F.when(F.size(ring) == 5, F.coalesce(turns & corner(4, 0, 0) & (x(0) != x(2)) & (y(0) != y(2)) & finite, F.lit(False))).otherwise(False)


def _boxed(shapes: DataFrame, ring: str) -> DataFrame:
    side = lambda f, i: f(F.transform(ring, lambda p: p[i]))
    return shapes.withColumns({"west": side(F.array_min, 0), "east": side(F.array_max, 0), "south": side(F.array_min, 1), "north": side(F.array_max, 1)})


def footprints(places: DataFrame, buildings: DataFrame, step: float, address_m: float = 150.0, nearest_m: float = 35.0, ring: str = "ring") -> DataFrame:
    """The buildings that the places of each activity belong to: activity, s_id, p_id, method, confidence, distance_m.

    places: activity, p_id, lon, lat, address; buildings: s_id, ring, address (both addresses normalised, null if
    unknown). A place's candidates are the buildings whose boxes touch its cell of width ``step`` or one of the
    eight around it. All that contain it are its buildings; if none does, those of its own address within
    ``address_m`` of their boxes' middles; if no candidate has its address, the one nearest by its middle,
    the smaller s_id of equally near ones, within ``nearest_m``. An activity has a building once: by the first of
    its places (smallest p_id).
    """
    boxed = _boxed(buildings.select("s_id", ring, F.col("address").alias("s_address")), ring).withColumn("is_box", _is_box(F.col(ring)))
    boxed = cut(boxed.withColumns({"mid_lon": (F.col("west") + F.col("east")) / 2, "mid_lat": (F.col("south") + F.col("north")) / 2}), "buildings")
    places = cut(places.where("p_id is not null").select("activity", "p_id", "lon", "lat", "address"), "places")
    # a containing building's box holds the place, so it is a candidate anyway; cells are as wide as boxes are
    width = boxed.agg(F.avg(F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south")))).first()[0] or 0.0
    narrow = min(step, max(step / 64, width))
    points = places.select("activity", "p_id", "lon", "lat")
    plain, others = _plain(boxed, ring, narrow)
    held = in_some(points, plain, narrow).select("p_id")
    inside = None if others.isEmpty() else contains(points, others, narrow, ring).select("activity", "s_id", "p_id")
    if inside is not None:
        held = held.unionByName(inside.groupBy("p_id").agg(F.count("*").alias("n")).select("p_id"))
    held = cut(held, "held")
    rest = cut(places.join(held, "p_id", "left_anti"), "places")
    # those of its own address: cells of the address around its buildings, by which a place is told to have some
    own = boxed.where("s_address is not null").withColumnRenamed("s_address", "address").withColumn("cx", F.explode(_around("west", "east", step))).withColumn("cy", F.explode(_around("south", "north", step)))
    at = rest.withColumns({"cx": cell(F.col("lon"), step), "cy": cell(F.col("lat"), step)})
    middle = haversine_m(F.col("lon"), F.col("lat"), F.col("mid_lon"), F.col("mid_lat"))
    of_address = ["address", "cx", "cy"]
    same = at.join(own.select(*of_address, "s_id", "mid_lon", "mid_lat"), of_address).withColumn("m", middle).where(F.col("m") <= address_m)
    # the others: the nearest of the candidates whose middles are near enough
    named = at.join(own.select(*of_address).distinct(), of_address, "left_semi").select("p_id").distinct()
    last = cut(rest.join(named, "p_id", "left_anti").select("activity", "p_id", "lon", "lat"), "places")
    reach_lat = nearest_m / 111_000.0
    reach_lon = F.least(F.lit(reach_lat) / F.greatest(F.cos(F.radians(F.abs("mid_lat") + reach_lat)), F.lit(1e-6)), 2 * step + F.col("east") - F.col("west"))
    around = {"west": F.col("mid_lon") - reach_lon, "east": F.col("mid_lon") + reach_lon, "south": F.col("mid_lat") - reach_lat, "north": F.col("mid_lat") + reach_lat}
    near = boxed.select("s_id", "mid_lon", "mid_lat", *[F.col(c).alias(f"box_{c}") for c in around], *[v.alias(c) for c, v in around.items()])
    met = meet(last, near, min(step, 2 * reach_lat))
    for c, low, high in (("lon", "box_west", "box_east"), ("lat", "box_south", "box_north")):
        met = met.where(cell(F.col(c), step).between(cell(F.col(low), step) - 1, cell(F.col(high), step) + 1))
    met = met.withColumn("m", middle).where(F.col("m") <= nearest_m)
    best = met.groupBy("p_id").agg(F.min(F.struct("m", "s_id")).alias("nearest")).withColumnRenamed("p_id", "p")
    closest = met.join(best, (F.col("p_id") == F.col("p")) & (F.col("nearest.s_id") == F.col("s_id")))
    chosen = same.select("activity", "s_id", "p_id", F.lit("same_address").alias("method"), F.lit("high").alias("confidence"), F.round("m", 2).alias("distance_m")).unionByName(
        closest.select("activity", "s_id", "p_id", F.lit("nearest").alias("method"), F.lit("medium").alias("confidence"), F.round("m", 2).alias("distance_m"))
    )
    by_rest = cut(chosen.groupBy("activity", "s_id").agg(F.min(F.struct("p_id", "method", "confidence", "distance_m")).alias("f")), "chosen")
    # most pairs need no more than their cell; the others are compared over all cells, and with the choices of the rest
    firsts, more = _first_inside(points, plain, by_rest.select("activity", "s_id"), narrow)
    by_inside = (more if inside is None else more.unionByName(inside)).groupBy("activity", "s_id").agg(F.min("p_id").alias("p_inside"))
    theirs = F.struct(F.col("p_inside").alias("p_id"), F.lit("containing").alias("method"), F.lit("high").alias("confidence"), F.lit(0.0).alias("distance_m"))
    # an id is contained or not, so both sides never have the same one
    taken = F.when(F.col("p_inside").isNull() | (F.col("f.p_id") < F.col("p_inside")), F.col("f")).otherwise(theirs)
    keys = ["activity", "s_id"]
    theirs_of = by_inside.select(*[F.col(k).alias(f"i_{k}") for k in keys], "p_inside")
    every = theirs_of.join(by_rest, F.col("i_activity").eqNullSafe(F.col("activity")) & (F.col("i_s_id") == F.col("s_id")), "full_outer")
    out = every.select(*[F.coalesce(k, f"i_{k}").alias(k) for k in keys], taken.alias("f")).select(*keys, "f.*")
    return firsts.withColumnRenamed("p_id", "p_inside").select(*keys, theirs.alias("f")).select(*keys, "f.*").unionByName(out)


def _plain(boxed: DataFrame, ring: str, width: float) -> tuple[DataFrame, DataFrame]:
    """Buildings of one row that are their own boxes (s_id and sides) and are neither far wider than ``width`` nor far off; and all others (s_id, ring)."""
    size = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))
    near = reduce(Column.__and__, [F.abs(c) <= width * FAR for c in SIDES])
    told = boxed.withColumn("_plain", F.coalesce(F.col("is_box") & near & (size <= width * 2.0**WIDEST), F.lit(False)))
    several = boxed.groupBy("s_id").agg(F.count("*").alias("n")).where("n > 1 or s_id is null").select(F.col("s_id").alias("several"))
    if not several.isEmpty():
        told = told.join(several, F.col("s_id").eqNullSafe(F.col("several")), "left").withColumn("_plain", F.col("_plain") & F.col("several").isNull() & F.col("s_id").isNotNull()).drop("several")
    return told.where("_plain").select("s_id", *SIDES), told.where("not _plain").select("s_id", ring)


#: Boxes whose sides are further off than so many widths, or wider than 2 ** WIDEST of them, do not meet in cells of their own size;
#: the cells of small ones are 2 ** -LEAST_LEVEL of it.
FAR, WIDEST, LEAST_LEVEL = 1e9, 20, -4
#: So many points of one activity and cell stand side by side in a row.
ABREAST = 10
#: Points times boxes of the cells that a task gets on average.
TASK_PAIRS = 16_000_000


def _first_inside(points: DataFrame, boxes: DataFrame, marked: DataFrame, width: float) -> tuple[DataFrame, DataFrame]:
    """The points (activity, p_id, lon, lat) first to lie in boxes (s_id, west, south, east, north): two tables of activity, s_id, p_id.

    A box lives in the one cell of about its size that its south-west corner lies in; a point goes to the four cells whose boxes
    may reach it. So all points of an activity that a box can hold stand in one cell, side by side in one row if they are few: then the
    first of them that lies in the box is the activity's, and no pairs are shuffled or grouped. The first table has
    these, each activity and box once. Where more points of an activity share a cell, or ``marked`` (activity, s_id)
    has a pair of the activity and a box of the cell, a pair may come several times: they are in the second table.
    Cells are dealt into tasks by points times boxes; those of very many of both are dealt by activity.
    """
    unit = width * 1.02
    wide = F.lit(unit) * F.pow(F.lit(2.0), F.col("level"))
    home = lambda x, y: F.xxhash64("level", x, y)  # cells that share a hash meet in vain, no more
    size = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))
    homes = boxes.withColumn("level", F.greatest(F.ceil(F.log2(size * 1.01 / unit)).cast("int"), F.lit(LEAST_LEVEL)))
    levels = [r["level"] for r in homes.select("level").distinct().collect()]  # WIDEST - LEAST_LEVEL + 1 at most
    homes = homes.select("s_id", *[F.coalesce(c, F.lit(math.nan)).alias(c) for c in SIDES], home(F.floor(F.col("west") / wide), F.floor(F.col("south") / wide)).alias("home"))
    at = points.where((F.abs("lon") <= width * FAR * 2) & (F.abs("lat") <= width * FAR * 2)).withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    for d in ("dx", "dy"):
        at = at.withColumn(d, F.explode(F.array(F.lit(0), F.lit(1))))
    at = at.select("activity", "p_id", "lon", "lat", home(F.floor(F.col("lon") / wide) - F.col("dx"), F.floor(F.col("lat") / wide) - F.col("dy")).alias("home"))
    # how many meet in a cell: where they are very many, activities are dealt over parts, and the points of an activity that has very many
    work = at.groupBy("home").agg(F.count("*").alias("n")).join(homes.groupBy("home").agg(F.count("*").alias("boxes")), "home")
    work = cut(work.select("home", "n", (F.col("n").cast("double") * F.col("boxes")).alias("pairs")), "homes")
    rows, pairs = work.agg(F.sum("n"), F.sum("pairs")).first()
    most_rows, most_pairs = max(PART_ROWS, (rows or 0) / MOST), max(TASK_PAIRS, (pairs or 0) / MOST)
    tasks = max(points.sparkSession.sparkContext.defaultParallelism, math.ceil((rows or 0) / PART_ROWS), math.ceil((pairs or 0) / most_pairs))
    heavy = work.select("home", F.ceil(F.greatest(F.col("n") / most_rows, F.col("pairs") / most_pairs)).cast("int").alias("_parts")).where("_parts > 1")
    found = heavy.collect()  # 2 * MOST rows at most
    marks = marked.join(homes.select("s_id", "home"), "s_id").select("activity", F.lit(None).cast(at.schema["p_id"].dataType).alias("p_id"), *[F.lit(math.nan).alias(c) for c in ("lon", "lat")], "home")
    at, on, dealt_homes = at.unionByName(marks).withColumn("whole", F.lit(True)), ["home"], homes
    if found:
        hot = points.sparkSession.createDataFrame(found, heavy.schema)
        heaps = at.join(F.broadcast(hot), "home").groupBy("home", "activity").agg(F.count("*").alias("n")).where(F.col("n") > most_rows).select(F.col("home").alias("h"), F.col("activity").alias("a"))
        told = points.sparkSession.createDataFrame(heaps.collect(), heaps.schema)  # MOST rows at most
        at = at.join(F.broadcast(told), (F.col("home") == F.col("h")) & F.col("activity").eqNullSafe(F.col("a")), "left").withColumn("whole", F.col("h").isNull()).drop("h", "a")
        at, dealt_homes = deal(at, homes, on, [F.col("activity"), F.when(~F.col("whole"), F.col("p_id"))], hot)
        on = ["home", "_part"]
    wide = _abreast(at.repartition(tasks, *on), on)
    dealt_homes = dealt_homes.repartition(tasks, *on).hint("shuffle_hash")  # a task keeps its boxes, and the rows stream past them cell by cell
    meet_in = lambda rows: _first_of(rows.join(dealt_homes, on))
    return meet_in(wide.where("alone")), meet_in(wide.where("not alone"))


def _abreast(points: DataFrame, on: list[str]) -> DataFrame:
    """Rows of up to ABREAST points (p_id_0, lon_0, lat_0, p_id_1, ...) of a cell and activity, by p_id; ``alone``: there is no other such row.

    Points without a p_id are marks: an activity that has one in a cell is not alone there, nor is one whose points are not ``whole``.
    Where there is no point, its place is not a number, so that a join tests places without a look for nulls.
    """
    order = Window.partitionBy(*on).orderBy("activity", F.col("p_id").asc_nulls_last())
    rows = points.withColumns({"row": F.row_number().over(order), "behind": F.lag("activity").over(order)})
    begins = (F.col("row") == 1) | ~F.col("behind").eqNullSafe(F.col("activity"))
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("place", F.col("row") - F.last(F.when(begins, F.col("row")), ignorenulls=True).over(until)).drop("row", "behind")
    rows = rows.withColumns({f"{c}_{i}": F.lead(c, i).over(order) for i in range(1, ABREAST + 1) for c in ("place", "p_id", "lon", "lat")})
    rows = rows.where(F.col("p_id").isNotNull() & (F.col("place") % ABREAST == 0))
    same = lambda i: F.coalesce(F.col(f"place_{i}") == F.col("place") + i, F.lit(False))
    marked = reduce(Column.__or__, [same(i) & F.col(f"p_id_{i}").isNull() for i in range(1, ABREAST)])
    out = {"p_id_0": F.col("p_id"), "lon_0": F.coalesce("lon", F.lit(math.nan)), "lat_0": F.coalesce("lat", F.lit(math.nan))}
    for i in range(1, ABREAST):
        out |= {f"p_id_{i}": F.when(same(i), F.col(f"p_id_{i}"))} | {f"{c}_{i}": F.coalesce(F.when(same(i), F.col(f"{c}_{i}")), F.lit(math.nan)) for c in ("lon", "lat")}
    alone = F.col("whole") & (F.col("place") == 0) & ~same(ABREAST) & ~marked
    return rows.select(*on, "activity", alone.alias("alone"), *[v.alias(k) for k, v in out.items()])


def _first_of(met: DataFrame) -> DataFrame:
    """activity, s_id and the first point of a row that lies in its box."""
    first = F.coalesce(*[F.when(_in_box(F.col(f"lon_{i}"), F.col(f"lat_{i}")), F.col(f"p_id_{i}")) for i in range(ABREAST)])
    return met.select("activity", "s_id", first.alias("p_id")).where("p_id is not null")


def _around(low: str, high: str, step: float) -> Column:
    """The cells that a box touches in one direction, and one more on either side."""
    return F.sequence(cell(F.col(low), step) - 1, cell(F.col(high), step) + 1)


#: The least radius that ``nearest`` begins with is the given one divided by 4 so many times.
DEEPEST = 12


def nearest(points: DataFrame, targets: DataFrame, radius_m: float, max_lat: float = 60.0) -> DataFrame:
    """p_id, s_id and distance_m of the nearest target (s_id, s_lon, s_lat) within a radius; ties go to the smaller s_id.

    Cells are as wide as the radius at the highest latitude, so the target lies in one of the 3 x 3
    cells around the point. Where cells would hold many targets, a quarter of the radius is searched first, and before
    that a quarter of this, and so on: a point that finds a target within such a radius has its nearest one,
    and only the others go on to wider cells. Targets in one place count as the one of the smallest id.
    """
    places = targets.where("s_lon is not null and s_lat is not null").groupBy("s_lon", "s_lat").agg(F.min("s_id").alias("s_id"))

    def crowd(level: int) -> float:
        """How many targets the cell of a target holds on average."""
        x, y = _steps(radius_m / 4**level, max_lat)
        held = places.groupBy(cell(F.col("s_lon"), x), cell(F.col("s_lat"), y)).agg(F.count("*").alias("n"))
        return held.agg(F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n")).first()[0] or 1.0

    depth = max(0, math.ceil(math.log(crowd(0), 16)))
    while 0 < depth < DEEPEST and crowd(depth) > 4:
        depth += 1
    rest, done = points.select("p_id", "lon", "lat"), []
    for level in range(depth, -1, -1):
        radius = radius_m / 4**level
        met = _met(rest, places, radius, max_lat)
        best = met.where(F.col("distance_m") <= radius).groupBy("p_id").agg(F.min(F.struct("distance_m", "s_id")).alias("m"))
        if level:
            best = cut(best, "nearest")
            rest = rest.join(best, "p_id", "left_anti")
        done.append(best)
    best = reduce(DataFrame.unionByName, done).groupBy("p_id").agg(F.min("m").alias("m"))
    return best.select("p_id", "m.s_id", F.round("m.distance_m", 3).alias("distance_m"))


def _steps(radius_m: float, max_lat: float) -> tuple[float, float]:
    """Width and height of cells of which 3 x 3 hold all within a radius of any point in the middle one."""
    lat_step = radius_m / 111_000.0
    return lat_step / math.cos(math.radians(max_lat)), lat_step


def _met(points: DataFrame, places: DataFrame, radius_m: float, max_lat: float) -> DataFrame:
    """Points and the places in the 3 x 3 cells around them, with their distance."""
    x, y = _steps(radius_m, max_lat)
    around = F.sequence(F.lit(-1), F.lit(1))
    at = points.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
    at = at.select("p_id", "lon", "lat", (cell(F.col("lon"), x) + F.col("dx")).alias("cx"), (cell(F.col("lat"), y) + F.col("dy")).alias("cy"))
    tiles = places.select("s_id", "s_lon", "s_lat", cell(F.col("s_lon"), x).alias("cx"), cell(F.col("s_lat"), y).alias("cy"))
    return at.join(tiles, ["cx", "cy"]).withColumn("distance_m", haversine_m(F.col("lon"), F.col("lat"), F.col("s_lon"), F.col("s_lat")))


def prioritised(matches: DataFrame, key: str, other: str, priority: Column, distance: Column, n: Column | None = None) -> DataFrame:
    """The best match per key by priority, then distance, then id, with how many others there were; a row may stand for ``n`` matches."""
    order = Window.partitionBy(key).orderBy(priority, distance, other)
    every = F.sum(F.lit(1) if n is None else n).over(Window.partitionBy(key))
    return matches.withColumn("rank", F.row_number().over(order)).withColumn("alternatives", every - 1).where("rank = 1").drop("rank")
