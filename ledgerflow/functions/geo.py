"""GeoJSON geometry as nested arrays of doubles, without user functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How deeply the coordinates of each type are nested.
DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def _coordinates(geojson: Column, depth: int) -> Column:
    kind = "array<" * (depth + 1) + "double" + ">" * (depth + 1)
    return F.from_json(geojson, f"struct<type:string,coordinates:{kind}>")["coordinates"]


def vertices(geojson: Column) -> Column:
    """All points (arrays of longitude and latitude) of a geometry in GeoJSON text."""
    kind = F.get_json_object(geojson, "$.type")
    out = F.lit(None).cast("array<array<double>>")
    for name, depth in DEPTH.items():
        points = _coordinates(geojson, depth)
        for _ in range(depth - 1):
            points = F.flatten(points)
        out = F.when(kind == name, points if depth else F.array(points)).otherwise(out)
    return out


def centroid(points: Column) -> Column:
    """struct of lon and lat: the mean of the points, to seven places; null without points."""
    mean = lambda i: F.round(F.aggregate(points, F.lit(0.0), lambda s, p: s + p[i]) / F.size(points), 7)
    return F.when(F.size(points) > 0, F.struct(mean(0).alias("lon"), mean(1).alias("lat")))


def bbox(points: Column) -> Column:
    side = lambda f, i: f(F.transform(points, lambda p: p[i]))
    return F.struct(
        side(F.array_min, 0).alias("west"), side(F.array_min, 1).alias("south"), side(F.array_max, 0).alias("east"), side(F.array_max, 1).alias("north")
    )


def cell(value: Column, step: float) -> Column:
    return F.floor(value / step)


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd rule over a closed ring of points."""
    edges = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))

    def crosses(e: Column) -> Column:
        ax, ay, bx, by = e["a"][0], e["a"][1], e["b"][0], e["b"][1]
        at = (bx - ax) * (lat - ay) / F.when(by == ay, F.lit(None)).otherwise(by - ay) + ax
        return ((ay > lat) != (by > lat)) & (lon < at)

    return F.coalesce(F.size(F.filter(edges, crosses)) % 2 == 1, F.lit(False))


def in_polygon(lon: Column, lat: Column, rings: Column) -> Column:
    """In the first ring and in none of the holes."""
    return in_ring(lon, lat, rings[0]) & ~F.exists(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: in_ring(lon, lat, r))


def in_multipolygon(lon: Column, lat: Column, polygons: Column) -> Column:
    return F.exists(polygons, lambda p: in_polygon(lon, lat, p))
