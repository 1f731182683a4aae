"""Planar/spherical geometry as Column expressions.

A geometry is held as plain arrays. ``parts`` is the whole of it: polygons, each an outer ring and its holes
(``PARTS``; a Polygon has one part). Where parts do not matter, ``rings`` is all of its rings in one list
(``array<array<struct<lon:double, lat:double>>>``). Point-in-
polygon uses the even-odd rule over every ring's edges with the half-open
crossing test ``(y1 > py) <> (y2 > py)``, so a point on a shared edge belongs to
exactly one of two neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378100.0
METERS_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres on a sphere of radius ``EARTH_RADIUS_M``."""
    lo1, la1, lo2, la2 = (F.radians(_c(x)) for x in (lon1, lat1, lon2, lat2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


POINT = "struct<lon:double,lat:double>"
RINGS = f"array<array<{POINT}>>"
PARTS = f"array<{RINGS}>"


def _points(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))


def parts_from_geojson(gtype: Column, coordinates: Column) -> Column:
    """``coordinates`` text of a Polygon or MultiPolygon -> parts; null for other types."""
    polygon = F.from_json(F.when(gtype == "Polygon", coordinates), "array<array<array<double>>>")
    several = F.from_json(F.when(gtype == "MultiPolygon", coordinates), "array<array<array<array<double>>>>")

    def rings(polygon):
        return F.transform(polygon, _points)

    return F.when(gtype == "Polygon", F.array(rings(polygon))).when(gtype == "MultiPolygon", F.transform(several, rings))


def parts_of(df: DataFrame, column: str, gtype: str | None = None) -> Column:
    """Parts of a geometry column that holds parts or rings.

    Rings are one polygon, the first its outer ring; of type MultiPolygon, each the outer ring of a part.
    """
    kind = df.schema[column].dataType
    if kind.simpleString().startswith("array<array<array<"):
        return F.col(column)
    one = F.array(F.col(column))
    if gtype is None:
        return one
    return F.when(F.col(gtype) == "MultiPolygon", F.transform(F.col(column), lambda r: F.array(r))).otherwise(one)


def coordinates_json(parts: Column, gtype: Column) -> Column:
    """GeoJSON ``coordinates`` text of a Polygon (its one part) or MultiPolygon."""
    pairs = F.transform(parts, lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["lon"], p["lat"]))))
    return F.when(gtype == "MultiPolygon", F.to_json(pairs)).otherwise(F.to_json(F.element_at(pairs, 1)))


def signed_area(ring: Column) -> Column:
    """Shoelace area of a closed ring, positive if it runs counter-clockwise; relative to its first vertex."""
    o = F.element_at(ring, 1)
    return F.aggregate(ring_edges(ring), F.lit(0.0), lambda a, e: a + (
        (e["x1"] - o["lon"]) * (e["y2"] - o["lat"]) - (e["x2"] - o["lon"]) * (e["y1"] - o["lat"])) / F.lit(2.0))


def oriented_rings(parts: Column) -> Column:
    """All rings, outer ones counter-clockwise and holes clockwise, so that holes subtract in sums over edges."""
    def turned(ring, i):
        return F.when((signed_area(ring) < 0) == (i == 0), F.reverse(ring)).otherwise(ring)

    return F.flatten(F.transform(parts, lambda rings: F.transform(rings, turned)))


def point_struct(lon, lat) -> Column:
    return F.struct(_c(lon).cast("double").alias("lon"), _c(lat).cast("double").alias("lat"))


def bbox_ring(lon, lat, half_width) -> Column:
    """GEO1: closed square ring around a point, ``half_width`` degrees each side."""
    x, y, h = _c(lon), _c(lat), _c(half_width) if not isinstance(half_width, (int, float)) else F.lit(float(half_width))
    return F.array(
        point_struct(x - h, y - h), point_struct(x + h, y - h), point_struct(x + h, y + h),
        point_struct(x - h, y + h), point_struct(x - h, y - h),
    )


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a ring: array<struct<x1,y1,x2,y2>>."""
    return F.transform(
        F.sequence(F.lit(1), F.size(ring) - 1),
        lambda i: F.struct(
            F.element_at(ring, i)["lon"].alias("x1"), F.element_at(ring, i)["lat"].alias("y1"),
            F.element_at(ring, i + 1)["lon"].alias("x2"), F.element_at(ring, i + 1)["lat"].alias("y2"),
        ),
    )


def polygon_edges(rings: Column) -> Column:
    """All edges of all rings (holes and parts included)."""
    return F.flatten(F.transform(rings, ring_edges))


def edges_contain(edges: Column, px, py) -> Column:
    """Even-odd test of a point against an edge list (JVM-side ``aggregate``)."""
    x, y = _c(px), _c(py)

    def step(acc, e):
        crosses = ((e["y1"] > y) != (e["y2"] > y)) & (
            x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        )
        return acc != crosses

    return F.aggregate(edges, F.lit(False), step)


def rings_bbox(rings: Column) -> dict[str, Column]:
    pts = F.flatten(rings)
    return {
        "min_lon": F.array_min(F.transform(pts, lambda p: p["lon"])),
        "max_lon": F.array_max(F.transform(pts, lambda p: p["lon"])),
        "min_lat": F.array_min(F.transform(pts, lambda p: p["lat"])),
        "max_lat": F.array_max(F.transform(pts, lambda p: p["lat"])),
    }
