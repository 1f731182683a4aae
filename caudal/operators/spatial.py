"""Spatial operators (GEO1-GEO9) as DataFrame jobs.

No geometry library runs per row: polygons are ring arrays, joins are equi-joins
on grid-cell keys followed by exact column predicates, so Catalyst/AQE pick the
physical join (broadcast when the measured polygon side is small, sort-merge with
skew splitting otherwise).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions.text import fixed
from caudal.functions.geometry import (
    EARTH_RADIUS_M, METERS_PER_DEGREE, bbox_ring, coordinates_json, haversine_m, oriented_rings, parts_of,
    polygon_edges, rings_bbox,
)

# ------------------------------------------------------------------ GEO1

def bbox_polygons(points: DataFrame, lon: str = "lon", lat: str = "lat", half_width: float = 0.01,
                  out: str = "rings") -> DataFrame:
    """GEO1: square polygon around each point plus its bounds columns."""
    h = float(half_width)
    return points.withColumns({
        "min_lon": F.col(lon) - h, "max_lon": F.col(lon) + h,
        "min_lat": F.col(lat) - h, "max_lat": F.col(lat) + h,
        out: F.array(bbox_ring(F.col(lon), F.col(lat), h)),
    })


# ------------------------------------------------------------------ GEO3

# Cells of a polygon's own grid halve at most so often. Its columns and rows begin at odd places of their own, so that
# outlines and points with round coordinates and slopes do not run through its corners, where rounding would decide.
_POLYGON_LEVELS, _COLUMN_ORIGIN, _ROW_ORIGIN = 14, (math.sqrt(5) - 1) / 2, math.sqrt(2) - 1


def polygon_cell_index(polygons: DataFrame, poly_id: str, rings: str = "rings", cell_deg: float = 0.25) -> DataFrame:
    """(poly_id, level, cell_row, cell_col, inside, edges) for the point-in-polygon join.

    Every polygon has a grid of its own: cells of ``cell_deg / 2^level``, as fine as keeps its cells no more than its edges
    (and the cells of ``cell_deg``). So an outline of n edges is spread over about sqrt(n) cells, each with its own few
    edges. Edges are exploded first; a cell that an edge's bounding box touches holds that edge. ``inside`` tells whether
    the middle of the cell's left side (its reference) lies in the polygon: the crossings of the row's middle line are
    counted along the row. Cells that no edge touches lie wholly inside or outside; inside ones have no edges.
    """
    base = _with_level(polygons, poly_id, rings, cell_deg)
    side = _polygon_side(cell_deg)

    def row(v):
        return _polygon_row(v, side)

    def column(v):
        return _polygon_column(v, side)

    key = [poly_id, "level", "cell_row", "cell_col"]
    e = base.select(poly_id, "level", F.explode("_e").alias("e")).select(poly_id, "level", "e.*")
    rows = e.withColumn("cell_row", F.explode(F.sequence(row(F.least("y1", "y2")), row(F.greatest("y1", "y2")))))
    touched = rows.withColumn("cell_col", F.explode(F.sequence(column(F.least("x1", "x2")), column(F.greatest("x1", "x2")))))
    middle = _reference(side)[1]
    at = (F.col("x2") - F.col("x1")) * (middle - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    # a crossing lies left of the references from this column on
    crossed = rows.filter((F.col("y1") > middle) != (F.col("y2") > middle)).withColumn("cell_col", F.ceil(at / side + F.lit(_COLUMN_ORIGIN)).cast("long"))
    every = base.withColumn("cell_row", F.explode(F.sequence(row(F.col("min_lat")), row(F.col("max_lat"))))).withColumn(
        "cell_col", F.explode(F.sequence(column(F.col("min_lon")), column(F.col("max_lon")))))
    edge = F.struct("x1", "y1", "x2", "y2")
    none = F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>")
    marks = every.select(*key, F.lit(0).alias("_n"), F.lit(True).alias("_in"), none.alias("_edge"))
    marks = marks.union(crossed.select(*key, F.lit(1), F.lit(None).cast("boolean"), none))
    marks = marks.union(touched.select(*key, F.lit(0), F.lit(None).cast("boolean"), edge))
    cells = marks.groupBy(*key).agg(F.sum("_n").alias("_n"), F.max("_in").alias("_in"), F.collect_list("_edge").alias("edges"))
    along = Window.partitionBy(poly_id, "level", "cell_row").orderBy("cell_col")
    cells = cells.withColumn("inside", F.sum("_n").over(along) % 2 == 1).filter("_in")
    has_edges = F.size("edges") > 0
    return cells.filter(F.col("inside") | has_edges).select(*key, "inside", F.when(has_edges, F.col("edges")).alias("edges"))


def _with_level(polygons: DataFrame, poly_id: str, rings: str, cell_deg: float) -> DataFrame:
    """poly_id, edges (``_e``), bounds and the level of the polygon's grid."""
    base = polygons.select(poly_id, polygon_edges(F.col(rings)).alias("_e"), *[v.alias(k) for k, v in rings_bbox(F.col(rings)).items()])
    area = F.greatest((F.col("max_lon") - F.col("min_lon")) * (F.col("max_lat") - F.col("min_lat")), F.lit(1e-12))
    level = F.floor(F.log2(F.lit(float(cell_deg)) * F.sqrt(F.size("_e") / area)))
    return base.withColumn("level", F.greatest(F.lit(0), F.least(F.lit(_POLYGON_LEVELS), level)).cast("int"))


def _polygon_side(cell_deg: float) -> Column:
    return F.lit(float(cell_deg)) / F.pow(F.lit(2.0), F.col("level").cast("double"))


def _polygon_row(lat: Column, side: Column) -> Column:
    return F.floor(lat / side + F.lit(_ROW_ORIGIN)).cast("long")


def _polygon_column(lon: Column, side: Column) -> Column:
    return F.floor(lon / side + F.lit(_COLUMN_ORIGIN)).cast("long")


def _reference(side: Column) -> tuple[Column, Column]:
    """Longitude of the cell's left side, and latitude of its middle."""
    return (F.col("cell_col") - F.lit(_COLUMN_ORIGIN)) * side, (F.col("cell_row") - F.lit(_ROW_ORIGIN) + F.lit(0.5)) * side


def _same_side(edges: Column, lon: Column, lat: Column, left: Column, middle: Column) -> Column:
    """Whether the path from a point along its latitude to the cell's left side, and on to the reference, meets an even
    number of edges. Vertices on a line count as below it (left of it), on either part of the path."""
    def step(even, e):
        x = (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        y = (e["y2"] - e["y1"]) * (left - e["x1"]) / (e["x2"] - e["x1"]) + e["y1"]
        over = ((e["y1"] > lat) != (e["y2"] > lat)) & (x > left) & (x <= lon)
        along = ((e["x1"] > left) != (e["x2"] > left)) & ((y > lat) != (y > middle))
        return (even != over) != along

    return F.aggregate(edges, F.lit(True), step)


def points_in_polygons(points: DataFrame, polygons: DataFrame, poly_id: str, lon: str = "lon",
                       lat: str = "lat", rings: str = "rings", cell_deg: float = 0.25,
                       poly_cols: list[str] | None = None, salt: int = 1) -> DataFrame:
    """GEO3: every (point, polygon) pair with the point inside the polygon.

    One equi-join of points to the polygons' cell index on (level, cell); points in
    cells without edges match directly, the others test the edges of their own cell, on the way to its reference.
    A point inside two overlapping
    polygons appears once per polygon. Output is the point's columns plus
    ``poly_id`` (and ``poly_cols`` of the polygon). Points are keyed for the levels that some polygon has: one, unless
    outlines are very long.

    ``salt`` splits the points of a cell over that many keys, for points that crowd in few cells; the
    index (polygons' cells, not points) is repeated as often.
    """
    index = polygon_cell_index(polygons, poly_id, rings, cell_deg)
    levels = _with_level(polygons, poly_id, rings, cell_deg).agg(F.collect_set("level").alias("l")).scalar()  # _POLYGON_LEVELS + 1 at most
    side = _polygon_side(cell_deg)
    pts = points.withColumn("level", F.explode(levels)).withColumns({
        "cell_row": _polygon_row(F.col(lat), side),
        "cell_col": _polygon_column(F.col(lon), side),
    })
    keys = ["level", "cell_row", "cell_col"]
    if salt > 1:
        pts = pts.withColumn("_salt", F.pmod(F.xxhash64(lon, lat), F.lit(salt)).cast("int"))
        index = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys = [*keys, "_salt"]
    cand = pts.join(index, keys)
    same = _same_side(F.col("edges"), F.col(lon), F.col(lat), *_reference(side))
    found = cand.filter(F.when(F.col("edges").isNull(), F.col("inside")).otherwise(F.col("inside") == same))
    out = found.drop(*keys, "edges", "inside")
    if poly_cols:
        out = out.join(polygons.select(poly_id, *poly_cols), poly_id)
    return out


def assign_single_polygon(pairs: DataFrame, point_id: str, poly_id: str, order_col: str) -> DataFrame:
    """One polygon per point when polygons overlap: the one with the smallest ``order_col``."""
    return pairs.groupBy(point_id).agg(
        F.min_by(F.struct(poly_id, order_col), F.col(order_col)).alias("_p")
    ).select(point_id, F.col(f"_p.{poly_id}").alias(poly_id), F.col(f"_p.{order_col}").alias(order_col))


# ------------------------------------------------------------------ GEO4

def _neighbour_candidates(queries: DataFrame, points: DataFrame, q_id: str, p_id: str,
                          radius_m: float, qlon: str, qlat: str, plon: str, plat: str) -> DataFrame:
    """All (query, point) pairs within ``radius_m`` (haversine), via a cell equi-join.

    Cell side = radius in latitude degrees; a query probes its row +-1 and as many
    columns as the radius spans at the band's worst-case latitude. Columns wrap
    at the antimeridian.
    """
    c = radius_m / METERS_PER_DEGREE
    ncols_total = max(1, int(math.ceil(360.0 / c)))
    q = queries.select(F.col(q_id), F.col(qlon).alias("_qlon"), F.col(qlat).alias("_qlat"))
    q = q.withColumn("_qrow", F.floor((F.col("_qlat") + 90.0) / c).cast("long"))
    worst_lat = F.least(F.lit(89.999), F.abs(F.col("_qlat")) + F.lit(2 * c))
    span = F.lit(c) / F.cos(F.radians(worst_lat))
    ncol = F.least(F.lit(ncols_total), F.ceil(span / F.lit(c)).cast("long"))
    qcol = F.floor((F.col("_qlon") + 180.0) / c).cast("long")
    q = q.withColumn("_dr", F.explode(F.sequence(F.lit(-1).cast("long"), F.lit(1).cast("long"))))
    q = q.withColumn("cell_row", F.col("_qrow") + F.col("_dr"))
    q = q.withColumn("cell_col", F.explode(F.array_distinct(F.transform(
        F.sequence(-ncol, ncol), lambda d: F.pmod(qcol + d, F.lit(ncols_total))))))
    p = points.select(F.col(p_id), F.col(plon).alias("_plon"), F.col(plat).alias("_plat"))
    p = p.withColumns({
        "cell_row": F.floor((F.col("_plat") + 90.0) / c).cast("long"),
        "cell_col": F.pmod(F.floor((F.col("_plon") + 180.0) / c).cast("long"), F.lit(ncols_total)),
    })
    j = q.drop("_dr", "_qrow").join(p, ["cell_row", "cell_col"])
    j = j.withColumn("dist_m", haversine_m("_qlon", "_qlat", "_plon", "_plat"))
    return j.filter(F.col("dist_m") <= radius_m).select(q_id, p_id, "dist_m")


def _top_k(cands: DataFrame, q_id: str, p_id: str, k: int, salt_buckets: int = 16) -> DataFrame:
    """k smallest distances per query (ties -> smallest point id), with bounded groups.

    k = 1 is a plain ``min`` aggregate (partial aggregation, no sort). For k > 1 a
    first ranking runs per (query, hash bucket of point) and a second over at most
    ``salt_buckets * k`` survivors per query, so a query with a huge candidate set
    is split across tasks.
    """
    if k == 1:
        best = cands.groupBy(q_id).agg(F.min(F.struct("dist_m", p_id)).alias("_b"))
        return best.select(q_id, F.col(f"_b.{p_id}").alias(p_id), F.col("_b.dist_m").alias("dist_m"),
                           F.lit(1).alias("rank"))
    salted = cands.withColumn("_salt", F.pmod(F.xxhash64(p_id), F.lit(salt_buckets)))
    w1 = Window.partitionBy(q_id, "_salt").orderBy("dist_m", p_id)
    first = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(q_id).orderBy("dist_m", p_id)
    return first.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)


# Cells of the unbounded k-nearest search: the side in degrees at level 0; each level above doubles it (the coarsest cell
# holds the whole sphere), each below, for crowded cells only, halves it.
_MIDDLE_DEG, _LEVELS, _FINE_LEVELS = 0.02, 15, 18
# A middle cell with more points is counted in finer cells too.
_CROWDED = 256


def _side(level: Column) -> Column:
    return F.lit(_MIDDLE_DEG) * F.pow(F.lit(2.0), level.cast("double"))


def _cell_at(level: Column, middle: Column, position: Column) -> Column:
    """Row (or column) of a position in the cells of a level; ``middle`` is that of level 0."""
    up = F.call_function("shiftright", middle, F.greatest(level, F.lit(0)))
    return F.when(level >= 0, up).otherwise(F.floor(position / _side(level)).cast("long"))


def nearest_candidates(queries: DataFrame, points: DataFrame, q_id: str, p_id: str, k: int, qlon: str = "lon", qlat: str = "lat",
                       plon: str = "lon", plat: str = "lat") -> DataFrame:
    """Pairs (q_id, p_id, dist_m) that hold the k nearest points of every query; see ``nearest_points``."""
    def placed(df, key, lon, lat):
        x, y = F.pmod(F.col(lon) + 180.0, F.lit(360.0)), F.col(lat) + 90.0
        return df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(
            F.col(key), F.col(lon).alias(f"_{key}_lon"), F.col(lat).alias(f"_{key}_lat"), x.alias("_x"), y.alias("_y"),
            F.floor(y / _MIDDLE_DEG).cast("long").alias("_row"), F.floor(x / _MIDDLE_DEG).cast("long").alias("_col"))

    def at(df, levels):
        df = df.withColumn("_level", F.explode(levels))
        lv = F.col("_level")
        return df.withColumns({"_r": _cell_at(lv, F.col("_row"), F.col("_y")), "_c": _cell_at(lv, F.col("_col"), F.col("_x"))})

    def levels(low, high):
        return F.sequence(F.lit(low), F.lit(high))

    q, p = placed(queries, q_id, qlon, qlat), placed(points, p_id, plon, plat)
    cells = p.groupBy("_row", "_col").agg(F.count(F.lit(1)).alias("_n"))
    crowded = cells.filter(F.col("_n") > max(k, _CROWDED)).select("_row", "_col", F.lit(True).alias("_crowded"))
    p = p.join(crowded, ["_row", "_col"], "left")
    # of points in one place only the k smallest ids can be among the k nearest
    place_rank = F.row_number().over(Window.partitionBy(f"_{p_id}_lon", f"_{p_id}_lat").orderBy(p_id))
    dense = p.filter("_crowded").withColumn("_i", place_rank).filter(F.col("_i") <= k).drop("_i")
    p = p.filter("_crowded IS NULL").unionByName(dense).drop("_crowded")
    coarse = cells.withColumn("_level", F.explode(levels(0, _LEVELS - 1))).groupBy(
        "_level", *[F.call_function("shiftright", F.col(c), F.col("_level")).alias(n) for c, n in (("_row", "_r"), ("_col", "_c"))]).agg(F.sum("_n").alias("_n"))
    fine = at(dense, levels(-_FINE_LEVELS, -1)).groupBy("_level", "_r", "_c").agg(F.count(F.lit(1)).alias("_n"))
    counts = coarse.unionByName(fine).filter(F.col("_n") >= k)
    # the first level that holds k points; the coarsest stands for a sphere with fewer
    place = F.struct("_level", f"_{q_id}_lon", f"_{q_id}_lat", "_r", "_c")
    q = at(q, levels(-_FINE_LEVELS, _LEVELS - 1)).join(counts, ["_level", "_r", "_c"], "left")
    q = q.filter(F.col("_n").isNotNull() | (F.col("_level") == _LEVELS - 1)).groupBy(q_id).agg(F.min(place).alias("_p"))
    q = q.select(q_id, "_p.*")
    chosen = q.agg(F.collect_set("_level").alias("l")).scalar()  # as many as there are levels at most
    side = _side(F.col("_level"))
    reach = side * (math.sqrt(2.0) * (1 + 1e-9))  # degrees of arc
    total = F.ceil(F.lit(360.0) / side).cast("long")
    lat = F.abs(F.col(f"_{q_id}_lat"))
    # columns that a reach spans at the far latitude; near a pole, all
    wide = F.when(reach + lat >= 89.0, total).otherwise(
        F.least(total, F.ceil(F.lit(math.sqrt(2.0) * (1 + 1e-9)) / F.cos(F.radians(F.least(F.lit(89.0), lat + reach)))).cast("long") + 1))
    q = q.select(q_id, "_level", f"_{q_id}_lon", f"_{q_id}_lat", total.alias("_total"), wide.alias("_wide"),
                 F.when(F.col("_level") == _LEVELS - 1, F.lit(math.pi * EARTH_RADIUS_M + 1.0)).otherwise(reach * METERS_PER_DEGREE).alias("_reach"),
                 F.col("_c").alias("_c0"), F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda d: F.col("_r") + d)).alias("_row"))
    q = q.withColumnRenamed("_row", "_r").withColumn("_c", F.explode(F.array_distinct(F.transform(
        F.sequence(-F.col("_wide"), F.col("_wide")), lambda d: F.pmod(F.col("_c0") + d, F.col("_total"))))))
    j = q.join(at(p, chosen).drop("_row", "_col", "_x", "_y"), ["_level", "_r", "_c"])
    j = j.withColumn("dist_m", haversine_m(f"_{q_id}_lon", f"_{q_id}_lat", f"_{p_id}_lon", f"_{p_id}_lat"))
    return j.filter(F.col("dist_m") <= F.col("_reach")).select(q_id, p_id, "dist_m")


def nearest_points(queries: DataFrame, points: DataFrame, q_id: str, p_id: str, k: int = 1,
                   max_distance_m: float | None = None, qlon: str = "lon", qlat: str = "lat",
                   plon: str = "lon", plat: str = "lat") -> DataFrame:
    """GEO4: the k nearest points of each query point, optionally within a maximum distance.

    Output (q_id, p_id, dist_m, rank). With ``max_distance_m`` it is one neighbourhood join. Without it
    it is one lazy plan too: points are counted per cell of a nested grid, each query takes the
    smallest of its own cells that holds k points, and meets the points within
    that cell's diagonal. At least k points lie there, so its k nearest are among them. Cells that crowd are
    counted down to a side of about a centimetre, and of points in one place k are kept, so a query meets
    few points more than k however dense they lie; points are keyed for the levels that some query
    chose. Fewer than k points in all: every point. Rows with a null position have no result and are none.
    """
    if max_distance_m is not None:
        cands = _neighbour_candidates(queries, points, q_id, p_id, float(max_distance_m), qlon, qlat, plon, plat)
    else:
        cands = nearest_candidates(queries, points, q_id, p_id, k, qlon, qlat, plon, plat)
    return _top_k(cands, q_id, p_id, k)


# ------------------------------------------------------------------ GEO5 / GEO6

def polygon_centroids(polygons: DataFrame, poly_id: str, rings: str = "rings") -> DataFrame:
    """GEO5: area-weighted centroid (shoelace over all rings). Of a column of parts, outer rings add and holes subtract
    however they run; of a list of rings, holes subtract if reversed.

    Coordinates are taken relative to the polygon's first vertex so the cross
    products do not cancel for small polygons far from the origin.
    """
    if polygons.schema[rings].dataType.simpleString().startswith("array<array<array<"):
        polygons = polygons.select(poly_id, oriented_rings(F.col(rings)).alias(rings))
    origin = F.element_at(F.element_at(F.col(rings), 1), 1)
    e = polygons.select(poly_id, origin["lon"].alias("_ox"), origin["lat"].alias("_oy"),
                        F.explode(polygon_edges(F.col(rings))).alias("e"))
    e = e.select(poly_id, "_ox", "_oy",
                 (F.col("e.x1") - F.col("_ox")).alias("x1"), (F.col("e.y1") - F.col("_oy")).alias("y1"),
                 (F.col("e.x2") - F.col("_ox")).alias("x2"), (F.col("e.y2") - F.col("_oy")).alias("y2"))
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    agg = e.groupBy(poly_id).agg(
        F.first("_ox").alias("_ox"), F.first("_oy").alias("_oy"),
        F.sum(cross).alias("_a2"),
        F.sum((F.col("x1") + F.col("x2")) * cross).alias("_cx"),
        F.sum((F.col("y1") + F.col("y2")) * cross).alias("_cy"),
    )
    return agg.select(
        poly_id,
        (F.col("_ox") + F.col("_cx") / (F.lit(3.0) * F.col("_a2"))).alias("centroid_lon"),
        (F.col("_oy") + F.col("_cy") / (F.lit(3.0) * F.col("_a2"))).alias("centroid_lat"),
        (F.abs(F.col("_a2")) / 2).alias("area"),
    )


def representative_points(polygons: DataFrame, poly_id: str, rings: str = "rings") -> DataFrame:
    """GEO6: an interior point: midpoint of the widest inside span of the bbox mid-latitude line.

    Crossings of the scan line are sorted per polygon (bounded by vertex count) and
    paired (1st-2nd, 3rd-4th, ...) by the even-odd rule.
    """
    e = polygons.select(poly_id, F.explode(polygon_edges(F.col(rings))).alias("e")).select(
        poly_id, "e.x1", "e.y1", "e.x2", "e.y2")
    mid = e.groupBy(poly_id).agg(
        ((F.min(F.least("y1", "y2")) + F.max(F.greatest("y1", "y2"))) / 2).alias("scan_lat"))
    x = e.join(mid, poly_id)
    y = F.col("scan_lat")
    hit = (F.col("y1") > y) != (F.col("y2") > y)
    xs = x.filter(hit).select(
        poly_id, "scan_lat",
        ((F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")).alias("xc"))
    w = Window.partitionBy(poly_id).orderBy("xc")
    xs = xs.withColumn("_i", F.row_number().over(w)).withColumn("_next", F.lead("xc").over(w))
    spans = xs.filter(F.col("_i") % 2 == 1).select(
        poly_id, "scan_lat", ((F.col("xc") + F.col("_next")) / 2).alias("_mx"),
        (F.col("_next") - F.col("xc")).alias("_w"))
    best = spans.groupBy(poly_id).agg(
        F.max_by(F.struct("_mx", "scan_lat"), F.struct("_w", -F.col("_mx"))).alias("_b"))
    return best.select(poly_id, F.col("_b._mx").alias("rep_lon"), F.col("_b.scan_lat").alias("rep_lat"))


# ------------------------------------------------------------------ GEO2

def classify_geometries(features: DataFrame, id_col: str, gtype: str = "gtype", coords: str = "coords",
                        tolerances=(0.0, 1e-4, 1e-3, 1e-2)) -> DataFrame:
    """GEO2: audit/repair of feature geometries.

    ``gtype`` is the GeoJSON type, ``coords`` the vertex list for LineString
    (array<struct<lon,lat>>) and ``rings`` for Polygon/MultiPolygon. Polygon and
    MultiPolygon pass; a LineString whose ends meet within a tolerance becomes a
    polygon (closed ring); another LineString with 3+ distinct vertices becomes its
    convex hull if that has an area; anything else (points, vertices on one straight line) is rejected.
    Status: ok / convertible / failed.
    """
    pts = F.col(coords)
    first, last = F.element_at(pts, 1), F.element_at(pts, -1)
    gap = F.greatest(F.abs(first["lon"] - last["lon"]), F.abs(first["lat"] - last["lat"]))
    closed_tol = None
    for t in tolerances:
        cond = gap <= F.lit(float(t))
        closed_tol = F.when(cond, F.lit(float(t))) if closed_tol is None else closed_tol.when(cond, F.lit(float(t)))
    is_line = (F.col(gtype) == "LineString") & pts.isNotNull()   # size(null) is -1 without ANSI mode
    hull = convex_hull(pts)
    has_hull = F.size(hull) >= 4  # three corners and the first again
    closed_ring = F.concat(F.slice(pts, 1, F.size(pts) - 1), F.array(first))
    status = (
        F.when(F.col(gtype).isin("Polygon", "MultiPolygon"), "ok")
        .when(is_line & closed_tol.isNotNull() & (F.size(pts) >= 4), "convertible")
        .when(is_line & has_hull, "convertible")
        .otherwise("failed")
    )
    action = (
        F.when(F.col(gtype).isin("Polygon", "MultiPolygon"), "pass")
        .when(is_line & closed_tol.isNotNull() & (F.size(pts) >= 4), "close_ring")
        .when(is_line & has_hull, "convex_hull")
        .otherwise("reject")
    )
    repaired = (
        F.when(action == "close_ring", F.array(closed_ring))
        .when(action == "convex_hull", F.array(hull))
    )
    return features.withColumns({
        "status": status, "action": action, "snap_tolerance": F.when(action == "close_ring", closed_tol),
        "repaired_rings": repaired,
    })


def convex_hull(pts: Column) -> Column:
    """Monotone-chain convex hull of a vertex array as a closed ring (counter-clockwise); fewer than four
    vertices if all lie on one line.

    Runs as JVM higher-order functions over the feature's own vertex array: one sorted scan in each
    direction, in which a step copies the points kept so far once (quadratic in a feature's hull at worst).
    """
    s = F.array_sort(F.array_distinct(pts), lambda a, b: F.when(a["lon"] < b["lon"], -1)
                     .when(a["lon"] > b["lon"], 1).when(a["lat"] < b["lat"], -1)
                     .when(a["lat"] > b["lat"], 1).otherwise(0))

    def cross(o, a, b):
        return (a["lon"] - o["lon"]) * (b["lat"] - o["lat"]) - (a["lat"] - o["lat"]) * (b["lon"] - o["lon"])

    def chain(arr):
        def step(acc, p):
            # how many of the last points do not make a left turn towards p: one scan from the end
            turns = F.aggregate(
                F.reverse(F.sequence(F.lit(2), F.greatest(F.size(acc), F.lit(2)))),
                F.struct(F.lit(0).alias("drop"), (F.size(acc) < 2).alias("done")),
                lambda t, i: F.when(t["done"], t).otherwise(F.struct(
                    F.when(cross(F.element_at(acc, i - 1), F.element_at(acc, i), p) <= 0, t["drop"] + 1).otherwise(t["drop"]).alias("drop"),
                    (cross(F.element_at(acc, i - 1), F.element_at(acc, i), p) > 0).alias("done"))))
            return F.concat(F.slice(acc, F.lit(1), F.size(acc) - turns["drop"]), F.array(p))
        empty = F.slice(arr, 1, 0)
        return F.aggregate(arr, empty, step)

    lower = chain(s)
    upper = chain(F.reverse(s))
    hull = F.concat(F.slice(lower, F.lit(1), F.size(lower) - 1), F.slice(upper, F.lit(1), F.size(upper) - 1))
    return F.concat(hull, F.slice(hull, 1, 1))


# ------------------------------------------------------------------ GEO8 / GEO9

def with_coverage(locations: DataFrame, grid: DataFrame, loc_id: str, grid_id: str,
                  max_distance_m: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """GEO8: keep locations that have a grid point within ``max_distance_m``."""
    near = nearest_points(locations, grid, loc_id, grid_id, k=1, max_distance_m=max_distance_m,
                          qlon=lon, qlat=lat)
    return locations.join(near.select(loc_id), loc_id, "left_semi")


def feature_rows(polygons: DataFrame, metric: DataFrame, key: str, value_col: str,
                 geometry: str = "rings", missing_label: str = "Sin datos", gtype: str | None = None) -> DataFrame:
    """GEO9: polygons left-joined with a metric, ranked, one GeoJSON feature string per row.

    ``geometry`` names a column of parts (polygons with their holes) or of rings, ``gtype`` one with the geometry type.
    Only (key, value) is ranked; geometries join the ranks and are not sorted.
    """
    kind = F.lit("Polygon") if gtype is None else F.col(gtype)
    j = polygons.select(key, parts_of(polygons, geometry, gtype).alias("_parts"), kind.alias("_type")).join(metric.select(key, value_col), key, "left")
    w = Window.orderBy(F.col(value_col).desc_nulls_last(), F.col(key))
    ranks = metric.select(key, value_col).filter(F.col(value_col).isNotNull()).join(polygons.select(key), key, "left_semi")
    ranks = ranks.select(key, F.row_number().over(w).alias("ranking"))
    j = j.join(ranks, key, "left")
    label = F.when(F.col(value_col).isNull(), F.lit(missing_label)).otherwise(fixed(value_col, 2))
    coordinates = coordinates_json(F.col("_parts"), F.col("_type"))
    props = F.struct(F.col(key).alias("nombre"), F.col(value_col).alias("valor"), label.alias("etiqueta"),
                     F.col("ranking"))
    feature = F.concat(F.lit('{"type":"Feature","id":'), F.to_json(F.array(F.col(key))).substr(F.lit(2), F.length(F.to_json(F.array(F.col(key)))) - 2),
                       F.lit(',"properties":'), F.to_json(props), F.lit(',"geometry":{"type":"'), F.col("_type"),
                       F.lit('","coordinates":'), coordinates, F.lit("}}"))
    return j.select(key, value_col, "ranking", label.alias("etiqueta"), feature.alias("feature"))
