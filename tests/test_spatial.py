import math
import random

import pytest
from pyspark.sql import functions as F

from caudal.functions.geometry import EARTH_RADIUS_M
from caudal.operators import spatial


def poly(spark, rows):
    """rows: (id, [(lon, lat), ...]) closed rings."""
    data = [(i, [[{"lon": float(x), "lat": float(y)} for x, y in ring]]) for i, ring in rows]
    return spark.createDataFrame(data, "pid long, rings array<array<struct<lon:double,lat:double>>>")


def test_pip_matches_closed_form_diamond(spark):
    diamond = [(0.5, 0.05), (0.95, 0.5), (0.5, 0.95), (0.05, 0.5), (0.5, 0.05)]
    polys = poly(spark, [(1, diamond)])
    pts = spark.range(0, 41 * 41).select(F.col("id").alias("pt"), ((F.col("id") % 41) / 40.0 + 0.0013).alias("lon"),
                                         (F.floor(F.col("id") / 41) / 40.0 + 0.0021).alias("lat"))
    got = {r.pt for r in spatial.points_in_polygons(pts, polys, "pid", cell_deg=0.1).collect()}
    want = {r.pt for r in pts.collect() if abs(r.lon - 0.5) + abs(r.lat - 0.5) < 0.45}
    assert got == want and len(want) > 100


def test_pip_overlap_and_shared_edge(spark):
    a = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    b = [(1, 0), (2, 0), (2, 1), (1, 1), (1, 0)]
    c = [(0.5, 0), (1.5, 0), (1.5, 1), (0.5, 1), (0.5, 0)]   # overlaps a and b
    polys = poly(spark, [(1, a), (2, b), (3, c)])
    pts = spark.createDataFrame([(1, 1.0, 0.5), (2, 0.75, 0.5), (3, 5.0, 5.0)], "pt long, lon double, lat double")
    got = spatial.points_in_polygons(pts, polys, "pid").groupBy("pt").agg(F.sort_array(F.collect_list("pid")).alias("p"))
    m = {r.pt: r.p for r in got.collect()}
    assert len([p for p in m.get(1, []) if p in (1, 2)]) == 1      # shared edge: exactly one of the neighbours
    assert m[2] == [1, 3]                                           # overlap: both polygons
    assert 3 not in m


def test_pip_polygon_with_hole_and_multipolygon(spark):
    outer = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    hole = [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]
    data = [(1, [[{"lon": float(x), "lat": float(y)} for x, y in r] for r in (outer, hole)])]
    polys = spark.createDataFrame(data, "pid long, rings array<array<struct<lon:double,lat:double>>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0)], "pt long, lon double, lat double")
    got = {r.pt for r in spatial.points_in_polygons(pts, polys, "pid").collect()}
    assert got == {1}


def hav(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(a)))


@pytest.mark.parametrize("k,maxd", [(1, None), (3, None), (2, 150_000.0)])
def test_knn_matches_brute_force(spark, k, maxd):
    rnd = random.Random(7)
    pts = [(i, rnd.uniform(-60, -50), rnd.uniform(-36, -28)) for i in range(300)]
    qs = [(i, rnd.uniform(-62, -48), rnd.uniform(-38, -26)) for i in range(40)]
    P = spark.createDataFrame(pts, "pid long, lon double, lat double")
    Q = spark.createDataFrame(qs, "qid long, lon double, lat double")
    got = spatial.nearest_points(Q, P, "qid", "pid", k=k, max_distance_m=maxd)
    got = {(r.qid, r.rank): r.pid for r in got.collect()}
    for qid, qx, qy in qs:
        d = sorted((hav(qx, qy, x, y), pid) for pid, x, y in pts)
        if maxd is not None:
            d = [t for t in d if t[0] <= maxd]
        for rank, (_, pid) in enumerate(d[:k], start=1):
            assert got[(qid, rank)] == pid
        assert (qid, len(d[:k]) + 1) not in got


def test_centroid_and_representative_point(spark):
    sq = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    L = [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]
    polys = poly(spark, [(1, sq), (2, L)])
    c = {r.pid: r for r in spatial.polygon_centroids(polys, "pid").collect()}
    assert (c[1].centroid_lon, c[1].centroid_lat, c[1].area) == pytest.approx((1.0, 1.0, 4.0))
    assert c[2].area == pytest.approx(3.0)
    rp = {r.pid: r for r in spatial.representative_points(polys, "pid").collect()}
    inside = spatial.points_in_polygons(
        spark.createDataFrame([(p, rp[p].rep_lon, rp[p].rep_lat) for p in rp], "pt long, lon double, lat double"),
        polys, "pid").filter(F.col("pt") == F.col("pid"))
    assert inside.count() == 2


def test_geometry_audit(spark):
    pts = "array<struct<lon:double,lat:double>>"
    rows = [(1, "Polygon", None), (2, "LineString", [(0, 0), (1, 0), (1, 1), (0, 0)]),
            (3, "LineString", [(0, 0), (1, 0), (1, 1)]), (4, "Point", [(0, 0)]),
            (5, "LineString", [(0, 0), (1, 0), (1, 1), (0.00005, 0.0)])]
    data = [(i, t, None if c is None else [{"lon": float(x), "lat": float(y)} for x, y in c]) for i, t, c in rows]
    df = spark.createDataFrame(data, f"id long, gtype string, coords {pts}")
    got = {r.id: r for r in spatial.classify_geometries(df, "id").collect()}
    assert (got[1].status, got[1].action) == ("ok", "pass")
    assert (got[2].status, got[2].action) == ("convertible", "close_ring")
    assert got[3].action == "convex_hull" and len(got[3].repaired_rings[0]) == 4
    assert (got[4].status, got[4].action) == ("failed", "reject")
    assert got[5].action == "close_ring" and got[5].snap_tolerance == pytest.approx(1e-4)


@pytest.mark.parametrize("n,k", [(200, 3), (2, 5), (1, 1)])
def test_knn_over_the_whole_sphere(spark, n, k):
    rnd = random.Random(11)
    pts = [(i, rnd.uniform(-180, 180), rnd.choice([rnd.uniform(-90, 90), 89.9, -89.9])) for i in range(n)]
    qs = [(i, rnd.choice([-179.99, 179.99, rnd.uniform(-180, 180)]), rnd.choice([-90.0, 90.0, rnd.uniform(-90, 90)])) for i in range(40)]
    P = spark.createDataFrame([*pts, (900, None, 1.0)], "pid long, lon double, lat double")
    Q = spark.createDataFrame([*qs, (900, 1.0, None)], "qid long, lon double, lat double")
    got = {(r.qid, r.rank): r.dist_m for r in spatial.nearest_points(Q, P, "qid", "pid", k=k).collect()}
    assert len(got) == 40 * min(k, n)
    for qid, qx, qy in qs:
        for rank, d in enumerate(sorted(hav(qx, qy, x, y) for _, x, y in pts)[:k], start=1):
            assert got[qid, rank] == pytest.approx(d, abs=1e-3)


def test_vertices_on_one_line_are_no_polygon(spark):
    rows = [(1, "LineString", [(0, 0), (1, 1), (2, 2)]), (2, "LineString", [(0, 0), (1, 0), (1, 1), (0.4, 0.2)]),
            (3, "LineString", [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]), (4, "Point", [(0, 0)])]
    data = [(i, t, [{"lon": float(x), "lat": float(y)} for x, y in p]) for i, t, p in rows]
    df = spark.createDataFrame(data, "id int, gtype string, coords array<struct<lon:double,lat:double>>")
    got = {r.id: (r.status, r.action, None if r.repaired_rings is None else len(r.repaired_rings[0]))
           for r in spatial.classify_geometries(df, "id").collect()}
    assert got == {1: ("failed", "reject", None), 2: ("convertible", "convex_hull", 4),
                   3: ("convertible", "close_ring", 5), 4: ("failed", "reject", None)}


def test_hull_matches_brute_force(spark):
    rnd = random.Random(5)
    pts = [(rnd.randint(0, 12), rnd.randint(0, 12)) for _ in range(60)]
    df = spark.createDataFrame([([{"lon": float(x), "lat": float(y)} for x, y in pts],)], "c array<struct<lon:double,lat:double>>")
    ring = [(p.lon, p.lat) for p in df.select(spatial.convex_hull(F.col("c"))).first()[0]]

    def left(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    assert ring[0] == ring[-1] and set(ring) <= set(pts)
    assert all(left(a, b, p) >= 0 for a, b in zip(ring, ring[1:]) for p in pts)
    assert all(left(a, b, c) > 0 for a, b, c in zip(ring, ring[1:], ring[2:]))


def test_parts_of_a_multipolygon_are_no_holes(spark):
    import json

    from caudal.operators import keys
    square = [{"lon": float(x), "lat": float(y)} for x, y in [(0, 0), (1, 0), (1, 1), (0, 0)]]
    other = [{"lon": p["lon"] + 5, "lat": p["lat"]} for p in square]
    areas = spark.createDataFrame([("a", [square, other], "MultiPolygon"), ("b", [square], "Polygon")],
                                  "nombre string, rings array<array<struct<lon:double,lat:double>>>, gtype string")
    metric = spark.createDataFrame([("a", 1.5)], "nombre string, v double")
    rows = {r.nombre: (r, json.loads(r.feature)) for r in spatial.feature_rows(areas, metric, "nombre", "v", gtype="gtype").collect()}
    assert rows["a"][1]["geometry"] == {"type": "MultiPolygon", "coordinates": [[[[p["lon"], p["lat"]] for p in r]] for r in (square, other)]}
    assert rows["b"][1]["geometry"]["type"] == "Polygon" and len(rows["b"][1]["geometry"]["coordinates"]) == 1
    assert rows["a"][1]["id"] == "a" and rows["a"][1]["properties"]["ranking"] == 1 and rows["b"][0].etiqueta == "Sin datos"
    text = areas.select(keys.polygon_wkt(F.col("rings"), F.col("gtype"))).collect()
    assert text[0][0] == "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 0, 6 0, 6 1, 5 0)))" and text[1][0] == "POLYGON ((0 0, 1 0, 1 1, 0 0))"
    ids = {r.id for r in keys.area_docs(areas, gtype="gtype").collect()} | {r.id for r in keys.area_docs(areas).collect()}
    assert len(ids) == 3  # b alone has one id for both


def test_salted_cells_give_the_same_pairs(spark):
    polys = poly(spark, [(1, [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]), (2, [(0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6), (0.4, 0.4)])])
    pts = spark.range(500).select(F.col("id").alias("pt"), (0.4001 + F.col("id") / 3000).alias("lon"), F.lit(0.45).alias("lat"))
    plain, salted = (sorted((r.pt, r.pid) for r in spatial.points_in_polygons(pts, polys, "pid", salt=n).collect()) for n in (1, 7))
    assert plain == salted and len(plain) > 500


@pytest.mark.parametrize("k", [1, 5])
def test_knn_in_one_crowded_cell(spark, k):
    import numpy as np

    g = np.random.default_rng(k)
    n = 40_000
    lon, lat = -56 + 0.019 * g.random(n) ** 3, -34 + 0.019 * g.random(n)
    lon[:5000], lat[:5000] = lon[0], lat[0]  # a third of a crowd in one place
    qlon, qlat = -56 + 0.019 * g.random(60), -34 + 0.019 * g.random(60)
    qlon[0], qlat[0] = lon[0], lat[0]
    P = spark.createDataFrame(list(zip(range(n), lon.tolist(), lat.tolist())), "pid long, lon double, lat double")
    Q = spark.createDataFrame(list(zip(range(60), qlon.tolist(), qlat.tolist())), "qid long, lon double, lat double")
    got = {(r.qid, r.rank): r for r in spatial.nearest_points(Q, P, "qid", "pid", k=k).collect()}
    assert len(got) == 60 * k
    p1, p2 = np.radians(qlat)[:, None], np.radians(lat)[None, :]
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon[None, :] - qlon[:, None]) / 2) ** 2
    d = 2 * EARTH_RADIUS_M * np.arcsin(np.minimum(1, np.sqrt(a)))
    for i in range(60):
        order = np.lexsort((np.arange(n), d[i]))[:k]
        assert [got[i, r + 1].dist_m for r in range(k)] == pytest.approx(d[i][order].tolist(), abs=1e-6)
        if i == 0:
            assert [got[i, r + 1].pid for r in range(k)] == list(range(k))  # ties: the smallest ids
    pairs = spatial.nearest_candidates(Q, P, "qid", "pid", k)
    assert pairs.groupBy("qid").count().agg(F.max("count")).first()[0] < 3000
    assert pairs.count() < 60 * 1000


def ray_test(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


@pytest.mark.parametrize("cell", [0.25, 0.1, 3.0])
def test_pip_is_the_ray_test_of_every_outline(spark, cell):
    rnd = random.Random(int(cell * 100))

    def star(cx, cy, n, r):
        pts = [(cx + r * rnd.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), cy + r * rnd.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        return [*pts, pts[0]]

    lattice = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.25), (0.5, 0.25), (0.5, 0.75), (0.75, 0.75), (0.75, 0.5), (1.0, 0.5), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    shapes = {1: [lattice], 2: [star(0.5, 0.5, 9, 0.8)], 3: [star(0.3, 0.6, 700, 1.1)], 4: [star(0.5, 0.5, 40, 1.0), star(0.5, 0.5, 30, 0.2)],
              5: [[(0.1, 0.1), (0.9, 0.1), (0.9, 0.1000001), (0.1, 0.1000001), (0.1, 0.1)]]}
    data = [(i, [[{"lon": x, "lat": y} for x, y in r] for r in rings]) for i, rings in shapes.items()]
    polys = spark.createDataFrame(data, "pid long, rings array<array<struct<lon:double,lat:double>>>")
    places = [(rnd.uniform(-0.5, 1.6), rnd.uniform(-0.5, 1.6)) for _ in range(1500)]
    places += [(i / 8, j / 8) for i in range(-2, 12) for j in range(-2, 12)]  # on cell borders, edges and vertices
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "pt long, lon double, lat double")
    got = {(r.pt, r.pid) for r in spatial.points_in_polygons(pts, polys, "pid", cell_deg=cell).collect()}
    assert got == {(i, p) for i, (x, y) in enumerate(places) for p, rings in shapes.items() if ray_test(rings, x, y)}


def test_a_long_outline_is_spread_over_cells(spark):
    n = 20_000
    ring = [(10 + math.cos(2 * math.pi * i / n), 10 + math.sin(2 * math.pi * i / n)) for i in range(n)]
    polys = poly(spark, [(1, [*ring, ring[0]]), (2, [(9, 9), (9.5, 9), (9.5, 9.5), (9, 9)])])
    index = spatial.polygon_cell_index(polys, "pid").filter("pid = 1").agg(F.max(F.size("edges")).alias("most"), F.count("*").alias("cells")).first()
    assert index.most <= 200 and index.cells <= 2 * n
    pts = spark.range(60 * 60).select(F.col("id").alias("pt"), (8.95 + F.col("id") % 60 * 0.0351).alias("lon"), (8.95 + F.floor(F.col("id") / 60) * 0.0351).alias("lat"))
    got = {r.pt for r in spatial.points_in_polygons(pts, polys, "pid").filter("pid = 1").collect()}
    assert got == {r.pt for r in pts.collect() if (r.lon - 10) ** 2 + (r.lat - 10) ** 2 < 1}
