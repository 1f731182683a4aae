import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from caudal.operators import spectral
from caudal.sources import files
from caudal.streaming import ingest


@pytest.fixture()
def tmp(spark):
    return tempfile.mkdtemp(prefix="caudal-test-", dir="/tmp")


def test_geojson_collection_kinds(spark, tmp):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"admlnm": "A", "admlcd": "1"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"admlnm": "B", "admlcd": "2"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]],
                                                              [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "properties": {"admlnm": "C", "admlcd": "3"},
         "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 0], [1, 1]]}}]}
    p = os.path.join(tmp, "d.geojson")
    with open(p, "w") as f:
        json.dump(fc, f)
    rows = {r.admlnm: r for r in files.read_geojson_collection(spark, p, ["admlnm", "admlcd"]).collect()}
    assert rows["A"].gtype == "Polygon" and len(rows["A"].rings) == 1 and rows["A"].pos == 0
    assert len(rows["B"].rings) == 2 and rows["B"].rings[1][0].lon == 5.0
    assert rows["C"].rings is None and [(q.lon, q.lat) for q in rows["C"].coords] == [(0, 0), (1, 0), (1, 1)]


def test_delimited_latin1_and_sidecar(spark, tmp):
    p = os.path.join(tmp, "r.csv")
    with open(p, "w", encoding="ISO-8859-1") as f:
        f.write("region;departamento\nSur;Río Negro\n")
    got = files.read_delimited(spark, p, ["region", "departamento"], "semicolon_latin1").collect()
    assert got[0].departamento == "Río Negro"
    d = os.path.join(tmp, "Las Brujas")
    os.makedirs(d)
    with open(os.path.join(d, "coords.txt"), "w") as f:
        f.write("-57.9, -34.3\n")
    r = files.read_sidecar_coords(spark, os.path.join(tmp, "*", "coords.txt")).first()
    assert (r.estacion, r.lat, r.lon) == ("Las Brujas", -34.3, -57.9)


def test_code_file_map(spark, tmp):
    p = os.path.join(tmp, "m.json")
    with open(p, "w") as f:
        json.dump({"pH": ["pH.csv"], "ECOLI": ["Indicator_Organism.csv", "x.csv"]}, f)
    got = {r.code: r.file for r in files.read_code_file_map(spark, p).collect()}
    assert got == {"pH": "pH.csv", "ECOLI": "Indicator_Organism.csv"}


def test_scene_medians_drop_missing(spark):
    rows = [(1, 10, dt.date(2023, 1, 1), 5.0, 0.0, 0.0, 6, 0.1, 0.2, 0.3),
            (1, 10, dt.date(2023, 1, 1), 5.0, 0.0, 0.0, 6, 0.2, 0.2, 0.2),
            (1, 11, dt.date(2023, 1, 9), 5.0, 0.0, 0.0, 6, 0.0, 0.0, 0.0),   # 0/0 -> missing -> scene dropped
            (1, 12, dt.date(2023, 1, 9), 5.0, 0.0, 0.0, 4, 0.2, 0.2, 0.5)]   # not water
    px = spark.createDataFrame(rows, "location_id int, scene_id long, fecha date, cloud_cover double, lon double, "
                                     "lat double, scl int, red double, green double, rededge1 double")
    got = spectral.scene_medians(spectral.water_mask(px), "NDCI").collect()
    assert len(got) == 1 and got[0].valor == pytest.approx(((0.3 - 0.1) / 0.4 + 0.0) / 2)
    empty = spectral.scene_medians(spectral.water_mask(px.limit(0)), "NDCI")
    assert empty.count() == 0


def test_stream_insert_if_absent_idempotent(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("id,pos,v\na,1,1.0\na,2,2.0\nb,3,3.0\n")
    schema = files.string_schema(["id", "pos", "v"])

    def prep(df):
        return df.select("id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("v"))

    def run():
        q = ingest.insert_if_absent_stream(ingest.csv_stream(spark, src, schema, 1), prep, os.path.join(tmp, "t"),
                                           os.path.join(tmp, "ck"))
        q.awaitTermination()

    run()
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("id,pos,v\nb,9,9.0\nc,10,10.0\n")
    run()   # restart from the checkpoint: only the new file, and id b already present is skipped
    got = {r.id: r.v for r in spark.read.parquet(os.path.join(tmp, "t")).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": 10.0}


def test_read_many_skips_missing_glob(spark, tmp):
    d = os.path.join(tmp, "precip")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("fecha,estacion_id,precip_horario\n2020-01-01,S1,1.5\n")
    u = files.read_many(spark, [(f"{tmp}/precip/*.csv", ["fecha", "estacion_id", "precip_horario"]),
                                (f"{tmp}/humedad/*.csv", ["fecha", "estacion_id", "hum_relativa"])],
                        attribute="tipo", pattern=r"/(precip|humedad)/")
    rows = u.collect()
    assert len(rows) == 1 and rows[0].tipo == "precip"


def test_unreadable_file_ends_the_read_unless_skipped(spark, tmp_path):
    import gzip

    from caudal.sources import files
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    (tmp_path / "bad.csv.gz").write_bytes(gzip.compress(b"a,b\n" + b"3,4\n" * 5000)[:14])
    with pytest.raises(Exception):
        files.read_delimited(spark, f"{tmp_path}/*", ["a", "b"]).collect()
    rows = files.read_delimited(spark, f"{tmp_path}/*", ["a", "b"], with_path=True, skip_unreadable=True)
    assert [(r.a, r.b) for r in rows.collect()] == [("1", "2")]
    left = files.unread_files(spark, f"{tmp_path}/*", rows).collect()
    assert [r.path.rsplit("/", 1)[1] for r in left] == ["bad.csv.gz"]


def test_json_documents_are_bounded(spark, tmp_path):
    from caudal.sources import files
    files.write_json_arrays(spark.range(25).coalesce(1), f"{tmp_path}/arrays", per_document=10)
    assert sorted(r.id for r in files.read_json_array(spark, f"{tmp_path}/arrays", "id long").collect()) == list(range(25))
    assert len(list((tmp_path / "arrays").glob("*.txt"))) == 3


def test_geometries_with_holes_and_parts_round_trip(spark, tmp):
    from pyspark.sql import functions as F

    from caudal.functions.geometry import PARTS
    from caudal.operators import keys, spatial

    def ring(x, y, w, turn=False):
        pts = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
        return [{"lon": float(a), "lat": float(b)} for a, b in (pts[::-1] if turn else pts)]

    rows = [("p", "Polygon", [[ring(0, 0, 4), ring(1, 1, 1)]]), ("m", "MultiPolygon", [[ring(0, 0, 4, True), ring(1, 1, 2)], [ring(10, 0, 1)]]),
            ("s", "Polygon", [[ring(0.1, 0.2, 0.3)]])]
    df = spark.createDataFrame(rows, f"name string, gtype string, parts {PARTS}")
    files.write_feature_lines(df, os.path.join(tmp, "lines"), ["name"])
    files.write_feature_collections(df, os.path.join(tmp, "fc"), ["name"], per_document=2)
    back = [files.read_geojson_lines(spark, os.path.join(tmp, "lines"), ["name"]), files.read_geojson_collection(spark, os.path.join(tmp, "fc"), ["name"])]
    want = {r.name: (r.gtype, r.parts) for r in df.collect()}
    for b in back:
        assert {r.name: (r.gtype, r.parts) for r in b.collect()} == want
    # rings alone, as before: of a MultiPolygon each is a part
    flat = df.where("name <> 'p'").select("name", "gtype", F.transform("parts", lambda p: p[0]).alias("rings"))
    files.write_feature_lines(flat, os.path.join(tmp, "flat"), ["name"])
    got = {r.name: len(r.parts) for r in files.read_geojson_lines(spark, os.path.join(tmp, "flat"), ["name"]).collect()}
    assert got == {"m": 2, "s": 1}
    text = {r.name: r.t for r in df.select("name", keys.geometry_wkt(F.col("parts"), F.col("gtype")).alias("t")).collect()}
    assert text["m"].startswith("MULTIPOLYGON (((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 3 1,") and text["m"].endswith("), ((10 0, 11 0, 11 1, 10 1, 10 0)))")
    assert text["p"] == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    area = {r.name: r.area for r in spatial.polygon_centroids(df, "name", "parts").collect()}
    assert area == pytest.approx({"p": 15.0, "m": 13.0, "s": 0.09})
    metric = spark.createDataFrame([("m", 1.0)], "name string, v double")
    feats = {r.name: json.loads(r.feature)["geometry"] for r in spatial.feature_rows(df, metric, "name", "v", "parts", gtype="gtype").collect()}
    assert [len(p) for p in feats["m"]["coordinates"]] == [2, 1] and len(feats["p"]["coordinates"]) == 2


def test_rejected_lines_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3\n4,5,6\n7,8\n,\n")
    (tmp_path / "b.csv").write_text("a,b\n1,2\n")
    (tmp_path / "c.csv").write_text("a,b\n")
    rows = files.read_delimited(spark, f"{tmp_path}/*.csv", ["a", "b"], with_path=True, rejected="line")
    counts = {r.source_file.rsplit("/", 1)[1]: (r.filas, r.rechazadas) for r in files.line_counts(rows, "line").collect()}
    assert counts == {"a.csv": (5, 2), "b.csv": (1, 0)}
    good, bad = files.split_rejected(rows, "line")
    assert sorted((r.a or "", r.b or "") for r in good.collect()) == [("", ""), ("1", "2"), ("1", "2"), ("7", "8")]
    assert sorted(r.line for r in bad.collect()) == ["3", "4,5,6"]
    assert [r.path.rsplit("/", 1)[1] for r in files.unread_files(spark, f"{tmp_path}/*.csv", rows).collect()] == ["c.csv"]


def test_median_of_scenes_by_bracket_and_count(spark):
    import numpy as np

    g = np.random.default_rng(3)
    rows = [(1, s, dt.date(2023, 1, 1), float(r), float(e)) for s, n in ((1, 4001), (2, 4000), (3, 1), (4, 2)) for r, e in g.integers(1, 400, (n, 2))]
    px = spark.createDataFrame(rows, "location_id int, scene_id long, fecha date, red double, rededge1 double")
    got = {r.scene_id: r.valor for r in spectral.scene_medians(px, "NDCI").collect()}
    for s in (1, 2, 3, 4):
        assert got[s] == pytest.approx(np.median([(e - r) / (e + r) for _, i, _, r, e in rows if i == s]), abs=1e-15)
