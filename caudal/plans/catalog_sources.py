"""Registered queries for sources and sinks (SRC1-SRC9) and the staged-series load (LOAD7).

Each query first writes files derived from the driver tables into a fresh folder
under the shared checkpoint directory (the cluster's shared storage), then reads
them back through the reader under test, so the round trip is what is checked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from caudal.functions.ids import stable_id
from caudal.operators import clean, load, ndci, quality
from caudal.functions.geometry import oriented_rings, signed_area
from caudal.plans import surrogates as S
from caudal.plans.catalog_ingest import CLAIMS_SQL
from caudal.plans.oracle import with_ctes
from caudal.plans.registry import Y0, Y1, R, register
from caudal.session import scratch_path
from caudal.sources import files


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"sources/{name}-{uuid.uuid4().hex[:12]}")


CLAIM_COLS = ["region", "departamento", "fecha_ingreso", "tipo_reclamo_comercial", "id_reclamo_comercial_m", "extra"]


@register("src1_delimited_latin1", with_ctes([], f"""
SELECT departamento, tipo_reclamo, COUNT(*) AS n FROM ({CLAIMS_SQL}) WHERE tipo_reclamo IS NOT NULL GROUP BY 1, 2"""
                                             .replace("WITH \n", "")))
def src1(spark, d):
    """SRC1 ``;`` + Latin-1 delimited scan (claims file round trip, accents and mojibake kept), then CLN12/13."""
    path = _scratch(spark, "claims")
    raw = S.raw_claims(spark, d)
    raw.write.option("header", "true").option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    back = files.read_delimited(spark, path, CLAIM_COLS, "semicolon_latin1")
    c = clean.clean_claims(back, min_year=1995)
    return c.groupBy("departamento", "tipo_reclamo").agg(F.count(F.lit(1)).alias("n"))


@register("src1_rejected_lines", with_ctes([], """
SELECT c_nationkey AS archivo, COUNT(*) AS filas, COUNT(*) FILTER (WHERE o_orderkey % 41 IN (5, 6)) AS rechazadas,
       COUNT(*) FILTER (WHERE o_orderkey % 41 NOT IN (5, 6) AND o_orderkey % 50 <> 7 AND o_orderkey % 61 <> 3
                        AND NOT (o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0)) AS conservadas
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""".replace("WITH \n", "")))
def src1_rejected(spark, d):
    """SRC1 + A04 lines of each claims file, those that are malformed (a field short or over), and what the cleaner keeps."""
    path = _scratch(spark, "claims_lines")
    o = S.read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id_reclamo_comercial_m"), "o_custkey")
    c = S.read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("archivo"))
    raw = S.raw_claims(spark, d).join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), "id_reclamo_comercial_m")
    k = F.col("id_reclamo_comercial_m").cast("long") % 41
    fields = [F.regexp_replace(F.coalesce(F.col(x), F.lit("")), r"[\r\t]", "") for x in CLAIM_COLS]
    line = F.when(k == 5, F.concat_ws(";", *fields[:-1])).when(k == 6, F.concat_ws(";", *fields, F.lit("y"))).otherwise(F.concat_ws(";", *fields))
    raw.select("archivo", line.alias("value")).write.partitionBy("archivo").text(path)
    back = files.read_delimited(spark, path, CLAIM_COLS, "semicolon_utf8", header=False, with_path=True, rejected="linea")
    file = F.regexp_extract("source_file", r"archivo=(\d+)", 1).cast("int")
    back = back.withColumn("archivo", file)
    good, _ = files.split_rejected(back, "linea")
    tagged = clean.tag_drop_reason(good, clean.claim_rules(1995)).filter("reason IS NULL").groupBy("archivo").agg(
        F.count(F.lit(1)).alias("conservadas"))
    return files.line_counts(back, "linea", "archivo").join(tagged, "archivo", "left").select(
        "archivo", "filas", "rechazadas", F.coalesce("conservadas", F.lit(0)).alias("conservadas"))


@register("src2_multi_file_union", with_ctes([], """
SELECT CASE WHEN event_type = 'signup' THEN 'humedad' ELSE 'precip' END AS tipo, COUNT(*) AS filas,
       COUNT(*) FILTER (WHERE event_type NOT IN ('signup')) AS con_precip,
       COUNT(*) FILTER (WHERE event_type = 'signup') AS con_humedad
FROM events GROUP BY 1""".replace("WITH \n", "")))
def src2(spark, d):
    """SRC2 several globs with different columns into one frame; the file kind comes from the path."""
    base = _scratch(spark, "hourly")
    raw = S.raw_hourly(spark, d).join(S.read(spark, d, "events").select("event_id", "event_type"), "event_id")
    raw.filter(F.col("event_type") != "signup").select("fecha", "estacion_id", "precip_horario") \
        .write.option("header", "true").csv(f"{base}/precip")
    raw.filter(F.col("event_type") == "signup").select(
        "fecha", "estacion_id", F.col("precip_horario").alias("hum_relativa")) \
        .write.option("header", "true").csv(f"{base}/humedad")
    u = files.read_many(spark, [(f"{base}/precip/*.csv", ["fecha", "estacion_id", "precip_horario"]),
                                (f"{base}/humedad/*.csv", ["fecha", "estacion_id", "hum_relativa"])],
                        attribute="tipo", pattern=r"/(precip|humedad)/")
    return u.groupBy("tipo").agg(F.count(F.lit(1)).alias("filas"),
                                 F.count("precip_horario").alias("con_precip"),
                                 F.count("hum_relativa").alias("con_humedad"))


_DEPT_FEATURES_SQL = """
SELECT nombre AS admlnm, lpad(CAST(departamento_id AS VARCHAR), 2, '0') AS admlcd,
       CASE departamento_id % 3 WHEN 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS gtype,
       CAST(CASE shape WHEN 2 THEN 7 ELSE 5 END + CASE departamento_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 5 ELSE 10 END AS INTEGER) AS n_vertices,
       CAST(CASE departamento_id % 3 WHEN 2 THEN 2 ELSE 1 END AS INTEGER) AS n_parts,
       CAST(departamento_id % 3 + 1 AS INTEGER) AS n_rings,
       {min_lon} AS min_lon, {max_lat} AS max_lat, {area} AS area, TRUE AS same
FROM deptos"""


def _dept_features_sql():
    min_lon = R("x0 + CASE WHEN departamento_id % 3 = 2 THEN 0.01 ELSE CASE shape WHEN 0 THEN 0.1 WHEN 1 THEN 0.05 WHEN 2 THEN 0.1 ELSE 0.72 END END")
    max_lat = R("y0 + CASE shape WHEN 0 THEN 0.9 WHEN 1 THEN 0.95 WHEN 2 THEN 0.9 ELSE 0.8 END")
    area = R("CASE shape WHEN 0 THEN 0.88 WHEN 1 THEN 0.405 WHEN 2 THEN 0.48 ELSE 0.0064 END"
             " - CASE WHEN departamento_id % 3 = 0 THEN 0 WHEN shape = 3 THEN 0.0016 ELSE 0.0036 END"
             " + CASE WHEN departamento_id % 3 = 2 THEN 0.0009 ELSE 0 END")
    return with_ctes(["deptos"], _DEPT_FEATURES_SQL.format(min_lon=min_lon, max_lat=max_lat, area=area))


def _dept_features(spark, d):
    return S.areas(spark, d).select(F.col("nombre").alias("admlnm"), F.col("codigo").alias("admlcd"), "gtype", "parts")


def _feature_summary(spark, d, df):
    """What was read, with its area and whether it equals what was written."""
    pts = F.flatten("rings")
    area = F.aggregate(oriented_rings(F.col("parts")), F.lit(0.0), lambda a, r: a + signed_area(r))
    written = _dept_features(spark, d).select("admlcd", F.col("parts").alias("written"))
    return df.join(written, "admlcd").select(
        "admlnm", "admlcd", "gtype", F.size(pts).alias("n_vertices"), F.size("parts").alias("n_parts"),
        F.size("rings").alias("n_rings"),
        F.array_min(F.transform(pts, lambda p: p["lon"])).alias("min_lon"),
        F.array_max(F.transform(pts, lambda p: p["lat"])).alias("max_lat"),
        area.alias("area"), (F.col("parts") == F.col("written")).alias("same"))


@register("src3_geojson_collection", _dept_features_sql())
def src3(spark, d):
    """SRC3 GeoJSON FeatureCollection -> one row per feature (properties, parts with holes)."""
    path = _scratch(spark, "deptos_fc")
    files.write_feature_collections(_dept_features(spark, d), path, ["admlnm", "admlcd"])
    back = files.read_geojson_collection(spark, path, ["admlnm", "admlcd"])
    return _feature_summary(spark, d, back)


@register("src4_geojson_lines", _dept_features_sql())
def src4(spark, d):
    """SRC4 newline-delimited GeoJSON features."""
    path = _scratch(spark, "deptos_nl")
    files.write_feature_lines(_dept_features(spark, d), path, ["admlnm", "admlcd"])
    back = files.read_geojson_lines(spark, path, ["admlnm", "admlcd"])
    return _feature_summary(spark, d, back)


@register("src5_json_array", with_ctes(["estaciones"], f"""
SELECT nombre, {R('lat')} AS latitud, {R('lon')} AS longitud FROM estaciones"""))
def src5(spark, d):
    """SRC5 JSON array station records (one array document per writer partition)."""
    path = _scratch(spark, "stations_json")
    st = S.estaciones(spark, d).select("nombre", F.col("lat").alias("latitud"), F.col("lon").alias("longitud"))
    files.write_json_arrays(st, path)
    return files.read_json_array(spark, path, "nombre string, latitud double, longitud double")


@register("src6_sidecar_coords", with_ctes([], f"""
SELECT r_name AS estacion, {R('-35.0 + r_regionkey * 0.5')} AS lat, {R('-58.4 + r_regionkey')} AS lon FROM region"""
                                           .replace("WITH \n", "")))
def src6(spark, d):
    """SRC6 per-station side-car ``lon, lat`` files; station name from the directory."""
    path = _scratch(spark, "coords")
    r = S.read(spark, d, "region")
    txt = r.select(F.col("r_name").alias("estacion"), F.concat(
        (F.lit(-58.4) + F.col("r_regionkey")).cast("string"), F.lit(", "),
        (F.lit(-35.0) + F.col("r_regionkey") * 0.5).cast("string")).alias("value"))
    txt.write.partitionBy("estacion").text(path)
    return files.read_sidecar_coords(spark, f"{path}/*/*.txt")


@register("src7_code_file_map", with_ctes([], """
SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'TOTCOLI' WHEN 'N' THEN 'ECOLI' ELSE 'pH' END AS code,
       CASE WHEN l_returnflag = 'R' THEN 'pH.csv' ELSE 'Indicator_Organism.csv' END AS file
FROM lineitem""".replace("WITH \n", "")))
def src7(spark, d):
    """SRC7 code -> file list JSON map (first file of each list), built from the codes present."""
    path = _scratch(spark, "codemap")
    raw = S.raw_lab_samples(spark, d).select("Parameter Code").distinct()
    lists = raw.select(F.col("Parameter Code").alias("code"), F.when(
        F.col("Parameter Code") == "pH", F.array(F.lit("pH.csv"), F.lit("Optical.csv"))).otherwise(
        F.array(F.lit("Indicator_Organism.csv"), F.lit("Water.csv"))).alias("files"))
    # one JSON object for the whole map: bounded by the number of parameter codes
    obj = lists.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("code", "files")))).alias("value"))
    obj.write.text(path)
    return files.read_code_file_map(spark, path)


@register("src8_report_csv", with_ctes(["deptos", "reclamos"], f"""
SELECT d.nombre, CAST(COUNT(*) AS VARCHAR) AS total_reclamos
FROM reclamos r JOIN deptos d ON r.departamento_id = d.departamento_id
WHERE year(r.fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY d.nombre"""))
def src8(spark, d):
    """SRC8 report export with a header row (claims per department), read back as text columns."""
    path = _scratch(spark, "report")
    rep = quality.claims_by_department(S.reclamosose(spark, d), S.departamentos(spark, d), Y0, Y1)
    files.write_report_csv(rep, path)
    return files.read_delimited(spark, path, ["nombre", "total_reclamos"], "comma")


@register("src9_fact_sink", with_ctes(["oseparam"], """
SELECT departamento_id, COUNT(*) AS n FROM oseparam
WHERE code = 'COLIFORMES TOTALES' AND year(fecha_inicio) = 1997 GROUP BY 1"""))
def src9(spark, d):
    """SRC9 fact sink partitioned by (code, anio), read back with partition pruning."""
    path = _scratch(spark, "oseparam")
    facts = S.oseparam(spark, d).withColumn("anio", F.year("fecha_inicio"))
    files.write_facts(facts, path, ["code", "anio"], mode="overwrite", sort_within=["departamento_id", "fecha_inicio"])
    back = spark.read.parquet(path).filter((F.col("code") == "COLIFORMES TOTALES") & (F.col("anio") == 1997))
    return back.groupBy("departamento_id").agg(F.count(F.lit(1)).alias("n"))


@register("src9_whole_sink", with_ctes(["oseparam"], """
SELECT code, CAST(year(fecha_inicio) AS INTEGER) AS anio, departamento_id, COUNT(*) AS n, COUNT(value_cat) AS con_valor
FROM oseparam GROUP BY 1, 2, 3"""))
def src9_whole(spark, d):
    """SRC9 fact sink: every partition read back."""
    path = _scratch(spark, "oseparam")
    facts = S.oseparam(spark, d).withColumn("anio", F.year("fecha_inicio"))
    files.write_facts(facts, path, ["code", "anio"], mode="overwrite")
    return spark.read.parquet(path).groupBy("code", "anio", "departamento_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("value_cat").alias("con_valor"))


@register("load7_staged_series", with_ctes(["sentinel"], f"""
, m AS (SELECT location_id, CAST(date_trunc('month', fecha_inicio) AS DATE) AS fecha, AVG(value) AS valor
        FROM sentinel WHERE code = 'NDCI' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1, 2)
SELECT m.location_id, m.fecha AS fecha_inicio, m.fecha AS fecha_fin, {R('m.valor')} AS valor, 'DIA' AS granularidad
FROM m JOIN nation n ON m.location_id = n.n_nationkey WHERE n.n_regionkey <> 1"""))
def load7(spark, d):
    """LOAD7 staged series: (fecha, valor) CSV files per water body name -> name from the path ->
    id lookup (LOAD4) -> keyed ``DIA`` rows (KEY1) -> insert-if-absent (LOAD1); bodies of one
    region were loaded before."""
    path = _scratch(spark, "staged")
    idx = ndci.monthly_index(S.sentinel_params(spark, d), Y0, Y1, out="valor")
    locs = S.sentinel_locations(spark, d)
    staged = idx.join(locs.select("location_id", "nombre"), "location_id").select(
        "nombre", F.col("periodo").cast("string").alias("fecha"), F.col("valor").cast("string").alias("valor"))
    staged.write.partitionBy("nombre").option("header", "true").csv(path)
    back = files.read_delimited(spark, f"{path}/*/*.csv", ["fecha", "valor"], "comma", with_path=True)
    back = back.withColumn("nombre", F.url_decode(F.regexp_extract("source_file", r"nombre=([^/]+)/", 1)))
    matched, _ = load.lookup_dimension(back, locs, "nombre", "nombre", "location_id", "location_id")
    rows = matched.select("location_id", F.to_date("fecha").alias("fecha_inicio"), F.to_date("fecha").alias("fecha_fin"),
                          clean.to_number("valor").alias("valor"), F.lit("DIA").alias("granularidad"))
    rows = rows.withColumn("id", stable_id("location_id", F.lit("NDCI"), "fecha_inicio", "fecha_fin", "valor",
                                           "granularidad")).withColumn("pos", F.lit(0))
    region1 = S.read(spark, d, "nation").filter(F.col("n_regionkey") == 1).select(
        F.col("n_nationkey").alias("location_id"))
    existing = rows.join(region1, "location_id", "left_semi").select("id")
    new = load.insert_if_absent(rows, existing)
    return new.select("location_id", "fecha_inicio", "fecha_fin", "valor", "granularidad")
