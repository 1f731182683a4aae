"""Registered queries for the spectral index (SP), audits (A) and geometry audit/features (GEO2, GEO9)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.operators import audit, clean, load, spatial, spectral
from caudal.functions.geometry import parts_from_geojson, signed_area
from caudal.plans import surrogates as S
from caudal.plans.catalog import _Q13_BODY
from caudal.plans.catalog_ingest import CLAIMS_SQL, HOURLY_SQL, LAB_MIN_YEAR, LAB_SQL, _clean_lab, _hourly_with_pos
from caudal.plans.oracle import with_ctes
from caudal.plans.registry import R, register

DATE_FROM, DATE_TO = "2016-01-01", "2019-12-31"
HALF = 0.015

PIXELS_SQL = """
  SELECT e.label AS location_id, e.vec_id AS scene_id,
         CAST(DATE '2015-01-01' + CAST(e.vec_id * 3 % 2190 AS INTEGER) AS DATE) AS fecha,
         CAST((e.vec_id * 7) % 40 AS DOUBLE) AS cloud_cover,
         CAST(-58.4 AS DOUBLE) + CAST(e.label % 5 AS DOUBLE) + 0.52 + CAST((t.i % 5) - 2 AS DOUBLE) * 0.01 AS lon,
         CAST(-35.0 AS DOUBLE) + CAST(e.label // 5 AS DOUBLE) + 0.52 + CAST((t.i // 5) - 2 AS DOUBLE) * 0.01 AS lat,
         CAST((e.vec_id + t.i) % 8 AS INTEGER) AS scl,
         CAST(e.embedding[t.i * 3 + 1] AS DOUBLE) AS red, CAST(e.embedding[t.i * 3 + 2] AS DOUBLE) AS green,
         CAST(e.embedding[t.i * 3 + 3] AS DOUBLE) AS rededge1
  FROM embeddings e CROSS JOIN range(0, 21) t(i)"""

SELECTED_SQL = f"""
  SELECT * FROM ({PIXELS_SQL})
  WHERE fecha BETWEEN DATE '{DATE_FROM}' AND DATE '{DATE_TO}' AND cloud_cover < 20
    AND abs(lon - (CAST(-58.4 AS DOUBLE) + CAST(location_id % 5 AS DOUBLE) + 0.52)) <= {HALF}
    AND abs(lat - (CAST(-35.0 AS DOUBLE) + CAST(location_id // 5 AS DOUBLE) + 0.52)) <= {HALF}"""

MEDIANS_SQL = f"""
  SELECT location_id, scene_id, fecha, median((rededge1 - red) / (rededge1 + red)) AS valor
  FROM ({SELECTED_SQL}) WHERE scl = 6 AND rededge1 + red <> 0
  GROUP BY 1, 2, 3"""


def _bounds(spark, d):
    cent = spatial.polygon_centroids(S.sentinel_locations(spark, d), "location_id").select(
        "location_id", F.col("centroid_lon").alias("lon"), F.col("centroid_lat").alias("lat"))
    return spatial.bbox_polygons(cent, half_width=HALF)


def _selected(spark, d):
    return spectral.select_scenes(S.pixels(spark, d), _bounds(spark, d), DATE_FROM, DATE_TO)


@register("sp1_scene_selection", with_ctes([], f"""
SELECT location_id, COUNT(DISTINCT scene_id) AS escenas, COUNT(*) AS pixeles FROM ({SELECTED_SQL}) GROUP BY 1"""))
def sp1(spark, d):
    """SP1 scene selection (date range, cloud < 20) and pixels inside each location's bbox."""
    return _selected(spark, d).groupBy("location_id").agg(
        F.countDistinct("scene_id").alias("escenas"), F.count(F.lit(1)).alias("pixeles"))


@register("sp2_water_mask", with_ctes([], f"""
SELECT location_id, COUNT(*) AS pixeles_agua FROM ({SELECTED_SQL}) WHERE scl = 6 GROUP BY 1"""))
def sp2(spark, d):
    """SP2 water mask (scene class 6) over the selected pixels."""
    return spectral.water_mask(_selected(spark, d)).groupBy("location_id").agg(
        F.count(F.lit(1)).alias("pixeles_agua"))


@register("sp3_index_values", with_ctes([], f"""
SELECT location_id, scene_id, lon, lat,
       {R('CASE WHEN rededge1 + red <> 0 THEN (rededge1 - red) / (rededge1 + red) END')} AS ndci,
       {R('CASE WHEN red + green <> 0 THEN (red - green) / (red + green) END')} AS ndti
FROM ({SELECTED_SQL}) WHERE scl = 6"""))
def sp3(spark, d):
    """SP3 normalised-difference indices (NDCI, NDTI) per water pixel."""
    w = spectral.water_mask(_selected(spark, d))
    return w.select("location_id", "scene_id", "lon", "lat", spectral.index_value("NDCI").alias("ndci"),
                    spectral.index_value("NDTI").alias("ndti"))


@register("sp4_scene_medians", with_ctes([], f"""
SELECT location_id, scene_id, fecha, {R('valor')} AS valor FROM ({MEDIANS_SQL})"""))
def sp4(spark, d):
    """SP4 median NDCI per scene over water pixels (scenes without values dropped)."""
    return spectral.scene_medians(spectral.water_mask(_selected(spark, d)), "NDCI")


@register("sp5_index_load", with_ctes([], f"""
, m AS ({MEDIANS_SQL}),
loaded AS (SELECT n_nationkey AS location_id FROM nation WHERE n_regionkey = 1)
SELECT location_id, fecha AS fecha_inicio, {R('valor')} AS valor, scene_id AS pos
FROM m WHERE location_id NOT IN (SELECT location_id FROM loaded)"""))
def sp5(spark, d):
    """SP5 index job end to end: locations already loaded for the code skipped (LOAD5),
    rows keyed (KEY1) and inserted if absent (LOAD1)."""
    all_rows = spectral.index_rows(S.pixels(spark, d), _bounds(spark, d), "NDCI", DATE_FROM, DATE_TO)
    region1 = S.read(spark, d, "nation").filter(F.col("n_regionkey") == 1).select(
        F.col("n_nationkey").alias("location_id"))
    target = all_rows.join(region1, "location_id", "left_semi").select("id", "location_id", "code")
    new = spectral.load_index(S.pixels(spark, d), _bounds(spark, d), "NDCI", DATE_FROM, DATE_TO, target)
    return new.select("location_id", "fecha_inicio", "valor", "pos")


# ------------------------------------------------------------------ audits

_TABLE_COUNTS = {
    "oseparam": "oseparam", "reclamosose": "reclamos", "gemsparams": "gems", "registrotempprec": "registro",
    "puntomedicion": "grid", "sentinel_params": "sentinel",
}


@register("a01_row_counts", with_ctes(list(_TABLE_COUNTS.values()), """
, c AS (""" + "\n  UNION ALL ".join(f"SELECT '{k}' AS tabla, COUNT(*) AS registros FROM {v}"
                                     for k, v in _TABLE_COUNTS.items()) + """)
SELECT tabla, CAST(registros AS BIGINT) AS registros FROM c
UNION ALL SELECT 'TOTAL', CAST(SUM(registros) AS BIGINT) FROM c"""))
def a01(spark, d):
    """A01 row count per fact table plus TOTAL."""
    return audit.row_counts({
        "oseparam": S.oseparam(spark, d), "reclamosose": S.reclamosose(spark, d), "gemsparams": S.gemsparams(spark, d),
        "registrotempprec": S.registrotempprec(spark, d), "puntomedicion": S.puntomedicion(spark, d),
        "sentinel_params": S.sentinel_params(spark, d)})


_REASONS = {"reclamos": "reclamos repetidos", "inumet": "misma hora y estacion", "gems": "muestras repetidas"}


@register("a02_reconciliation", with_ctes(["gems", "registro"], f"""
, cl AS ({CLAIMS_SQL}),
h AS ({HOURLY_SQL}),
lb AS ({LAB_SQL}),
s(tarea, destino, origen, motivo) AS (
      SELECT 'reclamos', 'reclamosose', COUNT(*), '{_REASONS["reclamos"]}' FROM cl WHERE tipo_reclamo IS NOT NULL
      UNION ALL SELECT 'inumet', 'paraminumet', COUNT(*), '{_REASONS["inumet"]}' FROM h
      UNION ALL SELECT 'gems', 'gemsparams', COUNT(*), '{_REASONS["gems"]}' FROM lb
      UNION ALL SELECT 'estaciones', 'ubicaciones', COUNT(*), 'nuevas' FROM supplier
      UNION ALL SELECT 'registros', 'registrotempprec', NULL, 'sin archivo'),
t(destino, destino_n) AS (
      SELECT 'reclamosose', COUNT(*) FROM orders
      UNION ALL SELECT 'paraminumet', COUNT(*) FROM (SELECT DISTINCT user_id, date_trunc('hour', ts) FROM events)
      UNION ALL SELECT 'gemsparams', COUNT(*) FROM gems WHERE year(fecha_inicio) >= 1997 AND location_id % 9 <> 4
                                                         AND value IS NOT NULL
      UNION ALL SELECT 'registrotempprec', COUNT(*) FROM registro)
SELECT s.tarea, s.destino, s.origen, t.destino_n, s.origen - t.destino_n AS diferencia,
       CASE WHEN s.origen IS NULL THEN 'N/A' WHEN t.destino_n IS NULL THEN 'sin destino'
            WHEN s.origen < t.destino_n THEN s.motivo || ' (*)' ELSE s.motivo END AS motivo
FROM s LEFT JOIN t ON s.destino = t.destino"""))
def a02(spark, d):
    """A02 reconciliation: cleaned source rows against the loaded tables, which are counted on their own. Claims have
    fewer rows than the target, hourly rows more, lab rows as many; one target and one source are missing."""
    ev = S.read(spark, d, "events").select("user_id", F.date_trunc("hour", "ts").alias("h")).distinct()
    gems = S.gemsparams(spark, d).filter((F.year("fecha_inicio") >= 1997) & (F.col("location_id") % 9 != 4) & F.col("value").isNotNull())
    sources = {
        ("reclamos", "reclamosose"): clean.clean_claims(S.raw_claims(spark, d), min_year=1995),
        ("inumet", "paraminumet"): _hourly_with_pos(S.raw_hourly(spark, d)),
        ("gems", "gemsparams"): _clean_lab(spark, d),
    }
    targets = {"reclamosose": S.reclamosose(spark, d), "paraminumet": ev, "gemsparams": gems,
               "registrotempprec": S.registrotempprec(spark, d)}

    def counted(df, **names):
        return df.agg(F.count(F.lit(1)).alias("n")).select(*[F.lit(v).alias(k) for k, v in names.items()], "n")

    parts = [counted(df, tarea=t, destino=x, motivo=_REASONS[t]) for (t, x), df in sources.items()]
    parts.append(counted(S.estaciones(spark, d), tarea="estaciones", destino="ubicaciones", motivo="nuevas"))
    parts.append(spark.range(1).select(F.lit("registros").alias("tarea"), F.lit("registrotempprec").alias("destino"),
                                       F.lit("sin archivo").alias("motivo"), F.lit(None).cast("long").alias("n")))
    src = functools.reduce(DataFrame.unionByName, parts).withColumnRenamed("n", "origen")
    tgt = functools.reduce(DataFrame.unionByName, [counted(df, destino=x) for x, df in targets.items()])
    return audit.reconcile(src, tgt.withColumnRenamed("n", "destino_n"))


@register("a03_shared_target", with_ctes([], f"""
, e AS (SELECT h.*, event_type FROM ({HOURLY_SQL}) h JOIN events USING (event_id)),
s(destino, origen) AS (
  SELECT 'paraminumet', COUNT(*) FROM e WHERE event_type IN ('click', 'view')
  UNION ALL SELECT 'paraminumet', COUNT(*) FROM e WHERE event_type NOT IN ('click', 'view')
  UNION ALL SELECT 'reclamosose', COUNT(*) FROM ({CLAIMS_SQL}) WHERE tipo_reclamo IS NOT NULL
  UNION ALL SELECT 'reclamosose', 0
  UNION ALL SELECT 'grillas', NULL UNION ALL SELECT 'grillas', COUNT(*) FROM part
  UNION ALL SELECT 'nuevo', COUNT(*) FROM part),
t(destino, destino_n) AS (
  SELECT 'paraminumet', COUNT(*) FROM (SELECT DISTINCT estacion_id, fecha_inicio,
                                              event_type IN ('click', 'view') FROM e)
  UNION ALL SELECT 'reclamosose', COUNT(*) FROM orders
  UNION ALL SELECT 'grillas', COUNT(*) FROM part),
j AS (SELECT destino, CAST(SUM(origen) AS BIGINT) AS suma, bool_or(origen IS NULL) AS falta FROM s GROUP BY 1)
SELECT j.destino, CASE WHEN falta THEN NULL ELSE suma END AS origen, destino_n,
       CASE WHEN falta THEN NULL ELSE suma - destino_n END AS diferencia,
       CASE WHEN falta THEN 'N/A' WHEN destino_n IS NULL THEN 'sin destino' WHEN suma < destino_n THEN 'varias fuentes (*)'
            ELSE 'varias fuentes' END AS motivo
FROM j LEFT JOIN t ON j.destino = t.destino"""))
def a03(spark, d):
    """A03 reconciliation for shared targets: hourly precipitation and humidity (more than the target holds), claims
    (fewer), a group with a missing source, and one without a target."""
    ev = S.read(spark, d, "events").select("event_id", "event_type")
    h = _hourly_with_pos(S.raw_hourly(spark, d)).join(ev, F.col("pos") == F.col("event_id"))
    h = h.withColumn("code", F.when(F.col("event_type").isin("click", "view"), "PRECIPITACION").otherwise("HUMEDAD"))
    points = S.grid_points(spark, d)

    def counted(df, destino):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(destino).alias("destino"), "n")

    src = [counted(h.filter(F.col("code") == c), "paraminumet") for c in ("PRECIPITACION", "HUMEDAD")]
    claims = clean.clean_claims(S.raw_claims(spark, d), min_year=1995)
    src += [counted(claims, "reclamosose"), counted(claims.filter(F.lit(False)), "reclamosose"), counted(points, "grillas"),
            spark.range(1).select(F.lit("grillas").alias("destino"), F.lit(None).cast("long").alias("n")), counted(points, "nuevo")]
    tgt = [counted(h.select("estacion_id", "fecha_inicio", "code").distinct(), "paraminumet"),
           counted(S.reclamosose(spark, d), "reclamosose"), counted(points, "grillas")]
    src = functools.reduce(DataFrame.unionByName, src).withColumnRenamed("n", "origen").withColumn("motivo", F.lit("varias fuentes"))
    return audit.reconcile_shared(src, functools.reduce(DataFrame.unionByName, tgt).withColumnRenamed("n", "destino_n"))


def _claims_tagged(spark, d, min_year=1996):
    raw = S.raw_claims(spark, d).withColumn("fecha_inicio", clean.to_timestamp_lenient("fecha_ingreso"))
    return clean.tag_drop_reason(raw, clean.claim_rules(min_year))


_CLAIMS_RAW_SQL = """
  SELECT o.o_orderkey AS k, o.o_orderdate AS fecha, o.o_orderpriority AS pr,
         CASE WHEN o.o_orderkey % 50 = 7 THEN 'sin_datos' WHEN o.o_orderkey % 61 = 3 THEN 'fecha_invalida'
              WHEN year(o.o_orderdate) < 1996 THEN 'anterior_minimo'
              WHEN o.o_orderpriority = '5-LOW' AND o.o_orderkey % 2 = 0 THEN 'tipo_no_mapeado' END AS reason
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""


@register("a04_drop_accounting", with_ctes([], f"""
, r(limpiador, motivo) AS (
  SELECT 'reclamos', reason FROM ({_CLAIMS_RAW_SQL})
  UNION ALL SELECT 'inumet', CASE WHEN event_id % 97 = 0 THEN 'fecha nulo'
                                  WHEN event_type = 'error' THEN 'valor no numerico' END FROM events
  UNION ALL SELECT 'bacteriologia', CASE WHEN l_returnflag = 'N' AND l_linenumber % 3 = 0 THEN 'valor censurado' END
            FROM lineitem
  UNION ALL SELECT 'gems', CASE WHEN l_tax = 0 THEN 'valor no numerico' END FROM lineitem
            WHERE l_suppkey % 9 <> 4 AND year(l_shipdate) >= 1997
  UNION ALL SELECT 'precipitaciones', CASE WHEN l_tax = 0 THEN 'temperaturaMaxima nulo' END FROM lineitem
  UNION ALL SELECT 'suelos', CASE WHEN p_size > 45 THEN 'Factor_K nulo' END FROM part
  UNION ALL SELECT 'departamento de reclamo', CASE WHEN o_orderkey % 50 = 7 THEN 'sin departamento' END FROM orders)
SELECT limpiador, COALESCE(motivo, 'conservada') AS motivo, COUNT(*) AS filas FROM r GROUP BY 1, 2"""))
def a04(spark, d):
    """A04 drop accounting of every cleaner by its own rules, and of the department lookup."""
    lab = clean.select_lab_samples(S.raw_lab_samples(spark, d), min_year=LAB_MIN_YEAR)
    tagged = {
        "reclamos": _claims_tagged(spark, d),
        "inumet": clean.tag_drop_reason(S.raw_hourly(spark, d), clean.hourly_rules("precip_horario")),
        "bacteriologia": clean.tag_drop_reason(S.raw_ose_samples(spark, d), clean.quarterly_rules()),
        "gems": clean.tag_drop_reason(lab, clean.lab_rules()),
        "precipitaciones": clean.tag_drop_reason(S.raw_daily(spark, d), clean.daily_rules()),
        "suelos": clean.tag_drop_reason(S.raw_areas(spark, d), clean.soil_rules()),
    }
    found, lost = load.lookup_dimension(S.raw_claims(spark, d), S.departamentos(spark, d), "departamento", "nombre",
                                        "departamento_id", "departamento_id", normalize=True)
    tagged["departamento de reclamo"] = found.select(F.lit(None).cast("string").alias("reason")).unionByName(
        lost.select(F.lit("sin departamento").alias("reason")))
    parts = [audit.drop_accounting(df).select(F.lit(name).alias("limpiador"), "motivo", "filas") for name, df in tagged.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@register("a05_claims_by_year", with_ctes([], f"""
SELECT CAST(CASE WHEN k % 61 = 3 THEN NULL ELSE year(fecha) END AS INTEGER) AS anio,
       CAST(SUM(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS conservadas,
       CAST(SUM(CASE WHEN reason IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS descartadas
FROM ({_CLAIMS_RAW_SQL}) GROUP BY 1"""))
def a05(spark, d):
    """A05 claims audit: rows per year kept / dropped (bad dates have no year and count under null)."""
    return audit.rows_by_year(_claims_tagged(spark, d), "fecha_inicio")


@register("a05_unmapped_categories", with_ctes([], """
SELECT 'Tipo Desconocido' AS tipo_reclamo_comercial, COUNT(*) AS n FROM orders
WHERE o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0"""))
def a05u(spark, d):
    """A05 unmapped claim categories by frequency."""
    raw = S.raw_claims(spark, d)
    return audit.unmapped_categories(raw, "tipo_reclamo_comercial", clean.claim_type("tipo_reclamo_comercial"))


def _lab_with_file(spark, d):
    raw = S.raw_lab_samples(spark, d)
    return raw.withColumn("archivo", F.when(F.col("Parameter Code") == "pH", "pH.csv")
                          .otherwise("Indicator_Organism.csv"))


@register("a06_files_per_code", with_ctes([], """
SELECT code, string_agg(archivo, ',' ORDER BY archivo) AS archivos FROM (
  SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'TOTCOLI' WHEN 'N' THEN 'ECOLI' ELSE 'pH' END AS code,
         CASE WHEN l_returnflag = 'R' THEN 'pH.csv' ELSE 'Indicator_Organism.csv' END AS archivo FROM lineitem)
GROUP BY 1"""))
def a06(spark, d):
    """A06 which file holds which parameter code."""
    r = audit.files_per_code(_lab_with_file(spark, d).withColumnRenamed("Parameter Code", "code"), "code", "archivo")
    return r.select("code", F.array_join("archivos", ",").alias("archivos"))


@register("a07_parameter_coverage", with_ctes([], f"""
, c AS (SELECT CASE WHEN code = 'pH' THEN NULL ELSE code END AS code, "GEMS Station Number" AS st,
               CASE WHEN depth > 2 THEN 'hondo.csv' ELSE 'somero.csv' END AS archivo FROM ({LAB_SQL})),
p AS (SELECT code, archivo, COUNT(*) AS n, COUNT(DISTINCT st) AS e FROM c GROUP BY 1, 2)
SELECT code, CAST(SUM(n) AS BIGINT) AS filas, CAST(SUM(e) AS BIGINT) AS estaciones,
       CASE code WHEN 'TOTCOLI' THEN 'Total Coliforms' END AS nombre FROM p GROUP BY 1
UNION ALL SELECT 'Total', COUNT(*), COUNT(DISTINCT st), NULL FROM c""".replace("WITH \n,", "WITH")))
def a07(spark, d):
    """A07 parameter coverage: rows and stations per code (stations summed over files, a null code among them) with the
    parameter's name, plus a Total row."""
    lab = _clean_lab(spark, d).withColumn("archivo", F.when(F.col("depth") > 2, "hondo.csv").otherwise("somero.csv"))
    lab = lab.withColumn("code", F.when(F.col("code") != "pH", F.col("code")))
    names = spark.createDataFrame([("TOTCOLI", "Total Coliforms"), ("X", "unused")], "code string, nombre string")
    return audit.parameter_coverage(lab, "code", "GEMS Station Number", file="archivo", names=names)


_LAB_COLS = ["GEMS Station Number", "Sample Date", "Sample Time", "Parameter Code", "Value Flags", "Value"]


@register("a08_null_profile", with_ctes([], """
SELECT * FROM (VALUES ('GEMS Station Number', 0), ('Sample Date', 0), ('Parameter Code', 0), ('Value', 0)) t(columna, nulos)
UNION ALL SELECT 'Sample Time', COUNT(*) FILTER (WHERE l_linenumber % 2 = 0) FROM lineitem
UNION ALL SELECT 'Value Flags', COUNT(*) FROM lineitem""".replace("WITH \n", "")))
def a08(spark, d):
    """A08 null count per column of the raw lab samples (one aggregate pass)."""
    r = audit.null_profile(S.raw_lab_samples(spark, d), _LAB_COLS)
    return r.select("columna", F.col("nulos").cast("long").alias("nulos"))


@register("a08_null_pairs", with_ctes([], """
, base AS (SELECT COUNT(*) FILTER (WHERE l_linenumber % 2 = 0) AS t FROM lineitem),
cols AS (SELECT * FROM (VALUES (0, 'GEMS Station Number'), (1, 'Sample Date'), (2, 'Sample Time'),
                               (3, 'Parameter Code'), (4, 'Value Flags'), (5, 'Value')) v(i, c))
SELECT a.c AS columna_a, b.c AS columna_b,
       CAST(CASE WHEN (a.c = 'Sample Time' AND b.c = 'Value Flags') OR (a.c = 'Value Flags' AND b.c = 'Sample Time')
                 THEN (SELECT t FROM base) ELSE 0 END AS BIGINT) AS ambos_nulos
FROM cols a JOIN cols b ON a.i < b.i""".replace("WITH \n,", "WITH")))
def a08p(spark, d):
    """A08 null co-occurrence of column pairs of the raw lab samples."""
    r = audit.null_pairs(S.raw_lab_samples(spark, d), _LAB_COLS)
    return r.select("columna_a", "columna_b", F.col("ambos_nulos").cast("long").alias("ambos_nulos"))


@register("a09_duplicate_names", with_ctes([], """
SELECT p_brand AS NOMBRE, COUNT(*) AS n FROM part WHERE p_size % 10 <> 0 GROUP BY 1 HAVING COUNT(*) > 1""".replace(
    "WITH \n", "")))
def a09(spark, d):
    """A09 duplicate watershed names report."""
    return audit.duplicate_names(S.raw_areas(spark, d), "NOMBRE")


@register("a10_distinct_values", with_ctes([], """
SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1""".replace("WITH \n", "")))
def a10(spark, d):
    """A10 distinct values of a column with counts."""
    return audit.distinct_values(S.read(spark, d, "events"), "event_type")


@register("a11_keyword_search", with_ctes([], """
SELECT p_partkey, p_name FROM part
WHERE contains(lower(p_name), 'blue') OR contains(lower(p_name), 'gear')""".replace("WITH \n", "")))
def a11(spark, d):
    """A11 case-insensitive keyword search (contains) over parameter names."""
    return audit.keyword_search(S.read(spark, d, "part"), "p_name", ["BLUE", "Gear"]).select("p_partkey", "p_name")


@register("a11_prefix_search", with_ctes([], """
SELECT p_partkey, p_name FROM part WHERE starts_with(lower(p_name), 'small')""".replace("WITH \n", "")))
def a11p(spark, d):
    """A11 case-insensitive prefix search over parameter names."""
    return audit.keyword_search(S.read(spark, d, "part"), "p_name", ["Small"], mode="prefix").select(
        "p_partkey", "p_name")


# ------------------------------------------------------------------ GEO2 geometry audit, GEO9 features

def _features(spark, d):
    dep = S.departamentos(spark, d)
    k = F.col("departamento_id")
    ring = F.element_at("rings", 1)
    kind = k % 4
    return dep.select(
        "departamento_id",
        F.when(kind == 0, "Polygon").when(kind == 3, "Point").otherwise("LineString").alias("gtype"),
        F.when(kind == 1, ring).when(kind == 2, F.slice(ring, 1, F.size(ring) - 1))
        .when(kind == 3, F.slice(ring, 1, 1)).alias("coords"),
        F.when(kind == 0, F.col("rings")).alias("rings"))


_VERTICES = ", ".join(f"({s}, {i}, {x}, {y})" for s, pts in S.SHAPES.items() for i, (x, y) in enumerate(pts))


@register("geo2_geometry_audit", with_ctes(["deptos"], f"""
, v(shape, i, x, y) AS (VALUES {_VERTICES}),
-- a directed pair of vertices is an edge of the hull if all others lie to its left
hull AS (SELECT a.shape, COUNT(*) AS n, SUM(a.x * b.y - b.x * a.y) / 2 AS area FROM v a JOIN v b ON a.shape = b.shape AND a.i <> b.i
         WHERE NOT EXISTS (SELECT 1 FROM v c WHERE c.shape = a.shape AND c.i <> a.i AND c.i <> b.i
                           AND (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) <= 0) GROUP BY 1),
ring AS (SELECT a.shape, COUNT(*) AS n, ABS(SUM(a.x * b.y - b.x * a.y)) / 2 AS area FROM v a JOIN v b ON a.shape = b.shape
           AND b.i = (a.i + 1) % (SELECT COUNT(*) FROM v c WHERE c.shape = a.shape) GROUP BY 1)
SELECT departamento_id,
       CASE departamento_id % 4 WHEN 0 THEN 'ok' WHEN 3 THEN 'failed' ELSE 'convertible' END AS status,
       CASE departamento_id % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'close_ring' WHEN 2 THEN 'convex_hull' ELSE 'reject' END
         AS action,
       CAST(CASE departamento_id % 4 WHEN 1 THEN ring.n + 1 WHEN 2 THEN hull.n + 1 END AS INTEGER) AS n_vertices,
       {R('CASE departamento_id % 4 WHEN 1 THEN ring.area WHEN 2 THEN hull.area END')} AS area
FROM deptos JOIN hull USING (shape) JOIN ring USING (shape)"""))
def geo2(spark, d):
    """GEO2 geometry audit/repair: polygons pass, closed lines close, open lines -> convex hull, points rejected; with the
    repaired ring's vertices and area."""
    c = spatial.classify_geometries(_features(spark, d), "departamento_id")
    ring = F.element_at("repaired_rings", 1)
    return c.select("departamento_id", "status", "action",
                    F.when(F.col("repaired_rings").isNotNull(), F.size(ring)).alias("n_vertices"),
                    F.when(F.col("repaired_rings").isNotNull(), F.abs(signed_area(ring))).alias("area"))


_FIRST_X, _FIRST_Y = ("CASE shape " + " ".join(f"WHEN {k} THEN {p[0][i]}" for k, p in S.SHAPES.items()) + " END" for i in (0, 1))


@register("geo9_feature_rows", with_ctes(["deptos", "station_depto", "gems"], f"""
, p AS ({_Q13_BODY})
SELECT d.nombre, {R('p.val_gems')} AS val_gems,
       CASE WHEN p.val_gems IS NULL THEN NULL
            ELSE CAST(row_number() OVER (ORDER BY p.val_gems DESC NULLS LAST, d.nombre) AS INTEGER) END AS ranking,
       CASE WHEN p.val_gems IS NULL THEN 'Sin datos' ELSE printf('%.2f', p.val_gems) END AS etiqueta,
       CASE WHEN d.departamento_id % 3 = 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS tipo,
       CAST(CASE d.departamento_id % 3 WHEN 2 THEN 2 ELSE 1 END AS INTEGER) AS partes,
       CAST(CASE d.departamento_id % 3 WHEN 0 THEN 0 ELSE 1 END AS INTEGER) AS huecos,
       CASE WHEN d.departamento_id % 3 = 0 THEN NULL ELSE x0 + CASE shape WHEN 3 THEN 0.74 ELSE 0.4 END END AS hueco_lon0,
       CASE shape WHEN 2 THEN 7 ELSE 5 END AS vertices, x0 + {_FIRST_X} AS lon0, y0 + {_FIRST_Y} AS lat0
FROM deptos d LEFT JOIN p ON d.nombre = p.nombre"""))
def geo9(spark, d):
    """GEO9 feature assembly: department polygons left-joined with the lab contamination metric
    (departments without stations -> 'Sin datos'), ranked, one GeoJSON feature text per row."""
    from caudal.plans.catalog import _q13
    feats = spatial.feature_rows(S.areas(spark, d), _q13(spark, d), "nombre", "val_gems", geometry="parts", gtype="gtype")
    f = F.from_json("feature", "struct<id:string,geometry:struct<type:string,coordinates:string>>")
    kind, text = f["geometry"]["type"], f["geometry"]["coordinates"]
    parts = parts_from_geojson(kind, text)
    outer, holes = parts[0][0], F.flatten(F.transform(parts, lambda rings: F.slice(rings, 2, F.size(rings))))
    return feats.select(f["id"].alias("nombre"), "val_gems", F.col("ranking").cast("int").alias("ranking"), "etiqueta", kind.alias("tipo"),
                        F.size(parts).alias("partes"), F.size(holes).alias("huecos"),
                        F.get(F.get(holes, F.lit(0)), F.lit(0))["lon"].alias("hueco_lon0"),
                        F.size(outer).alias("vertices"), outer[0]["lon"].alias("lon0"), outer[0]["lat"].alias("lat0"))
