"""Registered queries for ingest: cleaners (CLN), keys (KEY), load semantics (LOAD)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from caudal.functions.date_shapes import shape_counts, with_day_first
from caudal.functions.ids import stable_id
from caudal.functions.text import strip
from caudal.operators import clean, keys, load, tables
from caudal.plans import surrogates as S
from caudal.plans.oracle import with_ctes
from caudal.plans.registry import QUERIES, R, register
from caudal.session import scratch_path

# ------------------------------------------------------------------ oracle pieces

UUID_SQL = ("substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            "substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


def uuid_sql(*parts: str) -> str:
    """Oracle twin of KEY1: md5 of the parts' text joined by '|' (null -> 'None')."""
    payload = " || '|' || ".join(f"COALESCE(CAST({p} AS VARCHAR), 'None')" for p in parts)
    return UUID_SQL.format(h=f"md5({payload})")


HOURLY_SQL = """
  SELECT event_id, 'S' || CAST(user_id AS VARCHAR) AS estacion_id, date_trunc('hour', ts) AS fecha_inicio,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS fecha_fin, value
  FROM events WHERE event_id % 97 <> 0 AND event_type <> 'error'"""

CLAIMS_SQL = """
  SELECT CASE WHEN c.c_nationkey % 2 = 0 THEN 'Norte' ELSE 'Sur' END AS region, n.n_name AS departamento,
         CAST(o.o_orderkey AS VARCHAR) AS id_reclamo_comercial_m,
         CAST(CAST(o.o_orderdate AS DATE) AS TIMESTAMP) AS fecha_inicio,
         CAST(CAST(o.o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS fecha_fin,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'ALTO_CONSUMO' WHEN '2-HIGH' THEN 'ERROR_ESTIMACION'
              WHEN '3-MEDIUM' THEN 'DENUNCIA_NOTIFICACION_FACTURAS' WHEN '4-NOT SPECIFIED' THEN 'ERROR_LECTURA'
              ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE 'VARIOS' END END AS tipo_reclamo,
         c.c_nationkey AS departamento_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderkey % 50 <> 7 AND o.o_orderkey % 61 <> 3"""

LAB_SQL = """
  SELECT 'URY' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS "GEMS Station Number",
         CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)
              ELSE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_hours(l_linenumber + 7) + INTERVAL 30 MINUTE
         END AS fecha_inicio,
         CASE l_returnflag WHEN 'A' THEN 'TOTCOLI' WHEN 'N' THEN 'ECOLI' ELSE 'pH' END AS code,
         CASE WHEN l_returnflag = 'R' THEN 'dimensionless' ELSE 'mg/l' END AS unit,
         'Good' AS data_quality,
         CAST(l_quantity AS FLOAT) AS value,
         CAST(l_linenumber * 0.5 AS FLOAT) AS depth
  FROM lineitem
  WHERE l_suppkey % 9 <> 4 AND year(l_shipdate) >= 1997 AND l_tax <> 0"""

LAB_MIN_YEAR = 1997


def _clean_lab(spark, d):
    raw = S.raw_lab_samples(spark, d)
    return clean.clean_lab_samples(clean.select_lab_samples(raw, min_year=LAB_MIN_YEAR))


# ------------------------------------------------------------------ cleaners

@register("cln1_normalize_names", with_ctes([], """
SELECT DISTINCT departamento, lower(trim(strip_accents(departamento), ' ' || chr(9) || chr(13) || chr(160))) AS nombre_norm
FROM (SELECT CASE l.l_linenumber % 5 WHEN 0 THEN ' ' || lower(n.n_name) WHEN 1 THEN n.n_name WHEN 2 THEN n.n_name || chr(9)
             WHEN 3 THEN list_aggregate(list_transform(string_split(n.n_name, ' '), lambda w: upper(w[1]) || lower(w[2:])),
                                        'string_agg', ' ') || chr(160)
             ELSE translate(n.n_name, 'AEIOUC', 'ÁÈÎÕÜḈ') || chr(13) END AS departamento
      FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)""".replace(
    "WITH \n", "")))
def cln1(spark, d):
    """CLN1 name normaliser over the raw sample department names."""
    raw = S.raw_ose_samples(spark, d).select("departamento").distinct()
    return clean.with_normalized(raw, "departamento")


@register("cln2_hourly_clean", with_ctes([], f"""
SELECT estacion_id, fecha_inicio, fecha_fin, {R('value')} AS value, 'PRECIPITACION' AS code, 'HORA' AS granularidad
FROM ({HOURLY_SQL})""".replace("WITH \n", "")))
def cln2(spark, d):
    """CLN2 + CLN3 hourly series cleaner (null keys, trims, coercion, one-hour interval)."""
    return clean.clean_hourly(S.raw_hourly(spark, d), "precip_horario", "PRECIPITACION")


@register("cln5_quarterly_clean", with_ctes(["oseparam"], """
SELECT departamento_id, code, value_cat, fecha_inicio, fecha_fin, 'TRIMESTRE' AS granularidad FROM (
  SELECT s.s_nationkey AS departamento_id,
         CASE WHEN l.l_linestatus = 'F' THEN 'COLIFORMES TOTALES' ELSE 'COLIFORMES FECALES' END AS code,
         CASE WHEN l.l_returnflag = 'R' THEN 'Presencia' WHEN l.l_returnflag = 'A' THEN 'Ausencia'
              WHEN l.l_linenumber % 3 = 1 THEN NULL ELSE 'Indeterminado' END AS value_cat,
         CAST(date_trunc('quarter', l.l_shipdate) AS TIMESTAMP) AS fecha_inicio,
         CAST(last_day(CAST(date_trunc('quarter', l.l_shipdate) + INTERVAL 2 MONTH AS DATE)) AS TIMESTAMP) AS fecha_fin
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE NOT (l.l_returnflag = 'N' AND l.l_linenumber % 3 = 0))"""))
def cln5(spark, d):
    """CLN4 + CLN5 quarterly samples cleaner, then LOAD4 normalised department lookup."""
    cleaned = clean.clean_quarterly(S.raw_ose_samples(spark, d))
    matched, _ = load.lookup_dimension(cleaned, S.departamentos(spark, d), "departamento", "nombre",
                                       "departamento_id", "departamento_id", normalize=True)
    return matched.select("departamento_id", "code", "value_cat", "fecha_inicio", "fecha_fin", "granularidad")


@register("cln7_lab_clean", with_ctes([], f"""
SELECT "GEMS Station Number", fecha_inicio, fecha_inicio + INTERVAL 1 DAY AS fecha_fin, code, unit, data_quality,
       {R('value')} AS value, {R('depth')} AS depth, 'DIA' AS granularidad, CAST(NULL AS VARCHAR) AS value_cat
FROM ({LAB_SQL})""".replace("WITH \n", "")))
def cln7(spark, d):
    """CLN6 + CLN7 lab sample selection (station prefix, year) and cleaning."""
    return _clean_lab(spark, d).select("GEMS Station Number", "fecha_inicio", "fecha_fin", "code", "unit",
                                       "data_quality", "value", "depth", "granularidad", "value_cat")


def _wide_grid(spark, d):
    """Wide ten-day grid table: one row per type and point, ``yyyy_mmd`` columns and monthly means ``yyyy_mm0`` of
    every year in the data (the years are column names, a handful)."""
    g = S.puntomedicion(spark, d)
    years = sorted(r[0] for r in g.select(F.year("fecha_inicio")).distinct().collect())
    dom = F.dayofmonth("fecha_inicio")
    dek = F.when(dom <= 10, 1).when(dom <= 20, 2).otherwise(3)
    month = F.concat(F.year("fecha_inicio").cast("string"), F.lit("_"), F.lpad(F.month("fecha_inicio").cast("string"), 2, "0"))
    codes = F.array(F.concat(month, dek.cast("string")), F.concat(month, F.lit("0")))
    g = g.select("type", "lon", "lat", "value", F.explode(codes).alias("col"))
    return g.groupBy("type", F.col("lon").alias("Longitud"), F.col("lat").alias("Latitud")).pivot(
        "col", [f"{y}_{m:02d}{k}" for y in years for m in range(1, 13) for k in (1, 2, 3, 0)]).agg(F.avg("value"))


@register("cln9_grid_wide_to_long", with_ctes(["grid"], f"""
, pts AS (SELECT DISTINCT type, lon, lat FROM grid),
dk AS (SELECT y, m, k FROM (SELECT DISTINCT year(fecha_inicio) AS y FROM grid) CROSS JOIN range(1, 13) t(m) CROSS JOIN range(1, 4) u(k)),
agg AS (SELECT type, lon, lat, year(fecha_inicio) AS y, month(fecha_inicio) AS m,
               CASE WHEN day(fecha_inicio) <= 10 THEN 1 WHEN day(fecha_inicio) <= 20 THEN 2 ELSE 3 END AS k,
               AVG(value) AS v
        FROM grid GROUP BY 1, 2, 3, 4, 5, 6)
SELECT p.type, p.lon AS longitud, p.lat AS latitud, {R('a.v')} AS valor,
       make_timestamp(dk.y, dk.m, CASE dk.k WHEN 1 THEN 1 WHEN 2 THEN 11 ELSE 21 END, 0, 0, 0) AS fecha_inicio,
       CAST(CASE dk.k WHEN 1 THEN make_date(dk.y, dk.m, 10) WHEN 2 THEN make_date(dk.y, dk.m, 20)
            ELSE last_day(make_date(dk.y, dk.m, 1)) END AS TIMESTAMP) + INTERVAL '23:59:59' AS fecha_fin
FROM pts p CROSS JOIN dk
LEFT JOIN agg a ON a.type = p.type AND a.lon = p.lon AND a.lat = p.lat AND a.y = dk.y AND a.m = dk.m AND a.k = dk.k"""))
def cln9(spark, d):
    """CLN8 + CLN9 + CLN10 wide ten-day grid (pivoted from the facts of all types and years) back to long rows."""
    return clean.grid_wide_to_long(_wide_grid(spark, d), keep=("type",))


@register("cln11_daily_clean", with_ctes([], f"""
SELECT l_suppkey AS estacion, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 9 HOUR AS fecha_inicio,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL '1 day 08:59:59' AS fecha_fin,
       {R('l_quantity / 2')} AS temperaturaMaxima, {R('l_tax * 100')} AS temperaturaMinima,
       {R('l_discount * 100')} AS pluviometro, 'DIA' AS granularidad
FROM lineitem WHERE l_tax <> 0""".replace("WITH \n", "")))
def cln11(spark, d):
    """CLN11 daily rain cleaner (meteorological day, null drop)."""
    return clean.clean_daily(S.raw_daily(spark, d))


@register("cln12_claims_clean", with_ctes([], f"""
SELECT region, departamento, id_reclamo_comercial_m, fecha_inicio, fecha_fin, tipo_reclamo
FROM ({CLAIMS_SQL}) WHERE tipo_reclamo IS NOT NULL""".replace("WITH \n", "")))
def cln12(spark, d):
    """CLN12 + CLN13 claims cleaner with claim type mapping (mojibake repaired)."""
    return clean.clean_claims(S.raw_claims(spark, d), min_year=1995)


@register("cln2_date_shapes", with_ctes([], """
SELECT shape, COUNT(*) AS rows, COUNT(*) FILTER (WHERE shape IS NOT NULL) AS dates FROM (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE
         CASE event_id % 9 WHEN 1 THEN 'zoned' WHEN 2 THEN 'zoned' WHEN 3 THEN 'compact' WHEN 4 THEN 'hour' WHEN 5 THEN 'numeric'
              WHEN 6 THEN 'named' ELSE 'iso' END END AS shape FROM events)
GROUP BY 1""".replace("WITH \n", "")))
def cln2_shapes(spark, d):
    """CLN2 how the dates of the hourly series are written: rows and dates per shape."""
    return shape_counts(S.raw_hourly(spark, d), "fecha")


@register("cln12_numeric_dates", with_ctes([], """
SELECT archivo, day_first, COUNT(*) AS rows, COUNT(fecha) AS dates, MIN(fecha) AS first_date, MAX(fecha) AS last_date,
       COALESCE(SUM(date_diff('day', DATE '1990-01-01', CAST(fecha AS DATE))), 0)::BIGINT AS day_sum
FROM (SELECT archivo, day_first, CASE WHEN day_first THEN CAST(f AS TIMESTAMP)
                                      WHEN day(f) <= 12 THEN make_timestamp(year(f), day(f), month(f), 0, 0, 0) END AS fecha
      FROM (SELECT c.c_nationkey AS archivo, o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS f,
                   day(first_value(CAST(o.o_orderdate AS DATE)) OVER (PARTITION BY c.c_nationkey ORDER BY o.o_orderkey)) > 12 AS day_first
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey))
GROUP BY 1, 2""".replace("WITH \n", "")))
def cln12_numeric(spark, d):
    """CLN12 day/month dates, a file per nation: the order follows from each file's first value."""
    o = S.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = S.read(spark, d, "customer").select("c_custkey", "c_nationkey")
    raw = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("archivo"), F.col("o_orderkey").alias("pos"), F.date_format("o_orderdate", "d/M/yyyy").alias("texto"))
    read = with_day_first(raw, "texto", ["archivo"], ["pos"])
    read = read.select("archivo", "day_first", clean.to_timestamp_lenient("texto", F.col("day_first")).alias("fecha"))
    return read.groupBy("archivo", "day_first").agg(
        F.count(F.lit(1)).alias("rows"), F.count("fecha").alias("dates"), F.min("fecha").alias("first_date"),
        F.max("fecha").alias("last_date"),
        F.coalesce(F.sum(F.datediff("fecha", F.lit("1990-01-01").cast("date"))), F.lit(0)).cast("long").alias("day_sum"))


@register("cln13_claim_type_map", with_ctes([], """
SELECT tipo_reclamo, COUNT(*) AS n FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'ALTO_CONSUMO'
       WHEN '2-HIGH' THEN 'ERROR_ESTIMACION' WHEN '3-MEDIUM' THEN 'DENUNCIA_NOTIFICACION_FACTURAS'
       WHEN '4-NOT SPECIFIED' THEN 'ERROR_LECTURA'
       ELSE CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'VARIOS' END END AS tipo_reclamo FROM orders)
GROUP BY 1""".replace("WITH \n", "")))
def cln13(spark, d):
    """CLN13 claim label -> enum over every raw claim (unmapped -> null)."""
    raw = S.raw_claims(spark, d)
    return raw.select(clean.claim_type("tipo_reclamo_comercial").alias("tipo_reclamo")).groupBy("tipo_reclamo").agg(
        F.count(F.lit(1)).alias("n"))


# place j from the right exists from ordinal (26^(j+1) - 26) / 25 + 1 on
_AREA_LETTERS_SQL = """array_to_string(list_transform(range(9, -1, -1), lambda j:
     CASE WHEN i > (26 ** (j + 1) - 26) / 25
          THEN chr(CAST(65 + ((i - CAST((26 ** (j + 1) - 26) / 25 AS BIGINT) - 1) // CAST(26 ** j AS BIGINT)) % 26 AS INTEGER))
          ELSE '' END), '')"""


@register("cln14_disambiguate_names", with_ctes([], f"""
, a AS (SELECT p_partkey AS pos, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END AS nm FROM part),
r AS (SELECT pos, nm, count(*) OVER (PARTITION BY nm) AS n, row_number() OVER (PARTITION BY nm ORDER BY pos) AS i
      FROM a)
SELECT pos, CASE WHEN nm IS NULL THEN 'AREA_' || {_AREA_LETTERS_SQL}
                 WHEN n > 1 THEN nm || '_' || CAST(i AS VARCHAR) ELSE nm END AS NOMBRE
FROM r""".replace("WITH \n,", "WITH")))
def cln14(spark, d):
    """CLN14 watershed name disambiguation (repeats numbered, nulls -> AREA_x) in file order."""
    return clean.disambiguate_names(S.raw_areas(spark, d).select("pos", "NOMBRE"), "NOMBRE", "pos")


@register("cln15_drop_null_factor", with_ctes([], f"""
SELECT p_partkey AS pos, {R('p_retailprice / 1000')} AS Factor_K FROM part WHERE p_size <= 45""".replace(
    "WITH \n", "")))
def cln15(spark, d):
    """CLN15 soils without erodibility factor dropped."""
    return clean.drop_null_factor(S.raw_areas(spark, d)).select("pos", "Factor_K")


@register("cln16_country_filter", with_ctes(["estaciones"], """
SELECT 'URY' || lpad(CAST(e.estacion_id AS VARCHAR), 6, '0') AS "GEMS Station Number"
FROM estaciones e JOIN supplier s ON e.estacion_id = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE n.n_regionkey = 1"""))
def cln16(spark, d):
    """CLN16 stations of one country."""
    return clean.stations_of_country(S.raw_lab_stations(spark, d)).select("GEMS Station Number")


def _resources_sql() -> str:
    pk = " ".join(f"WHEN {i} THEN '{p}'" for i, (p, _) in enumerate(S.CATALOGUE_PACKAGES))
    st = " ".join(f"WHEN {i} THEN '{s}'" for i, (_, s) in enumerate(S.CATALOGUE_PACKAGES))
    n = len(S.CATALOGUE_PACKAGES)
    return f"""
  SELECT CAST(page_id AS VARCHAR) AS resource_id, CASE page_id % {n} {pk} END AS package,
         CASE page_id % {n} {st} END AS stem,
         CASE WHEN page_id % 5 = 0 THEN 'XLSX' ELSE 'csv' END AS format,
         (CASE page_id % {n} {st} END) || CAST(2020 + page_id % 10 AS VARCHAR) || '_'
           || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') || '.csv' AS fname,
         CAST(2020 + page_id % 10 AS INTEGER) AS yr, md5(html) AS hash, url
  FROM pages"""


RESOLVED_SQL = f"""
  SELECT resource_id, package, hash, url,
    CASE WHEN upper(format) <> 'CSV' THEN NULL
      WHEN package LIKE 'inia-%-por-grilla' AND lower(fname) LIKE lower(replace(replace(package, 'inia-', 'inia_gras_'),
           '-por-grilla', '')) || '%' AND yr >= 2026
        THEN 'grillas/' || replace(replace(package, 'inia-', ''), '-por-grilla', '') || '/' || fname
      WHEN package LIKE 'inia-precipitacion-temps-extremas-%'
           AND lower(fname) LIKE 'ppt_tmax_tmin_' || replace(package, 'inia-precipitacion-temps-extremas-', '') || '%'
           AND yr >= 2026
        THEN 'precipitaciones/' || CASE replace(package, 'inia-precipitacion-temps-extremas-', '')
             WHEN 'lb' THEN 'Las Brujas' WHEN 'tyt' THEN 'Treinta y Tres' WHEN 'sg' THEN 'SaltoGrande'
             WHEN 'tb' THEN 'Tacuarembo' ELSE 'La Estanzuela' END || '/' || fname
      WHEN package = 'reclamos-comerciales' AND fname LIKE 'solicitudes\\_y\\_reclamos-comerciales\\_%' ESCAPE '\\'
           AND yr >= 2026 THEN 'reclamos/' || fname
      WHEN package = 'calidad-de-agua' THEN 'calidad_de_agua_bacteriologia.csv'
      WHEN package LIKE 'inumet-%' THEN 'inumet_precipitacion_acumulada_horaria.csv'
    END AS archivo_local,
    CASE WHEN package LIKE 'inia-%-por-grilla' THEN 'grillas'
         WHEN package LIKE 'inia-precipitacion%' THEN 'precipitaciones.load_registros'
         WHEN package = 'reclamos-comerciales' THEN 'reclamos' WHEN package = 'calidad-de-agua' THEN 'bacteriologia_ose'
         ELSE 'inumet' END AS modulo_all
  FROM ({_resources_sql()})"""


def _resolved(spark, d):
    return clean.resolve_resources(S.catalogue_resources(spark, d), clean.catalogue_rules(spark))


@register("cln17_resolve_resources", with_ctes([], f"""
SELECT resource_id, CASE WHEN archivo_local IS NOT NULL THEN modulo_all END AS modulo, archivo_local
FROM ({RESOLVED_SQL})""".replace("WITH \n", "")))
def cln17(spark, d):
    """CLN17 catalogue resource -> (module, target path) resolution over the resource manifest."""
    return _resolved(spark, d).select("resource_id", "modulo", "archivo_local")


# ------------------------------------------------------------------ keys

@register("key1_stable_ids", with_ctes([], f"""
SELECT o_orderkey, {uuid_sql('o_orderkey', 'o_orderpriority', 'o_orderdate', 'o_totalprice', 'NULL')} AS id
FROM orders""".replace("WITH \n", "")))
def key1(spark, d):
    """KEY1 deterministic ids over whole orders rows (order, text, timestamp, double and a null part)."""
    o = S.read(spark, d, "orders")
    return o.select("o_orderkey", stable_id("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice",
                                            F.lit(None)).alias("id"))


@register("key2_station_docs", with_ctes(["estaciones"], f"""
SELECT {uuid_sql('nombre', 'lat', 'lon')} AS id, nombre, {R('lon')} AS lon, {R('lat')} AS lat FROM estaciones"""))
def key2(spark, d):
    """KEY2 station point documents (id from name, lat, lon; coordinates lon, lat)."""
    return keys.station_docs(S.estaciones(spark, d)).select("id", "nombre", "lon", "lat")


def _wkt_sql() -> str:
    def num(e):
        return f"(CASE WHEN ({e}) = floor({e}) THEN CAST(CAST(floor({e}) AS BIGINT) AS VARCHAR) ELSE CAST({e} AS VARCHAR) END)"

    def ring(pts):
        return "'(' || " + " || ', ' || ".join(f"{num(f'x0 + {dx}')} || ' ' || {num(f'y0 + {dy}')}" for dx, dy in [*pts, pts[0]]) + " || ')'"

    def by_shape(rings):
        return "CASE shape " + " ".join(f"WHEN {s} THEN {ring(pts)}" for s, pts in rings.items()) + " END"

    outer, hole = by_shape(S.SHAPES), by_shape(S.HOLES)
    return (f"CASE departamento_id % 3 WHEN 0 THEN 'POLYGON (' || {outer} || ')' WHEN 1 THEN 'POLYGON (' || {outer} || ', ' || {hole} || ')'"
            f" ELSE 'MULTIPOLYGON ((' || {outer} || ', ' || {hole} || '), (' || {ring(S.ISLAND)} || '))' END")


@register("key3_area_docs", with_ctes(["deptos"], f"""
SELECT {uuid_sql(_wkt_sql(), 'nombre')} AS id, nombre FROM deptos"""))
def key3(spark, d):
    """KEY3 area documents: id from (geometry text with parts and holes, name), default name applied after the id."""
    return keys.area_docs(S.areas(spark, d), "parts", gtype="gtype").select("id", "nombre")


@register("key5_natural_ids", with_ctes([], f"""
SELECT id_reclamo_comercial_m,
       {uuid_sql('departamento_id', 'tipo_reclamo', 'region', 'fecha_inicio', 'fecha_fin', 'id_reclamo_comercial_m')} AS id
FROM ({CLAIMS_SQL}) WHERE tipo_reclamo IS NOT NULL""".replace("WITH \n", "")))
def key5(spark, d):
    """KEY5 natural-key ids of cleaned claims (after the LOAD4 department lookup)."""
    c = clean.clean_claims(S.raw_claims(spark, d), min_year=1995)
    m, _ = load.lookup_dimension(c, S.departamentos(spark, d), "departamento", "nombre", "departamento_id",
                                 "departamento_id", normalize=True)
    return keys.with_natural_id(m, "reclamosose").select("id_reclamo_comercial_m", "id")


# ------------------------------------------------------------------ load semantics

HOURLY_CUTOFF = "2024-01-16 00:00:00"


@register("load1_insert_if_absent", with_ctes([], f"""
, h AS ({HOURLY_SQL}),
k AS (SELECT *, {uuid_sql('estacion_id', 'fecha_inicio', "'PRECIPITACION'", "'HORA'")} AS id FROM h),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn FROM k) WHERE rn = 1),
existing AS (SELECT id FROM k WHERE fecha_inicio < TIMESTAMP '{HOURLY_CUTOFF}')
SELECT id, estacion_id, fecha_inicio, {R('value')} AS value, event_id AS pos
FROM first WHERE id NOT IN (SELECT id FROM existing)""".replace("WITH \n,", "WITH")))
def load1(spark, d):
    """LOAD1 insert-if-absent of hourly rows: first row per id wins; ids already loaded
    (rows before the previous load's cut-off) are skipped."""
    c = _hourly_with_pos(S.raw_hourly(spark, d))
    keyed = c.withColumn("id", stable_id("estacion_id", "fecha_inicio", F.lit("PRECIPITACION"), F.lit("HORA")))
    rows = tables.stage(keyed.select("id", "estacion_id", "fecha_inicio", "value", "pos", F.to_date("fecha_inicio").alias("dia")))
    path = scratch_path(spark, f"load1/{uuid.uuid4().hex[:12]}")
    tables.append(rows.filter(F.col("fecha_inicio") < F.lit(HOURLY_CUTOFF).cast("timestamp_ntz")), path, ["dia"])
    table = spark.read.schema(rows.schema).parquet(path)
    return tables.new_rows(rows, table, ["dia"]).drop("dia")


@register("load1_one_file", with_ctes([], f"""
, h AS ({HOURLY_SQL}),
k AS (SELECT *, {uuid_sql('estacion_id', 'fecha_inicio', "'PRECIPITACION'", "'HORA'")} AS id FROM h),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn
                         FROM k WHERE fecha_inicio >= TIMESTAMP '{HOURLY_CUTOFF}' - INTERVAL 1 DAY) WHERE rn = 1),
existing AS (SELECT id FROM k WHERE fecha_inicio < TIMESTAMP '{HOURLY_CUTOFF}')
SELECT id, estacion_id, fecha_inicio, {R('value')} AS value, event_id AS pos
FROM first WHERE id NOT IN (SELECT id FROM existing)""".replace("WITH \n,", "WITH")))
def load1_file(spark, d):
    """LOAD1 of one file (from the day before the previous load's cut-off on) into a table of all days before the cut-off:
    of the table only the file's days are read."""
    c = _hourly_with_pos(S.raw_hourly(spark, d))
    keyed = c.withColumn("id", stable_id("estacion_id", "fecha_inicio", F.lit("PRECIPITACION"), F.lit("HORA")))
    rows = tables.stage(keyed.select("id", "estacion_id", "fecha_inicio", "value", "pos", F.to_date("fecha_inicio").alias("dia")))
    path = scratch_path(spark, f"load1/{uuid.uuid4().hex[:12]}")
    cutoff = F.lit(HOURLY_CUTOFF).cast("timestamp_ntz")
    tables.append(rows.filter(F.col("fecha_inicio") < cutoff), path, ["dia"])
    batch = rows.filter(F.col("fecha_inicio") >= cutoff - F.expr("INTERVAL 1 DAY"))
    return tables.new_rows(batch, spark.read.schema(rows.schema).parquet(path), ["dia"]).drop("dia")


def _hourly_with_pos(raw):
    """CLN2 + CLN3 keeping the input position (event_id) for first-row-wins rules."""
    f = raw.dropna(subset=["fecha", "estacion_id", "precip_horario"])
    f = f.select(F.col("event_id").alias("pos"), clean.to_timestamp_lenient("fecha").alias("fecha"),
                 strip("estacion_id").alias("estacion_id"), clean.to_number("precip_horario").alias("value"))
    f = f.dropna(subset=["fecha", "estacion_id", "value"])
    return f.select("pos", "estacion_id", F.col("fecha").alias("fecha_inicio"), "value")


@register("load2_dimension_insert", with_ctes(["estaciones"], f"""
, docs AS (SELECT e.*, s.s_acctbal, {uuid_sql('nombre', 'lat', 'lon')} AS id
           FROM estaciones e JOIN supplier s ON e.estacion_id = s.s_suppkey)
SELECT id, nombre, CASE WHEN s_acctbal < 0 THEN 'ya_presente' ELSE 'insertado' END AS estado FROM docs""".replace(
    "\n)\n,", "\n),")))
def load2(spark, d):
    """LOAD2 dimension insert-if-absent: stations already registered (negative balance) are left
    untouched; reports inserted vs already present per document."""
    st = S.estaciones(spark, d)
    su = S.read(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    docs = keys.station_docs(st).join(st.select("nombre", "estacion_id"), "nombre") \
        .join(su, F.col("estacion_id") == F.col("s_suppkey"))
    existing = docs.filter(F.col("s_acctbal") < 0).select("id")
    batch = docs.select("id", "nombre", F.col("estacion_id").alias("pos"))
    ins = load.insert_if_absent(batch, existing).select("id", "nombre", F.lit("insertado").alias("estado"))
    present = load.already_present(batch, existing).join(batch, "id").select(
        "id", "nombre", F.lit("ya_presente").alias("estado"))
    return ins.unionByName(present)


def _state_sql() -> str:
    return """
  SELECT CAST(page_id AS VARCHAR) AS resource_id,
         CASE WHEN contains(url, '?') THEN md5(url) ELSE md5(html) END AS hash
  FROM pages WHERE contains(url, '/en/')"""


@register("load9_manifest_diff", with_ctes([], f"""
, r AS ({RESOLVED_SQL}),
st AS ({_state_sql()})
SELECT r.resource_id, r.modulo_all AS modulo, r.archivo_local,
       CASE WHEN st.hash IS NULL THEN 'nuevo' WHEN COALESCE(r.hash, '') = '' OR r.hash <> st.hash THEN 'modificado' END
         AS motivo
FROM r LEFT JOIN st ON r.resource_id = st.resource_id WHERE r.archivo_local IS NOT NULL""".replace("WITH \n,", "WITH")))
def load9(spark, d):
    """LOAD9 manifest diff: resolved resources vs last state -> nuevo / modificado / unchanged."""
    diff = load.manifest_diff(_resolved(spark, d), S.file_state(spark, d))
    return diff.select("resource_id", "modulo", "archivo_local", "motivo")


@register("load9_affected_modules", with_ctes([], f"""
, r AS ({RESOLVED_SQL}),
st AS ({_state_sql()})
SELECT DISTINCT r.modulo_all AS modulo
FROM r LEFT JOIN st ON r.resource_id = st.resource_id
WHERE r.archivo_local IS NOT NULL AND (st.hash IS NULL OR COALESCE(r.hash, '') = '' OR r.hash <> st.hash)""".replace(
    "WITH \n,", "WITH")))
def load9m(spark, d):
    """LOAD9 set of modules affected by new or modified resources."""
    return load.affected_modules(load.manifest_diff(_resolved(spark, d), S.file_state(spark, d)))


@register("load3_upsert_state", with_ctes([], f"""
, r AS ({RESOLVED_SQL}),
st AS ({_state_sql()}),
ch AS (SELECT r.resource_id, r.hash FROM r LEFT JOIN st ON r.resource_id = st.resource_id
       WHERE r.archivo_local IS NOT NULL AND (st.hash IS NULL OR COALESCE(r.hash, '') = '' OR r.hash <> st.hash))
SELECT COALESCE(ch.resource_id, st.resource_id) AS resource_id, COALESCE(ch.hash, st.hash) AS hash,
       ch.resource_id IS NOT NULL AS actualizado
FROM st FULL OUTER JOIN ch ON st.resource_id = ch.resource_id""".replace("WITH \n,", "WITH")))
def load3(spark, d):
    """LOAD3 upsert of the file-state table with the changed resources; each comes twice, first with a stale hash:
    the later row wins."""
    diff = load.manifest_diff(_resolved(spark, d), S.file_state(spark, d)).filter(F.col("motivo").isNotNull())
    turns = F.array(F.struct(F.lit(1).alias("turno"), F.lit("viejo").alias("hash")), F.struct(F.lit(2).alias("turno"), F.col("hash").alias("hash")))
    changed = diff.select("resource_id", F.lit(True).alias("actualizado"), F.inline(turns))
    state = S.file_state(spark, d).withColumn("actualizado", F.lit(False))
    return load.upsert(state, changed, "resource_id", order_col="turno")


@register("load3_partition_merge", with_ctes([], f"""
, st AS ({_state_sql()}),
up AS (SELECT CAST(page_id AS VARCHAR) AS resource_id, md5(html) AS hash FROM pages WHERE contains(url, '?')),
whole AS (SELECT COALESCE(u.resource_id, s.resource_id) AS resource_id, COALESCE(u.hash, s.hash) AS hash
          FROM st s FULL JOIN up u ON s.resource_id = u.resource_id)
SELECT resource_id, hash, substr(md5(resource_id), 1, 2) AS cubo,
       substr(md5(resource_id), 1, 2) IN (SELECT substr(md5(resource_id), 1, 2) FROM up) AS reescrito
FROM whole""".replace("WITH \n,", "WITH")))
def load3_partitions(spark, d):
    """LOAD3 into a state table of 256 buckets: pages with a query string are updated, each twice (the last counts); only
    buckets that hold one are written again (``reescrito``: the row's file is another than before)."""
    cubo = F.substring(F.md5(F.col("resource_id").cast("binary")), 1, 2).alias("cubo")
    path = scratch_path(spark, f"load3/{uuid.uuid4().hex[:12]}")
    tables.append(S.file_state(spark, d).select("*", cubo), path, ["cubo"])
    before = tables.stage(spark.read.parquet(path).select("cubo", F.col("_metadata.file_name").alias("antes")).distinct(), "files")
    pg = S.read(spark, d, "pages").filter(F.col("url").contains("?")).select(F.col("page_id").cast("string").alias("resource_id"), "html", "url")
    twice = pg.withColumn("turno", F.explode(F.array(F.lit(2), F.lit(1))))
    updates = twice.select("resource_id", F.when(F.col("turno") == 2, F.md5("html")).otherwise(F.md5("url")).alias("hash"), "turno", cubo)
    tables.merge_last(spark, path, updates, ["cubo"], "resource_id", order_col="turno")
    after = spark.read.parquet(path).select("resource_id", "hash", "cubo", F.col("_metadata.file_name").alias("ahora"))
    kept = before.select("cubo", F.col("antes").alias("ahora"), F.lit(False).alias("reescrito"))
    return after.join(kept, ["cubo", "ahora"], "left").select(
        "resource_id", "hash", "cubo", F.coalesce("reescrito", F.lit(True)).alias("reescrito"))


@register("load4_dimension_lookup", with_ctes([], """
SELECT s.s_nationkey AS departamento_id, COUNT(*) AS n
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY 1""".replace("WITH \n", "")))
def load4(spark, d):
    """LOAD4 normalised name -> department id lookup over every raw sample (matched counts per id)."""
    raw = S.raw_ose_samples(spark, d)
    matched, unmatched = load.lookup_dimension(raw, S.departamentos(spark, d), "departamento", "nombre",
                                               "departamento_id", "departamento_id", normalize=True)
    return matched.groupBy("departamento_id").agg(F.count(F.lit(1)).alias("n"))


@register("load5_skip_loaded_groups", with_ctes(["sentinel"], """
SELECT location_id, code, COUNT(*) AS n FROM sentinel
WHERE (location_id, code) NOT IN (SELECT DISTINCT location_id, code FROM sentinel WHERE code = 'NDCI')
GROUP BY 1, 2"""))
def load5(spark, d):
    """LOAD5 skip (location, code) groups already loaded (all NDCI groups are loaded)."""
    cand = S.sentinel_params(spark, d)
    target = cand.filter(F.col("code") == "NDCI")
    return load.skip_loaded_groups(cand, target, ["location_id", "code"]).groupBy("location_id", "code").agg(
        F.count(F.lit(1)).alias("n"))


@register("load6_delete_by_keys", with_ctes(["sentinel"], """
, k AS (SELECT n_nationkey AS location_id FROM nation WHERE n_regionkey = 1)
SELECT 'restantes' AS parte, COUNT(*) AS n FROM sentinel
WHERE NOT (code = 'NDCI' AND location_id IN (SELECT location_id FROM k))
UNION ALL
SELECT 'eliminadas', COUNT(*) FROM sentinel WHERE code = 'NDCI' AND location_id IN (SELECT location_id FROM k)"""))
def load6(spark, d):
    """LOAD6 delete by key set (locations of one region, code NDCI): remaining and deleted counts."""
    sp = S.sentinel_params(spark, d)
    keys_ = S.read(spark, d, "nation").filter(F.col("n_regionkey") == 1).select(
        F.col("n_nationkey").alias("location_id")).withColumn("code", F.lit("NDCI"))
    remaining, deleted = load.delete_by_keys(sp, keys_, ["location_id", "code"])
    return remaining.agg(F.count(F.lit(1)).alias("n")).select(F.lit("restantes").alias("parte"), "n").unionByName(
        deleted.agg(F.count(F.lit(1)).alias("n")).select(F.lit("eliminadas").alias("parte"), "n"))


@register("load8_constraint_violations", with_ctes([], f"""
, c AS ({LAB_SQL})
SELECT violation, COUNT(*) AS n FROM (
  SELECT CASE WHEN unit NOT IN ('mg/l', 'dimensionless', 'MPN/100ml') THEN 'enum:unit' END AS violation FROM c
  UNION ALL
  SELECT CASE WHEN length(code) > 5 THEN 'length:code' END FROM c)
WHERE violation IS NOT NULL GROUP BY 1""".replace("WITH \n,", "WITH")))
def load8(spark, d):
    """LOAD8 constraint checks on cleaned lab samples (not null, start <= end, enum, length)."""
    v = load.constraint_violations(
        _clean_lab(spark, d), not_null=["code", "fecha_inicio", "fecha_fin", "granularidad"],
        ordered=("fecha_inicio", "fecha_fin"), enums={"unit": ["mg/l", "dimensionless", "MPN/100ml"]},
        max_len={"code": 5})
    return v.groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@register("load8_unique_area", with_ctes([], """
SELECT CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END AS NOMBRE, COUNT(*) AS n FROM part
GROUP BY 1 HAVING COUNT(*) > 1""".replace("WITH \n", "")))
def load8u(spark, d):
    """LOAD8 UNIQUE check: raw watershed names occurring more than once (A09 duplicate report)."""
    return load.unique_violations(S.raw_areas(spark, d), "NOMBRE")



# ------------------------------------------------------------------ single-rule views of composite cleaners

@register("cln3_hour_interval", with_ctes([], f"""
SELECT estacion_id, fecha_inicio, fecha_fin FROM ({HOURLY_SQL})""".replace("WITH \n", "")))
def cln3(spark, d):
    """CLN3 one-hour interval [fecha, fecha + 1h] of every cleaned hourly row."""
    from caudal.functions.dates import hour_interval
    h = _hourly_with_pos(S.raw_hourly(spark, d))
    s, e = hour_interval("fecha_inicio")
    return h.select("estacion_id", s.alias("fecha_inicio"), e.alias("fecha_fin"))


@register("cln4_censored_filter", with_ctes([], """
SELECT CASE WHEN l_returnflag = 'R' THEN 'Presencia' WHEN l_returnflag = 'A' THEN 'Ausencia'
            WHEN l_linenumber % 3 = 1 THEN NULL ELSE 'Indeterminado' END AS valor, COUNT(*) AS n
FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linenumber % 3 = 0) GROUP BY 1""".replace("WITH \n", "")))
def cln4(spark, d):
    """CLN4 censored-value filter: '<1' dropped, null values kept (null-safe comparison)."""
    raw = S.raw_ose_samples(spark, d)
    return raw.filter(~F.col("valor").eqNullSafe("<1")).groupBy("valor").agg(F.count(F.lit(1)).alias("n"))


@register("cln6_lab_selection", with_ctes([], """
SELECT CASE l_returnflag WHEN 'A' THEN 'TOTCOLI' WHEN 'N' THEN 'ECOLI' ELSE 'pH' END AS "Parameter Code",
       COUNT(*) AS n
FROM lineitem WHERE l_suppkey % 9 <> 4 AND year(l_shipdate) >= 1997 GROUP BY 1""".replace("WITH \n", "")))
def cln6(spark, d):
    """CLN6 lab-sample selection: code mapped to its file, station prefix URY, sample year >= 1997."""
    raw = S.raw_lab_samples(spark, d).withColumn(
        "source_file", F.when(F.col("Parameter Code") == "pH", "pH.csv").otherwise("Indicator_Organism.csv"))
    code_files = spark.createDataFrame([("TOTCOLI", "Indicator_Organism.csv"), ("ECOLI", "Indicator_Organism.csv"),
                                        ("pH", "pH.csv")], "code string, file string")
    sel = clean.select_lab_samples(raw, code_files, min_year=LAB_MIN_YEAR)
    return sel.groupBy("Parameter Code").agg(F.count(F.lit(1)).alias("n"))


@register("cln8_drop_monthly_means", with_ctes(["grid"], """
SELECT type, lon AS Longitud, lat AS Latitud, CAST(COUNT(DISTINCT year(fecha_inicio) * 1000 + month(fecha_inicio) * 10
       + CASE WHEN day(fecha_inicio) <= 10 THEN 1 WHEN day(fecha_inicio) <= 20 THEN 2 ELSE 3 END) AS INTEGER) AS con_valor
FROM grid GROUP BY 1, 2, 3"""))
def cln8(spark, d):
    """CLN8 monthly-mean columns (``yyyy_mm0``) removed from the wide grid: per type and point, how many of
    the remaining dekad columns hold a value."""
    w = _wide_grid(spark, d)
    cols = clean.period_columns(w, ("id", "type", "Longitud", "Latitud"))
    held = F.size(F.array_compact(F.array(*[F.col(f"`{c}`") for c in cols])))
    return w.select("type", "Longitud", "Latitud", held.cast("int").alias("con_valor"))


@register("cln10_dekad_bounds", with_ctes(["grid"], """
SELECT DISTINCT make_timestamp(year(fecha_inicio), month(fecha_inicio), day(fecha_inicio), 0, 0, 0) AS fecha_inicio,
       CAST(CASE WHEN day(fecha_inicio) = 1 THEN fecha_inicio + 9 WHEN day(fecha_inicio) = 11 THEN fecha_inicio + 9
            ELSE last_day(fecha_inicio) END AS TIMESTAMP) + INTERVAL '23:59:59' AS fecha_fin
FROM grid"""))
def cln10(spark, d):
    """CLN10 dekad label -> [start 00:00, end 23:59:59] for every period column with data."""
    long = clean.grid_wide_to_long(_wide_grid(spark, d), keep=("type",))
    return long.filter(F.col("valor").isNotNull()).select("fecha_inicio", "fecha_fin").distinct()


# ------------------------------------------------------------------ KEY5: the other natural key lists

_GRID_ID = uuid_sql("lat", "lon")
KEY5_SQL = {
    "oseparam": ("oseparam_ids", ["departamento_id", "code", "fecha_inicio", "fecha_fin", "value_cat", "'TRIMESTRE'", "id_muestra_m"]),
    "gemsparams": ("""(SELECT *, fecha_inicio + INTERVAL 1 DAY AS fecha_fin FROM gems)""",
                   ["location_id", "code", "fecha_inicio", "fecha_fin", "value", "'mg/l'", "'Good'", "NULL", "'DIA'"]),
    "puntomedicion": (f"""(SELECT {_GRID_ID} AS punto_id, value, type, fecha_inicio, CASE WHEN day(fecha_inicio) < 21
        THEN CAST(fecha_inicio + 9 AS DATE) ELSE last_day(fecha_inicio) END AS fecha_fin FROM grid)""",
                      ["punto_id", "value", "type", "fecha_inicio", "fecha_fin", "'PERIODO'"]),
    "paraminumet": (f"({HOURLY_SQL})", ["estacion_id", "fecha_inicio", "'PRECIPITACION'", "'HORA'"]),
    "registrotempprec": ("""(SELECT l_suppkey AS location_id, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 9 HOUR AS fecha_inicio,
        CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL '1 day 08:59:59' AS fecha_fin, l_quantity / 2 AS tmax,
        l_tax * 100 AS tmin, l_discount * 100 AS lluvia FROM lineitem)""",
                         ["location_id", "fecha_inicio", "fecha_fin", "tmax", "tmin", "lluvia", "'DIA'"]),
    "sentinel_params": ("sentinel", ["location_id", "code", "fecha_inicio", "fecha_inicio", "value", "'DIA'"]),
    "erosion_cuenca": ("part", ["p_partkey", "p_retailprice / 100", "p_size % 5"]),
    "erosion_suelos": ("part", ["p_partkey", "p_brand", "p_type", "CASE WHEN p_size <= 45 THEN p_retailprice / 1000 END", "NULL"]),
    "departamentos": ("nation", ["n_name", "lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"]),
}


def _key5_rows(spark, d, table):
    if table == "oseparam":
        return S.oseparam(spark, d)
    if table == "gemsparams":
        return S.gemsparams(spark, d)
    if table == "puntomedicion":
        return S.puntomedicion(spark, d).withColumn("punto_id", stable_id("lat", "lon")).withColumnsRenamed({"value": "valor", "type": "tipo"})
    if table == "paraminumet":
        h = clean.clean_hourly(S.raw_hourly(spark, d), "precip_horario", "PRECIPITACION")
        return h.withColumnsRenamed({"estacion_id": "location_id", "fecha_inicio": "fecha"})
    if table == "registrotempprec":
        return S.registrotempprec(spark, d)
    if table == "sentinel_params":
        return S.sentinel_params(spark, d).withColumnsRenamed({"fecha_inicio": "fecha", "value": "valor"})
    if table == "departamentos":
        return S.departamentos(spark, d)
    if table == "erosion_cuenca":
        return S.raw_areas(spark, d).withColumnsRenamed({"pos": "area_id", "A_pon_cuen": "ponderacion", "Cluster": "cluster"})
    p = S.read(spark, d, "part").select("p_partkey", F.col("p_brand").alias("grupo"), F.col("p_type").alias("perfil"))
    areas = S.raw_areas(spark, d).select(F.col("pos").alias("area_id"), F.col("Factor_K").alias("factor_k"))
    return areas.join(p, F.col("area_id") == F.col("p_partkey")).withColumn("taxonomia", F.lit(None).cast("string"))


_OSE_IDS = """
, oseparam_ids AS (
  SELECT s.s_nationkey AS departamento_id, CASE WHEN l.l_linestatus = 'F' THEN 'COLIFORMES TOTALES' ELSE 'COLIFORMES FECALES' END AS code,
         CAST(date_trunc('quarter', l.l_shipdate) AS TIMESTAMP) AS fecha_inicio,
         CAST(last_day(CAST(date_trunc('quarter', l.l_shipdate) + INTERVAL 2 MONTH AS DATE)) AS TIMESTAMP) AS fecha_fin,
         CASE WHEN l.l_returnflag = 'R' THEN 'Presencia' WHEN l.l_returnflag = 'A' THEN 'Ausencia'
              WHEN l.l_linenumber % 3 = 1 THEN NULL ELSE 'Indeterminado' END AS value_cat,
         l.l_orderkey * 10 + l.l_linenumber AS id_muestra_m
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE NOT (l.l_returnflag = 'N' AND l.l_linenumber % 3 = 0))"""


def _register_key5(table, source, parts):
    ctes = {"gemsparams": ["gems"], "puntomedicion": ["grid"], "sentinel_params": ["sentinel"]}.get(table, [])
    sql = f"SELECT id, COUNT(*) AS n FROM (SELECT {uuid_sql(*parts)} AS id FROM {source}) GROUP BY 1"
    sql = _OSE_IDS.replace(", oseparam_ids", "WITH oseparam_ids", 1) + sql if table == "oseparam" else with_ctes(ctes, sql)

    @register(f"key5_{table}", sql)
    def key5_table(spark, d):
        return keys.with_natural_id(_key5_rows(spark, d, table), table).groupBy("id").agg(F.count(F.lit(1)).alias("n"))

    QUERIES[f"key5_{table}"].__doc__ = f"KEY5 natural-key ids of {table}: rows per id."


for _table, (_source, _parts) in KEY5_SQL.items():
    _register_key5(_table, _source, _parts)
