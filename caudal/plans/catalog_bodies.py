"""Registered queries for water bodies, grid series and dashboard-derived tables
(GEO1, GEO4-GEO9, Q20-Q30, D01-D19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caudal.operators import derived, lab, ndci, quality, soil, spatial
from caudal.plans import surrogates as S
from caudal.plans.catalog import _grid, _q14, _registry, _soil, _station_depto
from caudal.plans.oracle import haversine_sql, with_ctes
from caudal.plans.registry import Y0, Y1, R, register

HAV_BODY_GRID = haversine_sql("b.lon", "b.lat", "g.lon", "g.lat")

# Shared oracle pieces: monthly index, covered bodies, nearest grid point, monthly PAD.
_IDX = f"""
, idx AS (SELECT location_id, CAST(date_trunc('month', fecha_inicio) AS DATE) AS periodo, AVG(value) AS ndci
          FROM sentinel WHERE code = 'NDCI' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1, 2),
gp AS (SELECT DISTINCT lon, lat FROM grid),
bodies AS (SELECT * FROM ndci_loc WHERE location_id IN (SELECT location_id FROM idx)),
near AS (
  SELECT location_id, plon, plat, dist_m FROM (
    SELECT b.location_id, g.lon AS plon, g.lat AS plat, {HAV_BODY_GRID} AS dist_m,
           row_number() OVER (PARTITION BY b.location_id ORDER BY {HAV_BODY_GRID}, g.lat, g.lon) AS rn
    FROM bodies b CROSS JOIN gp g WHERE {HAV_BODY_GRID} <= 40000) WHERE rn = 1),
padm AS (SELECT lon, lat, CAST(date_trunc('month', fecha_inicio) AS DATE) AS periodo, AVG(value) AS pad
         FROM grid WHERE type = 'PAD' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1, 2, 3),
pad AS (SELECT n.location_id, p.periodo, p.pad FROM near n JOIN padm p ON p.lon = n.plon AND p.lat = n.plat)"""


def _ctes(extra_body: str, names=("ndci_loc", "sentinel", "grid")) -> str:
    return with_ctes(list(names), "").rstrip() + _IDX + extra_body


def _lag_sql(lag: int) -> str:
    return f"""
, m AS (
  SELECT COALESCE(p.location_id, i.location_id) AS location_id, COALESCE(i.periodo, p.lagged) AS periodo,
         p.pad, p.periodo AS pad_periodo, i.ndci
  FROM (SELECT *, CAST(periodo + INTERVAL {lag} MONTH AS DATE) AS lagged FROM pad) p
  FULL OUTER JOIN idx i ON p.location_id = i.location_id AND p.lagged = i.periodo),
bnd AS (SELECT location_id, min(periodo) AS lo, max(periodo) AS hi FROM m GROUP BY 1),
months AS (SELECT location_id,
                  CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)
                  AS periodo FROM bnd)
SELECT months.location_id, months.periodo, {R('m.pad')} AS pad, m.pad_periodo, {R('m.ndci')} AS ndci
FROM months LEFT JOIN m ON months.location_id = m.location_id AND months.periodo = m.periodo"""


def _pad_monthly(spark, d):
    return soil.monthly_point_means(_grid(spark, d), "PAD", Y0, Y1)


# ============================================================ water bodies

@register("geo1_bbox_polygons", with_ctes(["ndci_loc"], f"""
SELECT location_id, {R('lon - 0.02')} AS min_lon, {R('lon + 0.02')} AS max_lon,
       {R('lat - 0.02')} AS min_lat, {R('lat + 0.02')} AS max_lat
FROM ndci_loc"""))
def geo1(spark, d):
    """GEO1 bounding-box polygon around each water body centre (half-width 0.02 degrees)."""
    locs = S.sentinel_locations(spark, d)
    cent = spatial.polygon_centroids(locs, "location_id").select(
        "location_id", F.col("centroid_lon").alias("lon"), F.col("centroid_lat").alias("lat"))
    return spatial.bbox_polygons(cent, half_width=0.02).select("location_id", "min_lon", "max_lon",
                                                                "min_lat", "max_lat")


@register("geo5_polygon_centroids", with_ctes(["deptos"], f"""
SELECT departamento_id,
  {R("CASE shape WHEN 0 THEN x0 + 0.65 WHEN 1 THEN x0 + 0.5 WHEN 2 THEN x0 + (0.32*0.3 + 0.16*0.7) / 0.48 ELSE x0 + 0.76 END")} AS centroid_lon,
  {R("CASE shape WHEN 0 THEN y0 + 0.5 WHEN 1 THEN y0 + 0.5 WHEN 2 THEN y0 + (0.32*0.5 + 0.16*0.3) / 0.48 ELSE y0 + 0.76 END")} AS centroid_lat,
  {R("CASE shape WHEN 0 THEN 1.1 * 0.8 WHEN 1 THEN 2 * 0.45 * 0.45 WHEN 2 THEN 0.48 ELSE 0.08 * 0.08 END")} AS area
FROM deptos"""))
def geo5(spark, d):
    """GEO5 area-weighted polygon centroids (shoelace) of the department polygons."""
    return spatial.polygon_centroids(S.departamentos(spark, d), "departamento_id")


@register("geo6_representative_points", with_ctes(["deptos"], f"""
SELECT departamento_id,
  {R("CASE shape WHEN 0 THEN x0 + 0.65 WHEN 1 THEN x0 + 0.5 WHEN 2 THEN x0 + 0.3 ELSE x0 + 0.76 END")} AS rep_lon,
  {R("CASE shape WHEN 3 THEN y0 + 0.76 ELSE y0 + 0.5 END")} AS rep_lat
FROM deptos"""))
def geo6(spark, d):
    """GEO6 interior representative point of each department polygon."""
    return spatial.representative_points(S.departamentos(spark, d), "departamento_id")


@register("geo4_nearest_grid_point", _ctes(f"""
SELECT location_id, {R('plon')} AS lon, {R('plat')} AS lat, {R('dist_m')} AS dist_m FROM near"""))
def geo4(spark, d):
    """GEO4 nearest grid point within 40 km of each water body with index values."""
    idx = ndci.monthly_index(S.sentinel_params(spark, d), Y0, Y1)
    bodies = ndci.located_bodies(S.sentinel_locations(spark, d)).join(
        idx.select("location_id").distinct(), "location_id", "left_semi")
    reg = _registry(spark, d)
    near = ndci.nearest_grid_point(bodies, reg)
    return near.join(reg, "punto_id").select("location_id", "lon", "lat", "dist_m")


@register("geo4_knn12_stations", with_ctes(["deptos", "estaciones"], f"""
, rep AS (SELECT departamento_id,
                 CASE shape WHEN 0 THEN x0 + 0.65 WHEN 1 THEN x0 + 0.5 WHEN 2 THEN x0 + 0.3 ELSE x0 + 0.76 END AS lon,
                 CASE shape WHEN 3 THEN y0 + 0.76 ELSE y0 + 0.5 END AS lat FROM deptos)
SELECT departamento_id, estacion_id, rank, {R('dist_m')} AS dist_m FROM (
  SELECT r.departamento_id, e.estacion_id, {haversine_sql('r.lon', 'r.lat', 'e.lon', 'e.lat')} AS dist_m,
         CAST(row_number() OVER (PARTITION BY r.departamento_id
              ORDER BY {haversine_sql('r.lon', 'r.lat', 'e.lon', 'e.lat')}, e.estacion_id) AS INTEGER) AS rank
  FROM rep r CROSS JOIN estaciones e) WHERE rank <= 12"""))
def geo4_knn(spark, d):
    """GEO4 12 nearest stations of each department representative point, no distance cap."""
    rep = spatial.representative_points(S.departamentos(spark, d), "departamento_id")
    st = S.estaciones(spark, d)
    out = spatial.nearest_points(rep, st, "departamento_id", "estacion_id", k=12, qlon="rep_lon", qlat="rep_lat")
    return out.select("departamento_id", "estacion_id", F.col("rank").cast("int").alias("rank"), "dist_m")


@register("geo7_point_coords", with_ctes(["grid"], """
SELECT lat, lon, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
       || '-' || substr(h, 21, 12) AS punto_id
FROM (SELECT DISTINCT lat, lon, md5(CAST(lat AS VARCHAR) || '|' || CAST(lon AS VARCHAR)) AS h FROM grid WHERE type = 'PAD')"""))
def geo7(spark, d):
    """GEO7 coordinates (lat, lon) of the grid points that carry PAD values, by id."""
    ids = soil.grid_registry(_grid(spark, d).filter(F.col("type") == "PAD")).select("punto_id")
    return derived.point_coords(_registry(spark, d), ids).select("lat", "lon", "punto_id")


@register("q30_locations_with_code", with_ctes(["sentinel"], """
SELECT DISTINCT location_id FROM sentinel WHERE code = 'NDCI'"""))
def q30(spark, d):
    """Q30 distinct locations with NDCI values."""
    return ndci.locations_with_code(S.sentinel_params(spark, d))


@register("q20_locations_with_ndci", _ctes(f"""
SELECT b.location_id, b.nombre, {R('b.lat')} AS lat, {R('b.lon')} AS lon
FROM ndci_loc b
WHERE b.location_id IN (SELECT location_id FROM sentinel WHERE code = 'NDCI')
  AND EXISTS (SELECT 1 FROM gp g WHERE {HAV_BODY_GRID} <= 40000)"""))
def q20(spark, d):
    """Q20 water bodies with NDCI, name and centroid, covered by a grid point within 40 km (GEO8)."""
    return ndci.locations_with_index(S.sentinel_params(spark, d), S.sentinel_locations(spark, d),
                                     _registry(spark, d))


@register("q21_pad_monthly", with_ctes(["grid"], f"""
SELECT lon, lat, CAST(date_trunc('month', fecha_inicio) AS DATE) AS periodo, {R('AVG(value)')} AS pad
FROM grid WHERE type = 'PAD' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1, 2, 3"""))
def q21(spark, d):
    """Q21 monthly PAD mean per grid point."""
    return _pad_monthly(spark, d).select("lon", "lat", "periodo", "pad")


@register("q22_ndci_monthly", with_ctes(["sentinel"], f"""
SELECT location_id, CAST(date_trunc('month', fecha_inicio) AS DATE) AS periodo, {R('AVG(value)')} AS ndci
FROM sentinel WHERE code = 'NDCI' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1, 2"""))
def q22(spark, d):
    """Q22 monthly NDCI mean per water body."""
    return ndci.monthly_index(S.sentinel_params(spark, d), Y0, Y1)


_SUMMARY = f"""
SELECT l.nombre, COUNT(*) AS observaciones, MIN(s.fecha_inicio) AS fecha_min, MAX(s.fecha_inicio) AS fecha_max,
       AVG(s.value) AS ndci_promedio, MIN(s.value) AS ndci_min, MAX(s.value) AS ndci_max,
       STDDEV_SAMP(s.value) AS ndci_desvio
FROM sentinel s JOIN ndci_loc l ON s.location_id = l.location_id
WHERE s.code = 'NDCI' AND s.fecha_inicio >= make_date({Y0}, 1, 1) AND s.fecha_inicio < make_date({Y1} + 1, 1, 1)
GROUP BY l.nombre"""


@register("q23_ndci_summary", with_ctes(["sentinel", "ndci_loc"], f"""
SELECT nombre, observaciones, fecha_min, fecha_max, {R('ndci_promedio')} AS ndci_promedio,
       {R('ndci_min')} AS ndci_min, {R('ndci_max')} AS ndci_max, {R('ndci_desvio')} AS ndci_desvio
FROM ({_SUMMARY})"""))
def q23(spark, d):
    """Q23 NDCI summary per water body (n, first/last date, avg/min/max/stddev), by mean desc."""
    return ndci.index_summary(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), Y0, Y1)


_MONTHLY_BODY = f"""
SELECT l.nombre, CAST(date_trunc('month', s.fecha_inicio) AS DATE) AS mes, COUNT(*) AS observaciones,
       AVG(s.value) AS ndci_promedio
FROM sentinel s JOIN ndci_loc l ON s.location_id = l.location_id
WHERE s.code = 'NDCI' AND year(s.fecha_inicio) BETWEEN {Y0} AND {Y1}
GROUP BY 1, 2"""


@register("q24_ndci_monthly_by_body", with_ctes(["sentinel", "ndci_loc"], f"""
SELECT nombre, mes, observaciones, {R('ndci_promedio')} AS ndci_promedio FROM ({_MONTHLY_BODY})"""))
def q24(spark, d):
    """Q24 NDCI per (water body, month): n and mean."""
    return ndci.index_monthly_by_body(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), Y0, Y1)


@register("q25_ndci_observations", with_ctes(["sentinel", "ndci_loc"], f"""
SELECT l.nombre, s.fecha_inicio, {R('s.value')} AS ndci
FROM sentinel s JOIN ndci_loc l ON s.location_id = l.location_id
WHERE s.code = 'NDCI' AND year(s.fecha_inicio) BETWEEN {Y0} AND {Y1}"""))
def q25(spark, d):
    """Q25 raw NDCI observations with water body names."""
    return ndci.index_observations(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), Y0, Y1)


@register("q26_month_gap_fill", with_ctes([], """
, sel AS (
  SELECT e.label AS location_id, e.vec_id AS scene_id,
         CAST(DATE '2015-01-01' + CAST(e.vec_id * 3 % 2190 AS INTEGER) AS DATE) AS fecha,
         CAST(e.embedding[t.i * 3 + 1] AS DOUBLE) AS red, CAST(e.embedding[t.i * 3 + 3] AS DOUBLE) AS rededge1
  FROM embeddings e CROSS JOIN range(0, 21) t(i)
  WHERE (e.vec_id * 7) % 40 < 20 AND (e.vec_id + t.i) % 8 = 6 AND t.i % 5 BETWEEN 1 AND 3 AND t.i // 5 BETWEEN 1 AND 3),
med AS (SELECT location_id, scene_id, fecha, median((rededge1 - red) / (rededge1 + red)) AS v
        FROM sel WHERE rededge1 + red <> 0 GROUP BY 1, 2, 3),
idx AS (SELECT location_id, CAST(date_trunc('month', fecha) AS DATE) AS periodo, AVG(v) AS ndci FROM med GROUP BY 1, 2),
bnd AS (SELECT location_id, min(periodo) AS lo, max(periodo) AS hi FROM idx GROUP BY 1),
months AS (SELECT location_id,
                  CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)
                  AS periodo FROM bnd)
SELECT months.location_id, months.periodo, """ + R("idx.ndci") + """ AS ndci
FROM months LEFT JOIN idx ON months.location_id = idx.location_id AND months.periodo = idx.periodo"""))
def q26(spark, d):
    """Q26 month gap-fill of the monthly NDCI series built from scene medians (SP4), where many
    months have no usable scene."""
    from caudal.operators import spectral
    from caudal.plans.catalog_audit import _bounds
    px = spectral.select_scenes(S.pixels(spark, d), _bounds(spark, d), "2015-01-01", "2099-12-31")
    med = spectral.scene_medians(spectral.water_mask(px), "NDCI")
    idx = med.groupBy("location_id", F.trunc("fecha", "month").alias("periodo")).agg(F.avg("valor").alias("ndci"))
    return ndci.monthly_gap_fill(idx, "location_id").select("location_id", "periodo", "ndci")


@register("q27_lag_join", _ctes(_lag_sql(2)))
def q27(spark, d):
    """Q27 PAD shifted 2 months, full outer join with monthly NDCI, gap-filled."""
    idx = ndci.monthly_index(S.sentinel_params(spark, d), Y0, Y1)
    bodies = ndci.located_bodies(S.sentinel_locations(spark, d)).join(
        idx.select("location_id").distinct(), "location_id", "left_semi")
    near = ndci.nearest_grid_point(bodies, _registry(spark, d)).select("location_id", "punto_id")
    pad = near.join(_pad_monthly(spark, d), "punto_id").select("location_id", "periodo", "pad")
    return ndci.lag_join(pad, idx, "location_id", 2)


@register("q28_pad_vs_ndci", _ctes(_lag_sql(1)))
def q28(spark, d):
    """Q28 PAD (nearest grid point <= 40 km) vs NDCI per water body, lag 1 month, gap-filled."""
    return ndci.pad_vs_index(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), _registry(spark, d),
                             _pad_monthly(spark, d), Y0, Y1, 1)


@register("q29_lag_correlation", _ctes(f"""
, lags AS (SELECT CAST(unnest(range(0, 7)) AS INTEGER) AS lag),
pairs AS (SELECT p.location_id, lags.lag, p.pad, i.ndci
          FROM pad p CROSS JOIN lags
          JOIN idx i ON i.location_id = p.location_id AND i.periodo = CAST(p.periodo + to_months(lags.lag) AS DATE)),
st AS (SELECT location_id, lag, COUNT(*) AS n, covar_samp(pad, ndci) AS c, stddev_samp(pad) AS sx,
              stddev_samp(ndci) AS sy FROM pairs GROUP BY 1, 2),
base AS (SELECT location_id, lag FROM near CROSS JOIN lags)
SELECT l.nombre, base.lag,
       {R('CASE WHEN COALESCE(st.n, 0) >= 3 AND st.sx * st.sy <> 0 THEN st.c / (st.sx * st.sy) END')} AS correlacion,
       COALESCE(st.n, 0) AS n
FROM base LEFT JOIN st ON base.location_id = st.location_id AND base.lag = st.lag
JOIN ndci_loc l ON l.location_id = base.location_id"""))
def q29(spark, d):
    """Q29 Pearson correlation PAD vs NDCI per lag 0..6 and water body (null when n < 3)."""
    return ndci.lag_correlation(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), _registry(spark, d),
                                _pad_monthly(spark, d), Y0, Y1)


# ============================================================ derived dashboard tables

@register("d01_rank_soil", with_ctes(["deptos", "grid", "grid_points"], "").rstrip() + __import__(
    "caudal.plans.catalog", fromlist=["_SOIL_CTES"])._SOIL_CTES.replace("{tipo}", "IBH") + f"""
SELECT nombre, {R('valor_medio')} AS valor_medio,
       CAST(row_number() OVER (ORDER BY valor_medio DESC, nombre) AS INTEGER) AS ranking FROM soil""")
def d01(spark, d):
    """D01 departments ranked by soil water index (unique ranks, ties by name)."""
    return derived.rank_desc(_soil(spark, d), "valor_medio").withColumn("ranking", F.col("ranking").cast("int"))


_REP_SQL = """
, rep AS (SELECT nombre,
                 CASE shape WHEN 0 THEN x0 + 0.65 WHEN 1 THEN x0 + 0.5 WHEN 2 THEN x0 + 0.3 ELSE x0 + 0.76 END AS lon,
                 CASE shape WHEN 3 THEN y0 + 0.76 ELSE y0 + 0.5 END AS lat FROM deptos)"""


@register("d02_map_markers", with_ctes(["station_depto", "registro"], "").rstrip() + _REP_SQL + f"""
, rain AS (SELECT sd.nombre, AVG(st.m) AS val_precip
           FROM (SELECT location_id, AVG(pluviometro) AS m FROM registro
                 WHERE year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1) st
           JOIN station_depto sd ON st.location_id = sd.estacion_id GROUP BY 1),
j AS (SELECT rain.*, rep.lon, rep.lat,
             CAST(row_number() OVER (ORDER BY val_precip DESC, rain.nombre) AS INTEGER) AS ranking,
             min(val_precip) OVER () AS lo, max(val_precip) OVER () AS hi
      FROM rain JOIN rep ON rain.nombre = rep.nombre)
SELECT nombre, {R('lon')} AS lon, {R('lat')} AS lat, {R('val_precip')} AS val_precip, ranking,
       {R('CASE WHEN hi = lo THEN 22000.0 ELSE 9000.0 + (val_precip - lo) / (hi - lo) * 36000.0 END')} AS radio,
       '#' || CAST(ranking AS VARCHAR) || ' ' || nombre || '<br>Precipitación: '
           || printf('%.2f', val_precip) || ' mm' AS tooltip
FROM j""")
def d02(spark, d):
    """D02 rainfall map markers: representative point, rank, radius 9000-45000, tooltip."""
    rep = spatial.representative_points(S.departamentos(spark, d), "departamento_id").join(
        S.departamentos(spark, d).select("departamento_id", "nombre"), "departamento_id").select(
        "nombre", F.col("rep_lon").alias("lon"), F.col("rep_lat").alias("lat"))
    out = derived.map_markers(_q14(spark, d), rep, "val_precip", "Precipitación", "mm")
    return out.withColumn("ranking", F.col("ranking").cast("int"))


_FMT_SQL = """CASE WHEN {v} IS NULL THEN NULL WHEN {v} = 0 THEN '0'
     WHEN abs({v}) >= 100 THEN printf('%.1f', {v}) WHEN abs({v}) >= 1 THEN printf('%.2f', {v})
     WHEN abs({v}) >= 0.01 THEN printf('%.4f', {v}) ELSE printf('%.6f', {v}) END"""

_Q08_BODY = f"""
SELECT sd.nombre, CAST(date_trunc('month', g.fecha_inicio) AS DATE) AS periodo,
       AVG(g.value) AS valor_medio, MIN(g.value) AS valor_min, MAX(g.value) AS valor_max, COUNT(*) AS n_mediciones
FROM gems g JOIN station_depto sd ON g.location_id = sd.estacion_id
WHERE g.code = 'TOTCOLI' AND g.value IS NOT NULL AND year(g.fecha_inicio) BETWEEN {Y0} AND {Y1}
GROUP BY 1, 2"""


def _q08(spark, d):
    return lab.monthly_stats(S.gemsparams(spark, d), _station_depto(spark, d), "TOTCOLI", Y0, Y1)


@register("d03_format_values", with_ctes(["station_depto", "gems"], f"""
SELECT nombre, periodo, {R('valor_medio / 1000.0')} AS v, {_FMT_SQL.format(v='valor_medio / 1000.0')} AS valor_txt
FROM ({_Q08_BODY})"""))
def d03(spark, d):
    """D03 magnitude-dependent formatting of monthly means (scaled to span the magnitude classes)."""
    m = _q08(spark, d).select("nombre", "periodo", (F.col("valor_medio") / 1000.0).alias("v"))
    return derived.formatted_values(m, "v")


_Q06A_TOT = f"""
SELECT departamento_id, CAST(date_trunc('quarter', fecha_inicio) AS DATE) AS periodo,
       CAST(year(date_trunc('quarter', fecha_inicio)) AS VARCHAR) || ' Q'
         || CAST(quarter(date_trunc('quarter', fecha_inicio)) AS VARCHAR) AS periodo_str,
       COUNT(*) AS total_muestras,
       SUM(CASE WHEN value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS pct_presencia
FROM oseparam
WHERE code = 'COLIFORMES TOTALES' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1}
  AND value_cat IN ('Presencia', 'Ausencia')
GROUP BY 1, 2, 3"""


def _series_tot(spark, d):
    ev = quality.quality_evolution(S.oseparam(spark, d), Y0, Y1, ["COLIFORMES TOTALES"])
    return quality.quality_series(ev)


@register("d04_period_kpi", with_ctes(["oseparam"], f"""
SELECT departamento_id, CAST(SUM(total_muestras) AS BIGINT) AS total_muestras,
       {R('SUM(pct_presencia * total_muestras / 100.0) / SUM(total_muestras) * 100.0')} AS pct_global
FROM ({_Q06A_TOT}) GROUP BY 1"""))
def d04(spark, d):
    """D04 period KPI per department: total samples and sample-weighted % presence."""
    return derived.period_kpi(_series_tot(spark, d), ["departamento_id"])


@register("d05_half_period_trend", with_ctes(["oseparam"], f"""
, s AS ({_Q06A_TOT}),
r AS (SELECT *, dense_rank() OVER (PARTITION BY departamento_id ORDER BY periodo_str) AS rk FROM s),
r2 AS (SELECT *, max(rk) OVER (PARTITION BY departamento_id) AS nn FROM r),
a AS (SELECT departamento_id, max(nn) AS n_periodos,
             SUM(CASE WHEN rk <= nn // 2 THEN pct_presencia * total_muestras END)
               / SUM(CASE WHEN rk <= nn // 2 THEN total_muestras END) AS p1,
             SUM(CASE WHEN rk > nn // 2 THEN pct_presencia * total_muestras END)
               / SUM(CASE WHEN rk > nn // 2 THEN total_muestras END) AS p2
      FROM r2 GROUP BY 1)
SELECT departamento_id, CAST(n_periodos AS INTEGER) AS n_periodos, {R('p1')} AS pct_primera, {R('p2')} AS pct_segunda,
       {R('CASE WHEN n_periodos >= 2 THEN p2 - p1 END')} AS delta,
       CASE WHEN n_periodos < 2 THEN 'Período muy corto' WHEN p2 - p1 > 0 THEN 'Empeora' ELSE 'Mejora' END AS tendencia
FROM a""".replace("WITH ", "WITH ", 1)))
def d05(spark, d):
    """D05 half-period trend per department (weighted % of each half, Empeora/Mejora)."""
    return derived.half_period_trend(_series_tot(spark, d), ["departamento_id"])


@register("d06_lab_kpis", with_ctes(["station_depto", "gems"], f"""
SELECT nombre, {R('AVG(valor_medio)')} AS promedio, {R('MIN(valor_min)')} AS minimo, {R('MAX(valor_max)')} AS maximo,
       {_FMT_SQL.format(v='AVG(valor_medio)')} AS promedio_txt, {_FMT_SQL.format(v='MIN(valor_min)')} AS minimo_txt,
       {_FMT_SQL.format(v='MAX(valor_max)')} AS maximo_txt
FROM ({_Q08_BODY}) GROUP BY nombre"""))
def d06(spark, d):
    """D06 lab KPIs per department: mean of monthly means, min of mins, max of maxes."""
    return derived.lab_kpis(_q08(spark, d), ["nombre"])


@register("d07_month_label", with_ctes(["station_depto", "gems"], f"""
SELECT nombre, strftime(periodo, '%Y-%m') AS periodo_str, {R('valor_medio')} AS valor_medio FROM ({_Q08_BODY})"""))
def d07(spark, d):
    """D07 ``YYYY-MM`` month labels on the monthly lab series."""
    return _q08(spark, d).select("nombre", derived.month_label("periodo").alias("periodo_str"), "valor_medio")


MONTHS = [f"{y:04d}-{m:02d}" for y in range(Y0, Y1 + 1) for m in range(1, 13)]


def _d08_sql():
    cols = ",\n       ".join(
        f"{R(f'max(CASE WHEN mes = {chr(39)}{m}{chr(39)} THEN valor_medio END)')} AS \"{m}\"" for m in MONTHS)
    return with_ctes(["station_depto", "gems"], f"""
, one AS (SELECT estacion_id, MIN(nombre) AS nombre FROM station_depto GROUP BY 1),
sm AS (SELECT location_id, CAST(date_trunc('month', fecha_inicio) AS DATE) AS periodo, AVG(value) AS m
       FROM gems WHERE code = 'TOTCOLI' AND value IS NOT NULL AND year(fecha_inicio) BETWEEN {Y0} AND {Y1}
       GROUP BY 1, 2),
q10 AS (SELECT one.nombre, strftime(sm.periodo, '%Y-%m') AS mes, AVG(sm.m) AS valor_medio
        FROM sm JOIN one ON sm.location_id = one.estacion_id GROUP BY 1, 2)
SELECT nombre, {cols},
       COUNT(*) OVER () AS n_departamentos
FROM q10 GROUP BY nombre""")


@register("d08_department_month_matrix", _d08_sql())
def d08(spark, d):
    """D08 department x month matrix of monthly means plus the department count."""
    m = lab.monthly_department_means(S.gemsparams(spark, d), _station_depto(spark, d), "TOTCOLI", Y0, Y1)
    return derived.department_month_matrix(m, MONTHS)


@register("d09_national_kpi", with_ctes(["deptos", "grid", "grid_points"], "").rstrip() + __import__(
    "caudal.plans.catalog", fromlist=["_SOIL_CTES"])._SOIL_CTES.replace("{tipo}", "IBH") + f"""
SELECT {R('AVG(valor_medio)')} AS promedio_nacional, {R('MIN(valor_medio)')} AS minimo,
       {R('MAX(valor_medio)')} AS maximo FROM soil""")
def d09(spark, d):
    """D09 national mean/min/max of the soil water index over departments."""
    return derived.national_kpi(_soil(spark, d), "valor_medio")


@register("d12_claims_quality_axis", with_ctes(["oseparam", "reclamos"], f"""
, s AS ({_Q06A_TOT}),
c AS (SELECT departamento_id, CAST(date_trunc('quarter', fecha_inicio) AS DATE) AS periodo, COUNT(*) AS n_reclamos
      FROM reclamos WHERE year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1, 2)
SELECT COALESCE(c.departamento_id, s.departamento_id) AS departamento_id, COALESCE(c.periodo, s.periodo) AS periodo,
       c.n_reclamos, {R('s.pct_presencia')} AS pct_presencia
FROM c FULL OUTER JOIN s ON c.departamento_id = s.departamento_id AND c.periodo = s.periodo"""))
def d12(spark, d):
    """D12 claims and % presence per quarter on one time axis (full outer join)."""
    cq = quality.claims_by_quarter(S.reclamosose(spark, d), Y0, Y1)
    return derived.claims_quality_axis(cq, _series_tot(spark, d))


@register("d13_claims_summary", with_ctes(["deptos", "reclamos", "oseparam"], f"""
, c AS (SELECT departamento_id, COUNT(*) AS total_reclamos FROM reclamos
        WHERE year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1),
q AS (SELECT departamento_id, SUM(CASE WHEN value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS pct
      FROM oseparam WHERE code = 'COLIFORMES TOTALES' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1)
SELECT d.nombre, c.total_reclamos, {R('ROUND(q.pct, 1)')} AS pct_presencia
FROM c JOIN q ON c.departamento_id = q.departamento_id JOIN deptos d ON d.departamento_id = c.departamento_id"""))
def d13(spark, d):
    """D13 claims summary: claims and % presence to one decimal, by claims desc."""
    return derived.claims_summary(quality.claims_vs_quality(
        S.reclamosose(spark, d), S.oseparam(spark, d), S.departamentos(spark, d), Y0, Y1))


def _summary(spark, d):
    return ndci.index_summary(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), Y0, Y1)


@register("d14_top_bottom_bodies", with_ctes(["sentinel", "ndci_loc"], f"""
, s AS ({_SUMMARY}),
r AS (SELECT *, row_number() OVER (ORDER BY ndci_promedio DESC, nombre) AS hi,
             row_number() OVER (ORDER BY ndci_promedio ASC, nombre DESC) AS lo FROM s)
SELECT 'mayores' AS grupo, CAST(hi AS INTEGER) AS posicion, nombre, {R('ROUND(ndci_promedio, 4)')} AS ndci_promedio,
       observaciones FROM r WHERE hi <= 3
UNION ALL
SELECT 'menores', CAST(lo AS INTEGER), nombre, {R('ROUND(ndci_promedio, 4)')}, observaciones FROM r WHERE lo <= 3"""))
def d14(spark, d):
    """D14 top-3 and bottom-3 water bodies by mean NDCI (a top-k report)."""
    out = derived.top_bottom(_summary(spark, d), "ndci_promedio")
    return out.withColumn("posicion", F.col("posicion").cast("int"))


@register("d15_distribution", with_ctes(["sentinel", "ndci_loc"], f"""
, s AS ({_SUMMARY}),
o AS (SELECT l.nombre, s.value AS ndci FROM sentinel s JOIN ndci_loc l ON s.location_id = l.location_id
      WHERE s.code = 'NDCI' AND year(s.fecha_inicio) BETWEEN {Y0} AND {Y1}),
q AS (SELECT nombre, quantile_cont(ndci, 0.25) AS q1, quantile_cont(ndci, 0.5) AS mediana,
             quantile_cont(ndci, 0.75) AS q3, COUNT(*) AS n FROM o GROUP BY 1),
f AS (SELECT q.*, q1 - 1.5 * (q3 - q1) AS lim_inf, q3 + 1.5 * (q3 - q1) AS lim_sup FROM q),
c AS (SELECT o.nombre, CAST(SUM(CASE WHEN o.ndci < f.lim_inf OR o.ndci > f.lim_sup THEN 1 ELSE 0 END) AS BIGINT)
             AS n_atipicos FROM o JOIN f ON o.nombre = f.nombre GROUP BY 1),
ordn AS (SELECT nombre, CAST(row_number() OVER (ORDER BY ndci_promedio DESC, nombre) AS INTEGER) AS orden FROM s)
SELECT f.nombre, {R('q1')} AS q1, {R('mediana')} AS mediana, {R('q3')} AS q3, n, {R('lim_inf')} AS lim_inf,
       {R('lim_sup')} AS lim_sup, c.n_atipicos, ordn.orden
FROM f JOIN c ON f.nombre = c.nombre JOIN ordn ON f.nombre = ordn.nombre"""))
def d15(spark, d):
    """D15 NDCI distribution per water body: quartiles, 1.5 IQR fences, outlier count, summary order."""
    obs = ndci.index_observations(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), Y0, Y1)
    out = derived.distribution(obs, _summary(spark, d))
    return out.withColumn("orden", F.col("orden").cast("int"))


def _d16_sql():
    cols = ",\n       ".join(
        f"{R(f'avg(CASE WHEN mes_label = {chr(39)}{m}{chr(39)} THEN ndci_promedio END)')} AS \"{m}\"" for m in MONTHS)
    return with_ctes(["sentinel", "ndci_loc"], f"""
, s AS ({_SUMMARY}),
mb AS (SELECT nombre, strftime(mes, '%Y-%m') AS mes_label, ndci_promedio FROM ({_MONTHLY_BODY})),
ordn AS (SELECT nombre, CAST(row_number() OVER (ORDER BY ndci_promedio DESC, nombre) AS INTEGER) AS orden FROM s),
p AS (SELECT nombre, {cols} FROM mb GROUP BY nombre)
SELECT p.*, ordn.orden FROM p JOIN ordn ON p.nombre = ordn.nombre""")


@register("d16_body_month_matrix", _d16_sql())
def d16(spark, d):
    """D16 water body x month NDCI matrix in summary order."""
    m = ndci.index_monthly_by_body(S.sentinel_params(spark, d), S.sentinel_locations(spark, d), Y0, Y1)
    out = derived.body_month_matrix(m, _summary(spark, d), MONTHS)
    return out.withColumn("orden", F.col("orden").cast("int"))


@register("d17_summary_table", with_ctes(["sentinel", "ndci_loc"], f"""
SELECT nombre, observaciones, fecha_min, fecha_max, {R('ROUND(ndci_promedio, 4)')} AS ndci_promedio,
       {R('ROUND(ndci_min, 4)')} AS ndci_min, {R('ROUND(ndci_max, 4)')} AS ndci_max,
       {R('ROUND(COALESCE(ndci_desvio, 0.0), 4)')} AS ndci_desvio
FROM ({_SUMMARY})"""))
def d17(spark, d):
    """D17 NDCI summary table rounded to 4 decimals, missing deviation shown as 0."""
    return derived.summary_table(_summary(spark, d))


@register("d18_choropleth_table", with_ctes(["deptos", "oseparam"], f"""
, p AS (SELECT d.nombre, ROUND(SUM(CASE WHEN o.value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS pct
        FROM oseparam o JOIN deptos d ON o.departamento_id = d.departamento_id GROUP BY 1)
SELECT nombre, {R('pct')} AS pct_presencia, {R('ROUND(max(pct) OVER (), 2)')} AS escala_max FROM p"""))
def d18(spark, d):
    """D18 national choropleth table: % presence to 2 decimals and the scale maximum."""
    return derived.choropleth_table(quality.pct_presence_by_department(S.oseparam(spark, d),
                                                                       S.departamentos(spark, d)))


@register("d19_grid_link", _ctes(f"""
SELECT b.nombre, {R('b.lat')} AS loc_lat, {R('b.lon')} AS loc_lon, {R('n.plat')} AS punto_lat,
       {R('n.plon')} AS punto_lon, {R('n.dist_m')} AS dist_m
FROM near n JOIN bodies b ON n.location_id = b.location_id"""))
def d19(spark, d):
    """D19 water body -> nearest grid point link rows with both coordinates."""
    idx = ndci.monthly_index(S.sentinel_params(spark, d), Y0, Y1)
    bodies = ndci.located_bodies(S.sentinel_locations(spark, d)).join(
        idx.select("location_id").distinct(), "location_id", "left_semi")
    reg = _registry(spark, d)
    return derived.grid_link(ndci.nearest_grid_point(bodies, reg), bodies, reg)



@register("geo8_coverage_filter", _ctes(f"""
SELECT b.location_id FROM ndci_loc b
WHERE EXISTS (SELECT 1 FROM gp g WHERE {HAV_BODY_GRID} <= 40000)"""))
def geo8(spark, d):
    """GEO8 keep water bodies that have a grid point within 40 km."""
    bodies = ndci.located_bodies(S.sentinel_locations(spark, d))
    return spatial.with_coverage(bodies, _registry(spark, d), "location_id", "punto_id", 40_000.0).select(
        "location_id")
