"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator ID,
each with a DuckDB oracle statement over the same parquet tables.

Every query reads whole driver tables (through ``surrogates``); parameters such
as year ranges or codes are the feature's own arguments, fixed here once.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from caudal.operators import quality
from caudal.plans import surrogates as S
from caudal.plans.oracle import with_ctes
from caudal.plans.registry import CODES, ORACLE, QUERIES, Y0, Y1, R, register  # noqa: F401


# ============================================================ quality samples (Q01-Q06)

@register("q01_departments_with_data", with_ctes(["deptos", "oseparam"], """
SELECT departamento_id, nombre FROM deptos
WHERE departamento_id IN (SELECT departamento_id FROM oseparam)"""))
def q01(spark, d):
    """Q01 departments that have samples."""
    return quality.departments_with_data(S.oseparam(spark, d), S.departamentos(spark, d))


@register("q02_pct_presence_all", with_ctes(["deptos", "oseparam"], f"""
SELECT d.nombre, {R("SUM(CASE WHEN o.value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*)")} AS pct_presencia
FROM oseparam o JOIN deptos d ON o.departamento_id = d.departamento_id
GROUP BY d.nombre"""))
def q02(spark, d):
    """Q02 % Presencia per department, all codes, all years, all categories in the denominator."""
    return quality.pct_presence_by_department(S.oseparam(spark, d), S.departamentos(spark, d))


@register("q02_pct_presence_code", with_ctes(["deptos", "oseparam"], f"""
SELECT d.nombre, {R("SUM(CASE WHEN o.value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*)")} AS pct_presencia
FROM oseparam o JOIN deptos d ON o.departamento_id = d.departamento_id
WHERE o.code = 'COLIFORMES FECALES'
GROUP BY d.nombre"""))
def q02c(spark, d):
    """Q02 with the optional code filter."""
    return quality.pct_presence_by_department(S.oseparam(spark, d), S.departamentos(spark, d),
                                              code="COLIFORMES FECALES")


@register("q03_seasonal_pattern", with_ctes(["oseparam"], f"""
SELECT CAST(quarter(fecha_inicio) AS INTEGER) AS trimestre, COUNT(*) AS total,
       CAST(SUM(CASE WHEN value_cat = 'Presencia' THEN 1 ELSE 0 END) AS BIGINT) AS presencias,
       {R("ROUND(SUM(CASE WHEN value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2)")} AS pct_presencia,
       CASE CAST(quarter(fecha_inicio) AS INTEGER) WHEN 1 THEN 'Q1 (Ene–Mar)' WHEN 2 THEN 'Q2 (Abr–Jun)'
            WHEN 3 THEN 'Q3 (Jul–Sep)' ELSE 'Q4 (Oct–Dic)' END AS trimestre_label
FROM oseparam
WHERE code = 'COLIFORMES TOTALES' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1}
  AND value_cat IN ('Presencia', 'Ausencia')
GROUP BY 1, 5"""))
def q03(spark, d):
    """Q03 seasonal pattern per calendar quarter."""
    return quality.seasonal_pattern(S.oseparam(spark, d), "COLIFORMES TOTALES", Y0, Y1)


@register("q04_pct_presence_period", with_ctes(["deptos", "oseparam"], f"""
SELECT d.nombre, {R("SUM(CASE WHEN o.value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*)")} AS pct_presencia
FROM oseparam o JOIN deptos d ON o.departamento_id = d.departamento_id
WHERE o.code = 'COLIFORMES TOTALES' AND year(o.fecha_inicio) BETWEEN {Y0} AND {Y1}
  AND o.value_cat IN ('Presencia', 'Ausencia')
GROUP BY d.nombre"""))
def q04(spark, d):
    """Q04 % Presencia per department in a period, Presencia/Ausencia only."""
    return quality.pct_presence_by_department(S.oseparam(spark, d), S.departamentos(spark, d),
                                              "COLIFORMES TOTALES", Y0, Y1, only_binary=True)


_Q05_SQL = f"""
SELECT departamento_id, CAST(date_trunc('quarter', fecha_inicio) AS DATE) AS periodo, code, value_cat,
       COUNT(*) AS total
FROM oseparam
WHERE year(fecha_inicio) BETWEEN {Y0} AND {Y1}
  AND code IN ('COLIFORMES TOTALES', 'COLIFORMES FECALES') AND value_cat IN ('Presencia', 'Ausencia')
GROUP BY 1, 2, 3, 4"""


@register("q05_quality_evolution", with_ctes(["oseparam"], _Q05_SQL))
def q05(spark, d):
    """Q05 quarterly counts per (department, quarter, code, category)."""
    return quality.quality_evolution(S.oseparam(spark, d), Y0, Y1, CODES)


_Q06A_SQL = f"""
, ev AS ({_Q05_SQL})
SELECT departamento_id, periodo, code,
       CAST(year(periodo) AS VARCHAR) || ' Q' || CAST(quarter(periodo) AS VARCHAR) AS periodo_str,
       CAST(SUM(total) AS BIGINT) AS total_muestras,
       {R("COALESCE(SUM(CASE WHEN value_cat = 'Presencia' THEN total END), 0) * 100.0 / SUM(total)")} AS pct_presencia
FROM ev GROUP BY 1, 2, 3, 4"""


def _q06a_sql():
    base = with_ctes(["oseparam"], "")
    return base.rstrip() + _Q06A_SQL


ORACLE_Q06A = _q06a_sql()


@register("q06a_quality_series", ORACLE_Q06A)
def q06a(spark, d):
    """Q06a quarterly % presence per department and code (the M0 flagship)."""
    return quality.quality_series(quality.quality_evolution(S.oseparam(spark, d), Y0, Y1, CODES))


@register("q06b_quality_year_table", with_ctes(["oseparam"], "").rstrip() + f"""
, ev AS ({_Q05_SQL}),
s AS (
  SELECT departamento_id, periodo, code,
         COALESCE(SUM(CASE WHEN value_cat = 'Presencia' THEN total END), 0) * 100.0 / SUM(total) AS pct
  FROM ev GROUP BY 1, 2, 3)
SELECT departamento_id, CAST(year(periodo) AS INTEGER) AS anio,
       {R("ROUND(AVG(CASE WHEN code = 'COLIFORMES TOTALES' THEN pct END), 1)")} AS "COLIFORMES TOTALES",
       {R("ROUND(AVG(CASE WHEN code = 'COLIFORMES FECALES' THEN pct END), 1)")} AS "COLIFORMES FECALES"
FROM s GROUP BY 1, 2""")
def q06b(spark, d):
    """Q06b year x code pivot of mean quarterly % (1 decimal)."""
    ev = quality.quality_evolution(S.oseparam(spark, d), Y0, Y1, CODES)
    return quality.quality_year_table(quality.quality_series(ev), CODES)


@register("q12_contam_ose", with_ctes(["deptos", "oseparam"], f"""
SELECT d.nombre, {R("SUM(CASE WHEN o.value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*)")} AS pct_ose
FROM oseparam o JOIN deptos d ON o.departamento_id = d.departamento_id
WHERE o.code = 'COLIFORMES TOTALES' AND year(o.fecha_inicio) BETWEEN {Y0} AND {Y1}
GROUP BY d.nombre"""))
def q12(spark, d):
    """Q12 contamination (samples): % Presencia of COLIFORMES TOTALES, every category counted."""
    return quality.pct_presence_by_department(S.oseparam(spark, d), S.departamentos(spark, d),
                                              "COLIFORMES TOTALES", Y0, Y1, out="pct_ose")


# ============================================================ claims (Q17-Q19)

@register("q17_claims_by_department", with_ctes(["deptos", "reclamos"], f"""
SELECT d.nombre, COUNT(*) AS total_reclamos
FROM reclamos r JOIN deptos d ON r.departamento_id = d.departamento_id
WHERE year(r.fecha_inicio) BETWEEN {Y0} AND {Y1}
GROUP BY d.nombre"""))
def q17(spark, d):
    """Q17 claims per department."""
    return quality.claims_by_department(S.reclamosose(spark, d), S.departamentos(spark, d), Y0, Y1)


@register("q18_claims_by_quarter", with_ctes(["reclamos"], f"""
SELECT departamento_id, CAST(date_trunc('quarter', fecha_inicio) AS DATE) AS periodo, COUNT(*) AS n_reclamos
FROM reclamos WHERE year(fecha_inicio) BETWEEN {Y0} AND {Y1}
GROUP BY 1, 2"""))
def q18(spark, d):
    """Q18 claims per quarter and department."""
    return quality.claims_by_quarter(S.reclamosose(spark, d), Y0, Y1)


@register("q19_claims_vs_quality", with_ctes(["deptos", "reclamos", "oseparam"], f"""
, c AS (SELECT departamento_id, COUNT(*) AS total_reclamos FROM reclamos
        WHERE year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1),
q AS (SELECT departamento_id,
             SUM(CASE WHEN value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS pct
      FROM oseparam WHERE code = 'COLIFORMES TOTALES' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1)
SELECT d.nombre, c.total_reclamos, {R("q.pct")} AS pct_presencia
FROM c JOIN q ON c.departamento_id = q.departamento_id JOIN deptos d ON d.departamento_id = c.departamento_id
"""))
def q19(spark, d):
    """Q19 claims vs % Presencia per department (inner join), claims desc."""
    return quality.claims_vs_quality(S.reclamosose(spark, d), S.oseparam(spark, d), S.departamentos(spark, d), Y0, Y1)


# ============================================================ stations and departments (GEO3, Q07-Q10, Q13, Q14)

from caudal.functions.geometry import haversine_m  # noqa: E402
from caudal.operators import lab, risk, soil  # noqa: E402
from caudal.plans.oracle import haversine_sql  # noqa: E402


def _station_depto(spark, d):
    return lab.station_departments(S.estaciones(spark, d), S.departamentos(spark, d))


@register("geo3_points_in_polygons", with_ctes(["station_depto"], """
SELECT estacion_id, departamento_id, nombre FROM station_depto"""))
def geo3(spark, d):
    """GEO3 stations inside department polygons (overlaps listed once per polygon)."""
    return _station_depto(spark, d)


@register("q07_stations_by_department", with_ctes(["station_depto"], """
SELECT departamento_id, estacion_id FROM station_depto"""))
def q07(spark, d):
    """Q07 station ids per department."""
    return lab.stations_in_department(_station_depto(spark, d))


@register("q08_lab_monthly_stats", with_ctes(["station_depto", "gems"], f"""
SELECT sd.nombre, CAST(date_trunc('month', g.fecha_inicio) AS DATE) AS periodo,
       {R("AVG(g.value)")} AS valor_medio, {R("MIN(g.value)")} AS valor_min, {R("MAX(g.value)")} AS valor_max,
       COUNT(*) AS n_mediciones
FROM gems g JOIN station_depto sd ON g.location_id = sd.estacion_id
WHERE g.code = 'TOTCOLI' AND g.value IS NOT NULL AND year(g.fecha_inicio) BETWEEN {Y0} AND {Y1}
GROUP BY 1, 2"""))
def q08(spark, d):
    """Q08 monthly avg/min/max/count per department station set, one code."""
    return lab.monthly_stats(S.gemsparams(spark, d), _station_depto(spark, d), "TOTCOLI", Y0, Y1)


_STATION_MEAN_SQL = """
SELECT sd.nombre, {val} AS {out}
FROM (SELECT location_id, AVG({col}) AS m FROM {tbl} WHERE {col} IS NOT NULL {where} GROUP BY 1) st
JOIN station_depto sd ON st.location_id = sd.estacion_id
GROUP BY sd.nombre"""


@register("q09_lab_department_mean", with_ctes(["station_depto", "gems"], _STATION_MEAN_SQL.format(
    val=R("AVG(st.m)"), out="valor_medio", col="value", tbl="gems", where="AND code = 'ECOLI'")))
def q09(spark, d):
    """Q09 department mean of station means, one code, no period filter."""
    return lab.mean_of_station_means(S.gemsparams(spark, d), _station_depto(spark, d), "value",
                                     "valor_medio", code="ECOLI")


@register("q10_lab_department_month", with_ctes(["station_depto", "gems"], f"""
, one AS (SELECT estacion_id, MIN(nombre) AS nombre FROM station_depto GROUP BY 1),
sm AS (SELECT location_id, CAST(date_trunc('month', fecha_inicio) AS DATE) AS periodo, AVG(value) AS m
       FROM gems WHERE code = 'TOTCOLI' AND value IS NOT NULL AND year(fecha_inicio) BETWEEN {Y0} AND {Y1}
       GROUP BY 1, 2)
SELECT one.nombre, sm.periodo, {R("AVG(sm.m)")} AS valor_medio
FROM sm JOIN one ON sm.location_id = one.estacion_id GROUP BY 1, 2"""))
def q10(spark, d):
    """Q10 (department, month) mean of station-month means; overlapping station -> smallest name."""
    return lab.monthly_department_means(S.gemsparams(spark, d), _station_depto(spark, d), "TOTCOLI", Y0, Y1)


def _q13(spark, d):
    return lab.mean_of_station_means(S.gemsparams(spark, d), _station_depto(spark, d), "value", "val_gems",
                                     code="TOTCOLI", year_from=Y0, year_to=Y1)


def _q14(spark, d):
    return lab.mean_of_station_means(S.registrotempprec(spark, d), _station_depto(spark, d), "pluviometro",
                                     "val_precip", year_from=Y0, year_to=Y1)


_Q13_BODY = _STATION_MEAN_SQL.format(val="AVG(st.m)", out="val_gems", col="value", tbl="gems",
                                     where=f"AND code = 'TOTCOLI' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1}")
_Q14_BODY = _STATION_MEAN_SQL.format(val="AVG(st.m)", out="val_precip", col="pluviometro", tbl="registro",
                                     where=f"AND year(fecha_inicio) BETWEEN {Y0} AND {Y1}")


@register("q13_contam_lab", with_ctes(["station_depto", "gems"], f"SELECT nombre, {R('val_gems')} AS val_gems FROM ({_Q13_BODY})"))
def q13(spark, d):
    """Q13 contamination (lab): mean of station means of TOTCOLI in the period."""
    return _q13(spark, d)


@register("q14_rain_by_department", with_ctes(["station_depto", "registro"], f"SELECT nombre, {R('val_precip')} AS val_precip FROM ({_Q14_BODY})"))
def q14(spark, d):
    """Q14 rain per department: mean of station mean rainfall in the period."""
    return _q14(spark, d)


# ============================================================ grid soil water (KEY4, Q11, Q21) and risk (Q15, Q16)

def _grid(spark, d):
    """Grid facts; the point id is KEY1 of (lat, lon), attached after aggregations where possible."""
    return S.puntomedicion(spark, d)


def _registry(spark, d):
    return soil.grid_registry(S.grid_points(spark, d))


def _soil(spark, d, tipo="IBH"):
    return soil.soil_by_department(_grid(spark, d), _registry(spark, d), S.departamentos(spark, d), tipo, Y0, Y1)


_SOIL_CTES = f"""
, gp AS (SELECT lon, lat FROM grid_points),
pip AS (
  SELECT d.departamento_id, g.lon, g.lat FROM gp g JOIN deptos d ON (
       (d.shape = 0 AND g.lon > d.x0 + 0.1 AND g.lon < d.x0 + 1.2 AND g.lat > d.y0 + 0.1 AND g.lat < d.y0 + 0.9)
    OR (d.shape = 1 AND abs(g.lon - (d.x0 + 0.5)) + abs(g.lat - (d.y0 + 0.5)) < 0.45)
    OR (d.shape = 2 AND ((g.lon > d.x0 + 0.1 AND g.lon < d.x0 + 0.5 AND g.lat > d.y0 + 0.1 AND g.lat < d.y0 + 0.9)
                      OR (g.lon >= d.x0 + 0.5 AND g.lon < d.x0 + 0.9 AND g.lat > d.y0 + 0.1 AND g.lat < d.y0 + 0.5)))
    OR (d.shape = 3 AND g.lon > d.x0 + 0.72 AND g.lon < d.x0 + 0.8 AND g.lat > d.y0 + 0.72 AND g.lat < d.y0 + 0.8))),
rep AS (
  SELECT departamento_id,
         CASE shape WHEN 0 THEN x0 + 0.65 WHEN 1 THEN x0 + 0.5 WHEN 2 THEN x0 + 0.3 ELSE x0 + 0.76 END AS rlon,
         CASE shape WHEN 3 THEN y0 + 0.76 ELSE y0 + 0.5 END AS rlat
  FROM deptos),
nn AS (
  SELECT r.departamento_id, g.lon, g.lat,
         row_number() OVER (PARTITION BY r.departamento_id
                            ORDER BY {haversine_sql('r.rlon', 'r.rlat', 'g.lon', 'g.lat')}, g.lat, g.lon) AS rn
  FROM rep r CROSS JOIN gp g),
members AS (
  SELECT departamento_id, lon, lat FROM pip
  UNION
  SELECT departamento_id, lon, lat FROM nn
  WHERE rn = 1 AND departamento_id NOT IN (SELECT departamento_id FROM pip)),
pm AS (SELECT lon, lat, AVG(value) AS m FROM grid
       WHERE type = '{{tipo}}' AND year(fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1, 2),
direct AS (SELECT mb.departamento_id, AVG(pm.m) AS v FROM members mb JOIN pm USING (lon, lat) GROUP BY 1),
fb AS (SELECT n.departamento_id, AVG(pm.m) AS v FROM nn n JOIN pm USING (lon, lat)
       WHERE n.rn <= 12 AND n.departamento_id IN (SELECT departamento_id FROM members)
         AND n.departamento_id NOT IN (SELECT departamento_id FROM direct) GROUP BY 1),
soil AS (SELECT d.nombre, x.v AS valor_medio
         FROM (SELECT * FROM direct UNION ALL SELECT * FROM fb) x JOIN deptos d USING (departamento_id))"""


def _soil_sql(tipo: str, body: str, extra: list[str] | None = None) -> str:
    return with_ctes(["deptos", "grid", "grid_points"] + (extra or []), "").rstrip() + _SOIL_CTES.replace("{tipo}", tipo) + body


@register("key4_grid_registry", with_ctes(["grid_points"], """
SELECT lon, lat, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
       || '-' || substr(h, 21, 12) AS punto_id
FROM (SELECT lon, lat, md5(CAST(lat AS VARCHAR) || '|' || CAST(lon AS VARCHAR)) AS h FROM grid_points)"""))
def key4(spark, d):
    """KEY4 grid point registry: distinct coordinates and their ids (KEY1 of lat, lon)."""
    return _registry(spark, d).select("lon", "lat", "punto_id")


@register("q11_soil_by_department", _soil_sql("IBH", f"""
SELECT nombre, {R('valor_medio')} AS valor_medio FROM soil"""))
def q11(spark, d):
    """Q11 soil water index per department with fallbacks A (nearest point) and B (12 nearest)."""
    return _soil(spark, d, "IBH")


@register("q11_soil_anr", _soil_sql("ANR", f"""
SELECT nombre, {R('valor_medio')} AS valor_medio FROM soil"""))
def q11b(spark, d):
    """Q11 for the ANR grid type."""
    return _soil(spark, d, "ANR")


_RISK_BODY = f"""
, ose AS (
  SELECT d.nombre, SUM(CASE WHEN o.value_cat = 'Presencia' THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS pct_ose
  FROM oseparam o JOIN deptos d ON o.departamento_id = d.departamento_id
  WHERE o.code = 'COLIFORMES TOTALES' AND year(o.fecha_inicio) BETWEEN {Y0} AND {Y1} GROUP BY 1),
labm AS ({_Q13_BODY}),
rain AS ({_Q14_BODY}),
j AS (SELECT * FROM soil FULL OUTER JOIN ose USING (nombre) FULL OUTER JOIN labm USING (nombre)
      FULL OUTER JOIN rain USING (nombre)),
n AS (
  SELECT *,
    CASE WHEN pct_ose IS NULL THEN NULL WHEN max(pct_ose) OVER () = min(pct_ose) OVER () THEN 0.0
         ELSE (pct_ose - min(pct_ose) OVER ()) / (max(pct_ose) OVER () - min(pct_ose) OVER ()) END AS on_,
    CASE WHEN val_gems IS NULL THEN NULL WHEN max(val_gems) OVER () = min(val_gems) OVER () THEN 0.0
         ELSE (val_gems - min(val_gems) OVER ()) / (max(val_gems) OVER () - min(val_gems) OVER ()) END AS gn_
  FROM j),
c AS (
  SELECT *, CASE WHEN on_ IS NULL AND gn_ IS NULL THEN NULL
                 ELSE (0.0 + COALESCE(on_, 0) + COALESCE(gn_, 0))
                      / (CAST(on_ IS NOT NULL AS INTEGER) + CAST(gn_ IS NOT NULL AS INTEGER)) END AS pct_contam
  FROM n),
q AS (
  SELECT *, quantile_cont(pct_contam, 0.66) OVER () AS p66c, quantile_cont(val_precip, 0.66) OVER () AS p66p,
         quantile_cont(valor_medio, 0.33) OVER () AS p33s
  FROM c),
r AS (
  SELECT nombre,
         COALESCE(pct_contam > p66c, false) AS condicion_contam,
         COALESCE(val_precip > p66p, false) AS condicion_precip,
         COALESCE(valor_medio < p33s, false) AS condicion_suelo,
         pct_ose, val_gems, val_precip, valor_medio AS val_suelo
  FROM q WHERE nombre IS NOT NULL),
risk AS (
  SELECT nombre, CAST(condicion_contam AS INTEGER) + CAST(condicion_precip AS INTEGER)
                 + CAST(condicion_suelo AS INTEGER) AS score,
         condicion_contam, condicion_precip, condicion_suelo, pct_ose, val_gems, val_precip, val_suelo
  FROM r)"""


def _risk(spark, d):
    ose = quality.pct_presence_by_department(S.oseparam(spark, d), S.departamentos(spark, d),
                                             "COLIFORMES TOTALES", Y0, Y1, out="pct_ose")
    return risk.risk_by_department(_soil(spark, d), ose, _q13(spark, d), _q14(spark, d))


@register("q16_risk_by_department", _soil_sql("IBH", _RISK_BODY + f"""
SELECT nombre, score, condicion_contam, condicion_precip, condicion_suelo, {R('pct_ose')} AS pct_ose,
       {R('val_gems')} AS val_gems, {R('val_precip')} AS val_precip, {R('val_suelo')} AS val_suelo
FROM risk""", ["oseparam", "station_depto", "gems", "registro"]))
def q16(spark, d):
    """Q16 composite risk score per department (Q11 + Q12 + Q13 + Q14, min-max, quantiles)."""
    return _risk(spark, d)


@register("q15_minmax_normalise", _soil_sql("IBH", _RISK_BODY + f"""
SELECT nombre, {R('on_')} AS pct_ose_norm, {R('gn_')} AS val_gems_norm FROM n WHERE nombre IS NOT NULL AND (pct_ose IS NOT NULL OR val_gems IS NOT NULL)""",
    ["oseparam", "station_depto", "gems", "registro"]))
def q15(spark, d):
    """Q15 min-max normalisation of the contamination parts over the departments that have one."""
    ose = quality.pct_presence_by_department(S.oseparam(spark, d), S.departamentos(spark, d),
                                             "COLIFORMES TOTALES", Y0, Y1, out="pct_ose")
    j = ose.join(_q13(spark, d), "nombre", "full")
    return j.select("nombre", risk.minmax("pct_ose").alias("pct_ose_norm"),
                    risk.minmax("val_gems").alias("val_gems_norm")).filter(F.col("nombre").isNotNull())


@register("d10_risk_level_counts", _soil_sql("IBH", _RISK_BODY + """
, lv AS (SELECT * FROM (VALUES (0, 'Sin señales'), (1, 'Bajo'), (2, 'Medio'), (3, 'Alto')) t(score, nivel))
SELECT lv.score, lv.nivel, COUNT(risk.nombre) AS n_departamentos
FROM lv LEFT JOIN risk ON lv.score = risk.score GROUP BY 1, 2""", ["oseparam", "station_depto", "gems", "registro"]))
def d10(spark, d):
    """D10 departments per risk score 0..3 with level labels."""
    return risk.risk_level_counts(_risk(spark, d))


@register("d11_risk_detail", _soil_sql("IBH", _RISK_BODY + f"""
SELECT nombre,
       CASE score WHEN 0 THEN 'Sin señales' WHEN 1 THEN 'Bajo' WHEN 2 THEN 'Medio' ELSE 'Alto' END AS nivel,
       score,
       CASE WHEN NOT (condicion_contam OR condicion_precip OR condicion_suelo) THEN 'sin señales activas'
            ELSE concat_ws(', ', CASE WHEN condicion_contam THEN 'contaminación' END,
                                 CASE WHEN condicion_precip THEN 'precipitación' END,
                                 CASE WHEN condicion_suelo THEN 'suelo' END) END AS senales,
       {R('ROUND(pct_ose, 2)')} AS pct_ose, {R('ROUND(val_gems, 2)')} AS val_gems,
       {R('ROUND(val_precip, 2)')} AS val_precip, {R('ROUND(val_suelo, 2)')} AS val_suelo,
       COALESCE(printf('%.1f', pct_ose) || '%', '—') AS tip_ose,
       COALESCE(printf('%.2f', val_gems) || ' MPN/100ml', '—') AS tip_gems,
       COALESCE(printf('%.1f', val_precip) || ' mm/día', 'sin datos') AS tip_precip,
       COALESCE(printf('%.2f', val_suelo), '—') AS tip_ibh
FROM risk""", ["oseparam", "station_depto", "gems", "registro"]))
def d11(spark, d):
    """D10/D11 risk detail table: level, active signals, display strings, by score desc."""
    return risk.risk_detail(_risk(spark, d))

from caudal.plans import catalog_bodies  # noqa: E402,F401  (registers more queries)

from caudal.plans import catalog_ingest  # noqa: E402,F401  (registers ingest queries)

from caudal.plans import catalog_audit  # noqa: E402,F401  (registers spectral and audit queries)

from caudal.plans import catalog_sources  # noqa: E402,F401  (registers source/sink queries)

from caudal.plans import catalog_streaming  # noqa: E402,F401  (registers streaming queries)
