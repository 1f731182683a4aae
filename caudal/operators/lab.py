"""Station-based measurements per department (Q07-Q10, Q13, Q14).

The station -> department relation is one GEO3 join (``station_departments``),
computed once and reused, instead of one spatial lookup per department.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.dates import year_range_filter
from caudal.operators.spatial import assign_single_polygon, points_in_polygons


def station_departments(stations: DataFrame, deptos: DataFrame, cell_deg: float = 0.25) -> DataFrame:
    """GEO3 for stations: (estacion_id, departamento_id, nombre); overlaps give several rows."""
    pts = stations.select("estacion_id", "lon", "lat")
    return points_in_polygons(pts, deptos, "departamento_id", cell_deg=cell_deg,
                              poly_cols=["nombre"]).select("estacion_id", "departamento_id", "nombre")


def stations_in_department(station_depto: DataFrame, departamento_id=None) -> DataFrame:
    """Q07: station ids inside a department (all departments when None)."""
    out = station_depto
    if departamento_id is not None:
        out = out.filter(F.col("departamento_id") == departamento_id)
    return out.select("departamento_id", "estacion_id")


def monthly_stats(facts: DataFrame, station_depto: DataFrame, code: str, year_from: int,
                  year_to: int) -> DataFrame:
    """Q08: monthly avg/min/max/count of ``value`` per department's station set; null values excluded."""
    f = facts.filter((F.col("code") == code) & F.col("value").isNotNull()
                     & year_range_filter("fecha_inicio", year_from, year_to))
    periodo = F.date_trunc("month", F.col("fecha_inicio")).cast("date").alias("periodo")
    # facts are reduced to (station, month) before they meet the departments
    per = f.groupBy("location_id", periodo).agg(F.sum("value").alias("_sum"), F.min("value").alias("_min"),
                                                F.max("value").alias("_max"), F.count(F.lit(1)).alias("_n"))
    j = per.join(station_depto.select(F.col("estacion_id").alias("location_id"), "nombre"), "location_id")
    return j.groupBy("nombre", "periodo").agg(
        (F.sum("_sum") / F.sum("_n")).alias("valor_medio"), F.min("_min").alias("valor_min"),
        F.max("_max").alias("valor_max"), F.sum("_n").alias("n_mediciones"))


def mean_of_station_means(facts: DataFrame, station_depto: DataFrame, value_col: str, out: str,
                          code: str | None = None, year_from: int | None = None,
                          year_to: int | None = None) -> DataFrame:
    """Q09 / Q13 / Q14: department value = unweighted mean of its stations' means.

    The station mean is aggregated first (one shuffle on location_id), then the
    small per-station result joins the station->department relation.
    """
    f = facts.filter(F.col(value_col).isNotNull())
    if code is not None:
        f = f.filter(F.col("code") == code)
    if year_from is not None:
        f = f.filter(year_range_filter("fecha_inicio", year_from, year_to))
    st = f.groupBy("location_id").agg(F.avg(value_col).alias("_m"))
    j = st.join(station_depto.select(F.col("estacion_id").alias("location_id"), "nombre"), "location_id")
    return j.groupBy("nombre").agg(F.avg("_m").alias(out))


def monthly_department_means(facts: DataFrame, station_depto: DataFrame, code: str,
                             year_from: int, year_to: int) -> DataFrame:
    """Q10: (department, month) mean of station-month means; a station in two departments
    counts for the one with the smallest name."""
    f = facts.filter((F.col("code") == code) & F.col("value").isNotNull()
                     & year_range_filter("fecha_inicio", year_from, year_to))
    periodo = F.date_trunc("month", F.col("fecha_inicio")).cast("date").alias("periodo")
    sm = f.groupBy("location_id", periodo).agg(F.avg("value").alias("_m"))
    one = assign_single_polygon(station_depto, "estacion_id", "departamento_id", "nombre")
    j = sm.join(one.select(F.col("estacion_id").alias("location_id"), "nombre"), "location_id")
    return j.groupBy("nombre", "periodo").agg(F.avg("_m").alias("valor_medio"))
