"""Grid-based soil water per department (KEY4, Q11, Q21).

Fallbacks, in order:
A. a department polygon containing no grid point uses the grid point nearest
   to its interior representative point;
B. a department whose points have no value in the period uses the flat mean of
   the available point means among the 12 points nearest its representative point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.dates import year_range_filter
from caudal.functions.ids import stable_id
from caudal.operators.spatial import nearest_points, points_in_polygons, representative_points


def grid_registry(grid_points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """KEY4: distinct grid coordinates -> (punto_id, lon, lat).

    ``grid_points`` is the registry's own source (a row per point, or a few), not the fact table.
    """
    pts = grid_points.select(lon, lat).distinct()
    return pts.select(stable_id(lat, lon).alias("punto_id"), F.col(lon).alias("lon"), F.col(lat).alias("lat"))


def point_means(grid_facts: DataFrame, tipo: str, year_from: int, year_to: int) -> DataFrame:
    """Mean of ``tipo`` per grid point over the years, which reach the scan as filters. Facts name their point by
    ``punto_id``, or by coordinates, whose id is hashed once per point after the aggregation."""
    f = grid_facts.filter((F.col("type") == tipo) & year_range_filter("fecha_inicio", year_from, year_to))
    if "punto_id" in grid_facts.columns:
        return f.groupBy("punto_id").agg(F.avg("value").alias("_pm")).filter(F.col("_pm").isNotNull())
    means = f.groupBy("lon", "lat").agg(F.avg("value").alias("_pm")).filter(F.col("_pm").isNotNull())
    return means.select(stable_id("lat", "lon").alias("punto_id"), "_pm")


def soil_by_department(grid_facts: DataFrame, registry: DataFrame, deptos: DataFrame, tipo: str,
                       year_from: int, year_to: int, k_fallback: int = 12,
                       cell_deg: float = 0.25) -> DataFrame:
    """Q11: (nombre, valor_medio) = mean of grid-point means per department, with fallbacks A and B.

    ``grid_facts`` carry (lon, lat, type, fecha_inicio, value), ``registry`` (punto_id, lon, lat). One lazy plan:
    the filtered facts are aggregated once, everything else is registry-sized.
    """
    means = point_means(grid_facts, tipo, year_from, year_to)
    inside = points_in_polygons(registry, deptos, "departamento_id", cell_deg=cell_deg).select(
        "departamento_id", "punto_id", F.lit(0).alias("rank"))
    near = nearest_points(representative_points(deptos, "departamento_id"), registry, "departamento_id", "punto_id",
                          k=k_fallback, qlon="rep_lon", qlat="rep_lat").select("departamento_id", "punto_id", "rank")
    # every department brings the points inside it (rank 0) and its nearest ones; each input is planned once
    points = inside.unionByName(near).join(means, "punto_id", "left")

    def mean(rank):
        return F.avg(F.when(rank, F.col("_pm")))

    rank = F.col("rank")
    vals = points.groupBy("departamento_id").agg(
        F.count_if(rank == 0).alias("_inside"), mean(rank == 0).alias("_own"), mean(rank == 1).alias("_nearest"), mean(rank > 0).alias("_around"))
    value = F.coalesce(F.when(F.col("_inside") > 0, F.col("_own")).otherwise(F.col("_nearest")), F.col("_around"))
    return vals.select("departamento_id", value.alias("valor_medio")).filter(F.col("valor_medio").isNotNull()).join(
        deptos.select("departamento_id", "nombre"), "departamento_id").select("nombre", "valor_medio")


def monthly_point_means(grid_facts: DataFrame, tipo: str, year_from: int, year_to: int,
                        out: str = "pad") -> DataFrame:
    """Q21: monthly mean per grid point (all points at once); the point id is attached after
    the aggregation (one hash per point and month, not per fact)."""
    f = grid_facts.filter((F.col("type") == tipo) & year_range_filter("fecha_inicio", year_from, year_to))
    periodo = F.trunc(F.col("fecha_inicio"), "month").alias("periodo")
    agg = f.groupBy("lon", "lat", periodo).agg(F.avg("value").alias(out))
    return agg.select(stable_id("lat", "lon").alias("punto_id"), "lon", "lat", "periodo", out)
