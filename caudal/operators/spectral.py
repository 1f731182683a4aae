"""Normalised-difference index over pixel tables (SP1-SP5), re-aimed from raster stacks.

Input pixels: (location_id, scene_id, fecha, cloud_cover, lon, lat, scl, red, green, rededge1).
The per-scene median is an ordinary grouped aggregate: a scene's pixel count is
bounded by the sensor footprint, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions.ids import stable_id
from caudal.operators.load import insert_if_absent, skip_loaded_groups

WATER_CLASS = 6
MAX_CLOUD = 20.0

# Index formulas, (a - b) / (a + b) per code.
INDICES = {
    "NDCI": ("rededge1", "red"),
    "NDTI": ("red", "green"),
}


def select_scenes(pixels: DataFrame, bounds: DataFrame, date_from: str, date_to: str,
                  max_cloud: float = MAX_CLOUD) -> DataFrame:
    """SP1: scenes in the date range with cloud cover strictly below ``max_cloud``, pixels
    inside the location's bounding box (equi-join on location + range predicate)."""
    p = pixels.filter((F.col("fecha") >= F.lit(date_from).cast("date")) & (F.col("fecha") <= F.lit(date_to).cast("date"))
                      & (F.col("cloud_cover") < max_cloud))
    b = bounds.select("location_id", "min_lon", "max_lon", "min_lat", "max_lat")
    j = p.join(b, "location_id")
    return j.filter(F.col("lon").between(F.col("min_lon"), F.col("max_lon"))
                    & F.col("lat").between(F.col("min_lat"), F.col("max_lat"))).drop(
        "min_lon", "max_lon", "min_lat", "max_lat")


def water_mask(pixels: DataFrame, water_class: int = WATER_CLASS) -> DataFrame:
    """SP2: keep water pixels."""
    return pixels.filter(F.col("scl") == water_class)


def index_value(code: str) -> Column:
    """SP3: (a - b) / (a + b) for the code's bands; a zero denominator gives null."""
    a, b = INDICES[code]
    return F.try_divide(F.col(a) - F.col(b), F.col(a) + F.col(b))


def scene_medians(pixels: DataFrame, code: str) -> DataFrame:
    """SP3 + SP4: median index per (location, scene, date) ignoring missing values;
    scenes without any value are dropped. The middle values are found by rank in a sort that spills, so no task holds a
    scene's pixels in memory."""
    v = pixels.select("location_id", "scene_id", "fecha", index_value(code).alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    scene = ["location_id", "scene_id", "fecha"]
    sizes = v.groupBy(*scene).agg(F.count(F.lit(1)).alias("n"))
    ranked = v.withColumn("r", F.row_number().over(Window.partitionBy(*scene).orderBy("v"))).join(sizes, scene)
    middle = (F.col("r") >= F.floor((F.col("n") + 1) / 2)) & (F.col("r") <= F.ceil((F.col("n") + 1) / 2))
    return ranked.filter(middle).groupBy(*scene).agg(F.avg("v").alias("valor"))


def index_rows(pixels: DataFrame, bounds: DataFrame, code: str, date_from: str, date_to: str,
               loaded: DataFrame | None = None) -> DataFrame:
    """SP5: SP1-SP4 for every location not yet loaded for ``code`` (LOAD5), as keyed
    ``sentinel_params`` rows ready for insert-if-absent (LOAD1)."""
    px = select_scenes(pixels, bounds, date_from, date_to)
    if loaded is not None:
        px = skip_loaded_groups(px.withColumn("code", F.lit(code)), loaded, ["location_id", "code"]).drop("code")
    med = scene_medians(water_mask(px), code)
    rows = med.select("location_id", F.lit(code).alias("code"), F.col("fecha").alias("fecha_inicio"),
                      F.col("fecha").alias("fecha_fin"), "valor", F.lit("DIA").alias("granularidad"), "scene_id")
    rows = rows.withColumn("id", stable_id("location_id", "code", "fecha_inicio", "fecha_fin", "valor",
                                           F.lit("DIA")))
    return rows


def load_index(pixels: DataFrame, bounds: DataFrame, code: str, date_from: str, date_to: str,
               target: DataFrame) -> DataFrame:
    """SP5 end to end: rows to append to the index table (groups already loaded skipped,
    first row per id wins, ids already present skipped)."""
    rows = index_rows(pixels, bounds, code, date_from, date_to,
                      loaded=target.select("location_id", "code"))
    return insert_if_absent(rows.withColumnRenamed("scene_id", "pos"), target.select("id"))
