"""Water-body index series and their relation to grid soil water (Q20, Q22-Q30).

Everything is computed for all water bodies at once (grouped by location) rather
than one location per call. Month ranges per location are bounded by the time
span, not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions.dates import year_range_filter
from caudal.operators.spatial import nearest_points, polygon_centroids, with_coverage

PAD_MAX_DISTANCE_M = 40_000.0


def locations_with_code(params: DataFrame, code: str = "NDCI") -> DataFrame:
    """Q30: distinct locations that have values for ``code``."""
    return params.filter(F.col("code") == code).select("location_id").distinct()


def naive_period(c: str) -> F.Column:
    """Q30: timestamps normalised to naive (no time zone) values."""
    return F.col(c).cast("timestamp_ntz")


def located_bodies(locations: DataFrame) -> DataFrame:
    """Water bodies with their polygon centroid (GEO5)."""
    cent = polygon_centroids(locations, "location_id")
    return locations.select("location_id", "nombre").join(cent, "location_id").select(
        "location_id", "nombre", F.col("centroid_lat").alias("lat"), F.col("centroid_lon").alias("lon"))


def locations_with_index(params: DataFrame, locations: DataFrame, registry: DataFrame,
                         code: str = "NDCI", max_distance_m: float = PAD_MAX_DISTANCE_M) -> DataFrame:
    """Q20: locations with index values, name and centroid, that have a grid point within range (GEO8)."""
    bodies = located_bodies(locations).join(locations_with_code(params, code), "location_id", "left_semi")
    return with_coverage(bodies, registry, "location_id", "punto_id", max_distance_m)


def monthly_index(params: DataFrame, year_from: int, year_to: int, code: str = "NDCI",
                  out: str = "ndci") -> DataFrame:
    """Q22: monthly mean per location (inclusive year range)."""
    f = params.filter((F.col("code") == code) & year_range_filter("fecha_inicio", year_from, year_to))
    return f.groupBy("location_id", F.trunc("fecha_inicio", "month").alias("periodo")).agg(
        F.avg("value").alias(out))


def _named(df: DataFrame, locations: DataFrame) -> DataFrame:
    return df.join(locations.select("location_id", "nombre"), "location_id")


def index_summary(params: DataFrame, locations: DataFrame, year_from: int, year_to: int,
                  code: str = "NDCI") -> DataFrame:
    """Q23: per water body n, first/last date, avg/min/max/sample stddev; by mean desc."""
    f = params.filter((F.col("code") == code) & year_range_filter("fecha_inicio", year_from, year_to))
    agg = f.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("observaciones"), F.min("fecha_inicio").alias("fecha_min"),
        F.max("fecha_inicio").alias("fecha_max"), F.avg("value").alias("ndci_promedio"),
        F.min("value").alias("ndci_min"), F.max("value").alias("ndci_max"),
        F.stddev_samp("value").alias("ndci_desvio"))
    return _named(agg, locations).select(
        "nombre", "observaciones", "fecha_min", "fecha_max", "ndci_promedio", "ndci_min", "ndci_max",
        "ndci_desvio").orderBy(F.col("ndci_promedio").desc(), "nombre")


def index_monthly_by_body(params: DataFrame, locations: DataFrame, year_from: int, year_to: int,
                          code: str = "NDCI") -> DataFrame:
    """Q24: per (water body, month) observation count and mean."""
    f = params.filter((F.col("code") == code) & year_range_filter("fecha_inicio", year_from, year_to))
    agg = f.groupBy("location_id", F.trunc("fecha_inicio", "month").alias("mes")).agg(
        F.count(F.lit(1)).alias("observaciones"), F.avg("value").alias("ndci_promedio"))
    return _named(agg, locations).select("nombre", "mes", "observaciones", "ndci_promedio")


def index_observations(params: DataFrame, locations: DataFrame, year_from: int, year_to: int,
                       code: str = "NDCI") -> DataFrame:
    """Q25: raw observations with the water body name."""
    f = params.filter((F.col("code") == code) & year_range_filter("fecha_inicio", year_from, year_to))
    return _named(f.select("location_id", "fecha_inicio", F.col("value").alias("ndci")), locations).select(
        "nombre", "fecha_inicio", "ndci")


def monthly_gap_fill(df: DataFrame, key: str, period: str = "periodo") -> DataFrame:
    """Q26: one row per month between each key's first and last month; absent months are null rows.

    One pass over ``df``: each row brings the empty months up to its key's next month along. A key's rows are its
    months, which the time span bounds.
    """
    others = [c for c in df.columns if c not in (key, period)]
    following = F.lead(period).over(Window.partitionBy(key).orderBy(period))
    months = F.sequence(F.col(period), F.greatest(F.add_months(F.coalesce("_next", F.add_months(period, 1)), -1), F.col(period)),
                        F.expr("INTERVAL 1 MONTH"))
    rows = df.withColumn("_next", following).select(
        key, F.posexplode(months).alias("_i", "_m"), *others)
    return rows.select(key, F.col("_m").cast("date").alias(period), *[F.when(F.col("_i") == 0, F.col(c)).alias(c) for c in others])


def lag_join(pad: DataFrame, idx: DataFrame, key: str, lag_months: int = 1) -> DataFrame:
    """Q27: shift ``pad`` forward by ``lag_months``, full outer join with ``idx`` on the month,
    keep the original pad month as ``pad_periodo``, then gap-fill (Q26)."""
    month = naive_period("periodo").cast("date")  # both sides without a time zone (Q30)
    p = pad.select(key, month.alias("pad_periodo"), F.add_months(month, lag_months).alias("_lagged"), "pad")
    i = idx.select(F.col(key).alias("_k"), month.alias("_p"), "ndci")
    j = p.join(i, (p[key] == i["_k"]) & (p["_lagged"] == i["_p"]), "full")
    merged = j.select(F.coalesce(key, "_k").alias(key), F.coalesce("_p", "_lagged").alias("periodo"),
                      "pad", "pad_periodo", "ndci")
    return monthly_gap_fill(merged, key).select(key, "periodo", "pad", "pad_periodo", "ndci")


def nearest_grid_point(bodies: DataFrame, registry: DataFrame,
                       max_distance_m: float = PAD_MAX_DISTANCE_M) -> DataFrame:
    """Nearest grid point of each water body centroid within range (GEO4, k=1)."""
    return nearest_points(bodies, registry, "location_id", "punto_id", k=1, max_distance_m=max_distance_m)


def pad_vs_index(params: DataFrame, locations: DataFrame, registry: DataFrame, pad_monthly: DataFrame,
                 year_from: int, year_to: int, lag_months: int = 1) -> DataFrame:
    """Q28: PAD (nearest grid point within 40 km) vs index series per location, lagged and gap-filled.

    The year filter is applied to both monthly series before the shift.
    """
    idx = monthly_index(params, year_from, year_to)
    bodies = located_bodies(locations).join(idx.select("location_id").distinct(), "location_id", "left_semi")
    near = nearest_grid_point(bodies, registry).select("location_id", "punto_id")
    pad = near.join(pad_monthly, "punto_id").select("location_id", "periodo", "pad")
    return lag_join(pad, idx, "location_id", lag_months)


def lag_correlation(params: DataFrame, locations: DataFrame, registry: DataFrame, pad_monthly: DataFrame,
                    year_from: int, year_to: int, lag_max: int = 6) -> DataFrame:
    """Q29: Pearson correlation of PAD(month - lag) with the index(month), lag 0..lag_max.

    Pairs are complete months only; ``correlacion`` is null when n < 3 or a side is
    constant. Each PAD row is replicated once per lag (explode, no cross join).
    """
    idx = monthly_index(params, year_from, year_to)
    bodies = located_bodies(locations).join(idx.select("location_id").distinct(), "location_id", "left_semi")
    near = nearest_grid_point(bodies, registry).select("location_id", "punto_id")
    pad = near.join(pad_monthly, "punto_id").select("location_id", "periodo", "pad")
    lagged = pad.withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(lag_max)))).withColumn(
        "periodo", F.expr("add_months(periodo, lag)"))
    pairs = lagged.join(idx, ["location_id", "periodo"]).filter(F.col("pad").isNotNull() & F.col("ndci").isNotNull())
    stats = pairs.groupBy("location_id", "lag").agg(
        F.count(F.lit(1)).alias("n"), F.covar_samp("pad", "ndci").alias("_cov"),
        F.stddev_samp("pad").alias("_sx"), F.stddev_samp("ndci").alias("_sy"))
    base = near.select("location_id").withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(lag_max))))
    out = base.join(stats, ["location_id", "lag"], "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    corr = F.when(n >= 3, F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy")))
    return _named(out.select("location_id", "lag", corr.alias("correlacion"), n.alias("n")), locations).select(
        "nombre", "lag", "correlacion", "n")
