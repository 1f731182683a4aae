"""Dashboard-derived tables (D01-D09, D12-D19) over the per-department / per-body results.

Inputs here are already aggregated (one row per department, water body, month or
quarter), so whole-frame windows are bounded by those dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions.text import fixed, format_magnitude
from caudal.operators.stats import exact_quantiles


def rank_desc(df: DataFrame, value_col: str, tie_col: str = "nombre", out: str = "ranking") -> DataFrame:
    """Unique rank by value desc (ties broken by ``tie_col``)."""
    w = Window.orderBy(F.col(value_col).desc(), F.col(tie_col))
    return df.withColumn(out, F.row_number().over(w))


def map_markers(metric: DataFrame, rep_points: DataFrame, value_col: str, value_label: str,
                unit: str = "") -> DataFrame:
    """Metric joined with representative points, rank, marker radius 9000-45000
    scaled by min-max (22000 when constant) and a tooltip text."""
    j = metric.join(rep_points, "nombre")
    w = Window.partitionBy()
    lo, hi = F.min(value_col).over(w), F.max(value_col).over(w)
    j = rank_desc(j, value_col)
    radius = F.when(hi == lo, F.lit(22000.0)).otherwise(
        F.lit(9000.0) + (F.col(value_col) - lo) / (hi - lo) * F.lit(36000.0))
    suffix = f" {unit}" if unit else ""
    tooltip = F.concat(F.lit("#"), F.col("ranking").cast("string"), F.lit(" "), F.col("nombre"),
                       F.lit(f"<br>{value_label}: "), fixed(value_col, 2), F.lit(suffix))
    return j.select("nombre", "lon", "lat", value_col, "ranking", radius.alias("radio"), tooltip.alias("tooltip"))


def formatted_values(df: DataFrame, value_col: str, out: str = "valor_txt") -> DataFrame:
    """Magnitude-dependent number text."""
    return df.withColumn(out, format_magnitude(value_col))


def period_kpi(series: DataFrame, keys: list[str]) -> DataFrame:
    """Total samples and sample-weighted % presence per key."""
    return series.groupBy(*keys).agg(
        F.sum("total_muestras").alias("total_muestras"),
        (F.sum(F.col("pct_presencia") * F.col("total_muestras") / 100.0) / F.sum("total_muestras") * 100.0)
        .alias("pct_global"))


def half_period_trend(series: DataFrame, keys: list[str]) -> DataFrame:
    """Periods (distinct, ordered) split at n//2; weighted % of each half; delta > 0 ->
    ``Empeora``, otherwise ``Mejora``; fewer than 2 periods -> ``Período muy corto``."""
    w = Window.partitionBy(*keys).orderBy("periodo_str")
    ranked = series.withColumn("_r", F.dense_rank().over(w))
    ranked = ranked.withColumn("_n", F.max("_r").over(Window.partitionBy(*keys)))
    first = F.col("_r") <= F.floor(F.col("_n") / 2)
    wsum = F.col("pct_presencia") * F.col("total_muestras")
    agg = ranked.groupBy(*keys).agg(
        F.max("_n").alias("n_periodos"),
        (F.sum(F.when(first, wsum)) / F.sum(F.when(first, F.col("total_muestras")))).alias("pct_primera"),
        (F.sum(F.when(~first, wsum)) / F.sum(F.when(~first, F.col("total_muestras")))).alias("pct_segunda"),
    )
    delta = F.col("pct_segunda") - F.col("pct_primera")
    return agg.select(
        *keys, "n_periodos", "pct_primera", "pct_segunda",
        F.when(F.col("n_periodos") >= 2, delta).alias("delta"),
        F.when(F.col("n_periodos") < 2, F.lit("Período muy corto"))
        .when(delta > 0, F.lit("Empeora")).otherwise(F.lit("Mejora")).alias("tendencia"))


def lab_kpis(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of monthly means, min of minimums, max of maximums (with D03 text)."""
    agg = monthly.groupBy(*keys).agg(F.avg("valor_medio").alias("promedio"), F.min("valor_min").alias("minimo"),
                                     F.max("valor_max").alias("maximo"))
    return agg.select(*keys, "promedio", "minimo", "maximo",
                      format_magnitude("promedio").alias("promedio_txt"),
                      format_magnitude("minimo").alias("minimo_txt"),
                      format_magnitude("maximo").alias("maximo_txt"))


def month_label(c: str) -> F.Column:
    """``YYYY-MM``."""
    return F.date_format(F.col(c), "yyyy-MM")


def department_month_matrix(monthly: DataFrame, months: list[str]) -> DataFrame:
    """Department x month matrix (explicit month list) plus the number of departments."""
    m = monthly.withColumn("mes", month_label("periodo"))
    p = m.groupBy("nombre").pivot("mes", months).agg(F.first("valor_medio"))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return p.withColumn("n_departamentos", n)


def national_kpi(per_department: DataFrame, value_col: str) -> DataFrame:
    """National mean/min/max over departments."""
    return per_department.agg(F.avg(value_col).alias("promedio_nacional"), F.min(value_col).alias("minimo"),
                              F.max(value_col).alias("maximo"))


def claims_quality_axis(claims_q: DataFrame, quality: DataFrame, key: str = "departamento_id") -> DataFrame:
    """Claims per quarter and % presence per quarter on one time axis (full outer join)."""
    q = quality.select(key, "periodo", "pct_presencia")
    return claims_q.select(key, "periodo", "n_reclamos").join(q, [key, "periodo"], "full")


def claims_summary(claims_vs_quality: DataFrame) -> DataFrame:
    """Claims table with % to one decimal, by claims desc."""
    return claims_vs_quality.select("nombre", "total_reclamos", F.round("pct_presencia", 1).alias("pct_presencia")) \
        .orderBy(F.col("total_reclamos").desc(), "nombre")


def top_bottom(summary: DataFrame, value_col: str, n: int = 3, decimals: int = 4) -> DataFrame:
    """The n highest and n lowest bodies by mean (a top-k report), value rounded.

    Each end is an ``orderBy().limit(n)`` (the n best of each task meet); only those n rows are numbered.
    """
    rows = summary.select("nombre", value_col, "observaciones").filter(F.col(value_col).isNotNull())

    def end(label, *order):
        best = rows.orderBy(*order).limit(n)
        return best.select(F.lit(label).alias("grupo"), F.row_number().over(Window.orderBy(*order)).alias("posicion"),
                           "nombre", F.round(value_col, decimals).alias(value_col), "observaciones")

    return end("mayores", F.col(value_col).desc(), F.col("nombre")).unionByName(
        end("menores", F.col(value_col).asc(), F.col("nombre").desc()))


def distribution(obs: DataFrame, summary: DataFrame, value_col: str = "ndci") -> DataFrame:
    """Per body quartiles (linear, exact, bounded per task), 1.5 IQR fences and outlier count;
    summary order kept."""
    q = exact_quantiles(obs, ["nombre"], value_col, [0.25, 0.5, 0.75], ["q1", "mediana", "q3"])
    q = q.withColumns({"lim_inf": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "lim_sup": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    flagged = obs.join(q.select("nombre", "lim_inf", "lim_sup"), "nombre").groupBy("nombre").agg(
        F.sum(F.when((F.col(value_col) < F.col("lim_inf")) | (F.col(value_col) > F.col("lim_sup")), 1)
              .otherwise(0)).cast("long").alias("n_atipicos"))
    order = rank_desc(summary.select("nombre", "ndci_promedio"), "ndci_promedio", out="orden")
    return q.join(flagged, "nombre").join(order.select("nombre", "orden"), "nombre")


def body_month_matrix(monthly: DataFrame, summary: DataFrame, months: list[str]) -> DataFrame:
    """Water body x month matrix of mean index, rows in summary order."""
    m = monthly.withColumn("mes_label", month_label("mes"))
    p = m.groupBy("nombre").pivot("mes_label", months).agg(F.avg("ndci_promedio"))
    order = rank_desc(summary.select("nombre", "ndci_promedio"), "ndci_promedio", out="orden")
    return p.join(order.select("nombre", "orden"), "nombre")


def summary_table(summary: DataFrame, decimals: int = 4) -> DataFrame:
    """Summary rounded to 4; a missing deviation shown as 0."""
    return summary.select(
        "nombre", "observaciones", "fecha_min", "fecha_max",
        *[F.round(c, decimals).alias(c) for c in ("ndci_promedio", "ndci_min", "ndci_max")],
        F.round(F.coalesce("ndci_desvio", F.lit(0.0)), decimals).alias("ndci_desvio"))


def choropleth_table(pct: DataFrame, decimals: int = 2) -> DataFrame:
    """% per department rounded to 2 and the colour-scale maximum."""
    r = pct.select("nombre", F.round("pct_presencia", decimals).alias("pct_presencia"))
    return r.withColumn("escala_max", F.round(F.max("pct_presencia").over(Window.partitionBy()), decimals))


def grid_link(near: DataFrame, bodies: DataFrame, registry: DataFrame) -> DataFrame:
    """Water body -> nearest grid point row with both coordinates (GEO4 + GEO7)."""
    return (near.join(bodies.select("location_id", "nombre", F.col("lon").alias("loc_lon"),
                                    F.col("lat").alias("loc_lat")), "location_id")
            .join(registry.select("punto_id", F.col("lon").alias("punto_lon"), F.col("lat").alias("punto_lat")),
                  "punto_id")
            .select("nombre", "loc_lat", "loc_lon", "punto_lat", "punto_lon", "dist_m"))


def point_coords(registry: DataFrame, ids: DataFrame) -> DataFrame:
    """GEO7: coordinates of grid points by id (lat, lon order)."""
    return registry.join(ids, "punto_id").select("punto_id", "lat", "lon")
