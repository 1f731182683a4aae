"""Composite risk indicator (Q15, Q16) and its display tables.

All frames here are per department (already aggregated, bounded by the number of
polygons), so whole-frame windows are used for the min/max and quantiles instead
of a cross join with a one-row aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions.text import fixed


def _whole():
    return Window.partitionBy()


def minmax(c: str) -> Column:
    """Q15: (v - min) / (max - min) over non-null values; constant -> 0.0; null stays null."""
    v = F.col(c)
    lo, hi = F.min(v).over(_whole()), F.max(v).over(_whole())
    return F.when(v.isNull(), F.lit(None).cast("double")).when(hi == lo, F.lit(0.0)).otherwise((v - lo) / (hi - lo))


def risk_by_department(soil: DataFrame, contam_ose: DataFrame, contam_lab: DataFrame,
                       rain: DataFrame) -> DataFrame:
    """Q16: score 0-3 from three conditions over the full outer join on ``nombre``.

    contam = mean of the available normalised contamination parts; conditions are
    contam > p66, rain > p66, soil < p33 (linear-interpolated quantiles over
    non-null values); a null never meets a condition.
    """
    df = (soil.select("nombre", F.col("valor_medio").alias("val_suelo"))
          .join(contam_ose.select("nombre", "pct_ose"), "nombre", "full")
          .join(contam_lab.select("nombre", "val_gems"), "nombre", "full")
          .join(rain.select("nombre", "val_precip"), "nombre", "full"))
    df = df.withColumns({"_on": minmax("pct_ose"), "_gn": minmax("val_gems")})
    parts = F.array_compact(F.array("_on", "_gn"))
    df = df.withColumn("pct_contam", F.when(F.size(parts) > 0,
                                            F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)))
    df = df.withColumns({
        "_p66c": F.percentile("pct_contam", 0.66).over(_whole()),
        "_p66p": F.percentile("val_precip", 0.66).over(_whole()),
        "_p33s": F.percentile("val_suelo", 0.33).over(_whole()),
    })
    df = df.withColumns({
        "condicion_contam": F.coalesce(F.col("pct_contam") > F.col("_p66c"), F.lit(False)),
        "condicion_precip": F.coalesce(F.col("val_precip") > F.col("_p66p"), F.lit(False)),
        "condicion_suelo": F.coalesce(F.col("val_suelo") < F.col("_p33s"), F.lit(False)),
    })
    score = sum(F.col(c).cast("int") for c in ("condicion_contam", "condicion_precip", "condicion_suelo"))
    return df.filter(F.col("nombre").isNotNull()).select(
        "nombre", score.alias("score"), "condicion_contam", "condicion_precip", "condicion_suelo",
        "pct_ose", "val_gems", "val_precip", "val_suelo")


# Risk level label per score, and the text of each active signal.
RISK_LEVELS = {0: "Sin señales", 1: "Bajo", 2: "Medio", 3: "Alto"}
SIGNALS = [("condicion_contam", "contaminación"), ("condicion_precip", "precipitación"),
           ("condicion_suelo", "suelo")]
NO_SIGNALS = "sin señales activas"
MISSING = "—"


def _level(score: Column) -> Column:
    e = None
    for k, v in RISK_LEVELS.items():
        e = F.when(score == k, v) if e is None else e.when(score == k, v)
    return e


def risk_level_counts(risk: DataFrame) -> DataFrame:
    """Departments per score 0..3 with the level label; absent scores count 0."""
    spark = risk.sparkSession
    levels = spark.range(0, 4).select(F.col("id").cast("int").alias("score"))
    counts = risk.groupBy("score").agg(F.count(F.lit(1)).alias("n_departamentos"))
    return (levels.join(counts, "score", "left")
            .select("score", _level(F.col("score")).alias("nivel"),
                    F.coalesce("n_departamentos", F.lit(0)).cast("long").alias("n_departamentos")))


def _fmt(c: str, decimals: int, suffix: str = "", missing: str = MISSING) -> Column:
    return F.when(F.col(c).isNull() | F.isnan(F.col(c)), F.lit(missing)).otherwise(
        F.concat(fixed(c, decimals), F.lit(suffix)))


def risk_detail(risk: DataFrame) -> DataFrame:
    """Level, active-signal text, display strings, values rounded to 2, by score desc."""
    active = F.concat_ws(", ", *[F.when(F.col(c), F.lit(t)) for c, t in SIGNALS])
    senales = F.when(active == "", F.lit(NO_SIGNALS)).otherwise(active)
    return risk.select(
        "nombre", _level(F.col("score")).alias("nivel"), "score", senales.alias("senales"),
        *[F.round(F.col(c), 2).alias(c) for c in ("pct_ose", "val_gems", "val_precip", "val_suelo")],
        _fmt("pct_ose", 1, "%").alias("tip_ose"),
        _fmt("val_gems", 2, " MPN/100ml").alias("tip_gems"),
        _fmt("val_precip", 1, " mm/día", "sin datos").alias("tip_precip"),
        _fmt("val_suelo", 2).alias("tip_ibh"),
    ).orderBy(F.col("score").desc(), "nombre")
