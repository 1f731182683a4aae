"""Quarterly categorical quality samples and claims (Q01-Q06, Q12, Q17-Q19).

Inputs follow the fact schemas: ``ose`` (departamento_id, code, fecha_inicio,
value_cat, ...), ``claims`` (departamento_id, fecha_inicio, ...), ``deptos``
(departamento_id, nombre). Every function returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.dates import quarter_label, quarter_name, year_range_filter

PRESENT = "Presencia"
ABSENT = "Ausencia"


def _is_present():
    return F.when(F.col("value_cat") == PRESENT, 1).otherwise(0)


def _pct(num, den):
    return (num.cast("double") * F.lit(100.0) / den.cast("double"))


def departments_with_data(ose: DataFrame, deptos: DataFrame) -> DataFrame:
    """Q01: departments that have at least one sample, by name."""
    return (deptos.select("departamento_id", "nombre")
            .join(ose.select("departamento_id"), "departamento_id", "left_semi")
            .orderBy("nombre"))


def pct_presence_by_department(ose: DataFrame, deptos: DataFrame, code: str | None = None,
                               year_from: int | None = None, year_to: int | None = None,
                               only_binary: bool = False, out: str = "pct_presencia") -> DataFrame:
    """Q02 / Q04 / Q12: % of samples with ``Presencia`` per department.

    Q02 counts every category (null included) in the denominator; Q04 keeps only
    Presencia/Ausencia (``only_binary``) and a year range. One conditional
    aggregate replaces the nested group-by (Spark does the partial aggregation).
    Departments without a name are dropped by the inner join.
    """
    f = ose
    if code is not None:
        f = f.filter(F.col("code") == code)
    if year_from is not None:
        f = f.filter(year_range_filter("fecha_inicio", year_from, year_to))
    if only_binary:
        f = f.filter(F.col("value_cat").isin(PRESENT, ABSENT))
    agg = f.groupBy("departamento_id").agg(_pct(F.sum(_is_present()), F.count(F.lit(1))).alias(out))
    return agg.join(deptos.select("departamento_id", "nombre"), "departamento_id").select("nombre", out)


def seasonal_pattern(ose: DataFrame, code: str, year_from: int, year_to: int) -> DataFrame:
    """Q03: per calendar quarter: total, presencias, % rounded to 2, quarter label."""
    f = ose.filter((F.col("code") == code) & year_range_filter("fecha_inicio", year_from, year_to)
                   & F.col("value_cat").isin(PRESENT, ABSENT))
    agg = f.groupBy(F.quarter("fecha_inicio").alias("trimestre")).agg(
        F.count(F.lit(1)).alias("total"), F.sum(_is_present()).cast("long").alias("presencias"))
    return agg.select(
        "trimestre", "total", "presencias",
        F.round(_pct(F.col("presencias"), F.col("total")), 2).alias("pct_presencia"),
        quarter_name("trimestre").alias("trimestre_label"),
    )


def quality_evolution(ose: DataFrame, year_from: int, year_to: int, codes: list[str],
                      departamento_id=None) -> DataFrame:
    """Q05: sample counts per (quarter, code, value_cat), Presencia/Ausencia only.

    With ``departamento_id=None`` every department is computed at once (grouped
    by it) instead of one query per department.
    """
    f = ose.filter(year_range_filter("fecha_inicio", year_from, year_to)
                   & F.col("code").isin(*codes) & F.col("value_cat").isin(PRESENT, ABSENT))
    keys = []
    if departamento_id is not None:
        f = f.filter(F.col("departamento_id") == departamento_id)
    else:
        keys = ["departamento_id"]
    periodo = F.date_trunc("quarter", F.col("fecha_inicio").cast("timestamp_ntz")).cast("date").alias("periodo")
    return f.groupBy(*keys, periodo, "code", "value_cat").agg(F.count(F.lit(1)).alias("total"))


def quality_series(evolution: DataFrame) -> DataFrame:
    """Total and presence per (quarter, code), % (missing presence = 0), ``YYYY Qn``."""
    keys = [c for c in ("departamento_id",) if c in evolution.columns] + ["periodo", "code"]
    agg = evolution.groupBy(*keys).agg(
        F.sum("total").alias("total_muestras"),
        F.coalesce(F.sum(F.when(F.col("value_cat") == PRESENT, F.col("total"))), F.lit(0)).alias("presencias"),
    )
    return agg.select(
        *keys,
        quarter_label("periodo").alias("periodo_str"),
        "total_muestras",
        _pct(F.col("presencias"), F.col("total_muestras")).alias("pct_presencia"),
    )


def quality_year_table(series: DataFrame, codes: list[str], decimals: int = 1) -> DataFrame:
    """Year x code table of the mean quarterly %, rounded (explicit pivot values)."""
    keys = [c for c in ("departamento_id",) if c in series.columns]
    s = series.withColumn("anio", F.year("periodo"))
    p = s.groupBy(*keys, "anio").pivot("code", codes).agg(F.avg("pct_presencia"))
    return p.select(*keys, "anio", *[F.round(F.col(f"`{c}`"), decimals).alias(c) for c in codes])


def claims_by_department(claims: DataFrame, deptos: DataFrame, year_from: int, year_to: int) -> DataFrame:
    """Q17: number of claims per department in the year range."""
    agg = (claims.filter(year_range_filter("fecha_inicio", year_from, year_to))
           .groupBy("departamento_id").agg(F.count(F.lit(1)).alias("total_reclamos")))
    return agg.join(deptos.select("departamento_id", "nombre"), "departamento_id").select("nombre", "total_reclamos")


def claims_by_quarter(claims: DataFrame, year_from: int, year_to: int, departamento_id=None) -> DataFrame:
    """Q18: claims per quarter (per department when ``departamento_id`` is None)."""
    f = claims.filter(year_range_filter("fecha_inicio", year_from, year_to))
    keys = []
    if departamento_id is not None:
        f = f.filter(F.col("departamento_id") == departamento_id)
    else:
        keys = ["departamento_id"]
    periodo = F.date_trunc("quarter", F.col("fecha_inicio").cast("timestamp_ntz")).cast("date").alias("periodo")
    return f.groupBy(*keys, periodo).agg(F.count(F.lit(1)).alias("n_reclamos"))


def claims_vs_quality(claims: DataFrame, ose: DataFrame, deptos: DataFrame, year_from: int,
                      year_to: int, code: str = "COLIFORMES TOTALES") -> DataFrame:
    """Q19: departments with both claims and samples: claims count and % Presencia, by claims desc."""
    c = claims_by_department(claims, deptos, year_from, year_to)
    q = pct_presence_by_department(ose, deptos, code, year_from, year_to)
    return c.join(q, "nombre").orderBy(F.col("total_reclamos").desc(), "nombre")
