"""Query registry: name -> (spark, sf_dir) callable, and name -> DuckDB oracle SQL.

Doubles are rounded to ``DECIMALS`` places on both sides so the comparison is
insensitive to summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

DECIMALS = 6
Y0, Y1 = 1996, 2000
CODES = ["COLIFORMES TOTALES", "COLIFORMES FECALES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def finish(df: DataFrame) -> DataFrame:
    """Round double columns for a stable comparison (presentation only); -0.0 becomes 0.0."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(f"`{f.name}`").cast("double"), DECIMALS) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return finish(_fn(spark, sf_dir))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def R(expr: str) -> str:
    return f"(ROUND(CAST({expr} AS DOUBLE), {DECIMALS}) + 0.0)"
