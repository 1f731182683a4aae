"""Interval builders for the fact tables (CLN3, CLN5, CLN10, CLN11) and period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_interval(ts: Column | str) -> tuple[Column, Column]:
    """CLN3: [ts, ts + 1 hour]."""
    t = _c(ts)
    return t, t + F.expr("INTERVAL 1 HOUR")


def quarter_bounds(year: Column | str, quarter: Column | str) -> tuple[Column, Column]:
    """CLN5: first and last day of a calendar quarter, as midnight timestamps."""
    y = _c(year).cast("int")
    q = _c(quarter).cast("int")
    start = F.make_date(y, (q - 1) * 3 + 1, F.lit(1))
    end = F.last_day(F.add_months(start, 2))
    return start.cast("timestamp_ntz"), end.cast("timestamp_ntz")


def quarter_number_from_label(label: Column | str) -> Column:
    """First digit of a label like ``Trimestre 3``."""
    return F.regexp_extract(_c(label), r"(\d)", 1).cast("int")


def dekad_bounds(year: Column, month: Column, dekad: Column, strict: bool = True) -> tuple[Column, Column]:
    """CLN10: dekad 1 -> days 1..10, 2 -> 11..20, 3 -> 21..month end; end at 23:59:59.

    Any other dekad digit is an error (``raise_error``) when ``strict``; otherwise
    both bounds are null so the caller can quarantine the row.
    """
    start_day = F.when(dekad == 1, 1).when(dekad == 2, 11).when(dekad == 3, 21)
    first = F.make_date(year, month, F.lit(1))
    end_date = (
        F.when(dekad == 1, F.date_add(first, 9))
        .when(dekad == 2, F.date_add(first, 19))
        .when(dekad == 3, F.last_day(first))
    )
    start = F.make_timestamp_ntz(year, month, start_day, F.lit(0), F.lit(0), F.lit(0))
    end = end_date.cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    if strict:
        bad = F.raise_error(F.concat(F.lit("invalid dekad in period: "), dekad.cast("string")))
        start = F.when(dekad.isin(1, 2, 3), start).otherwise(bad.cast("timestamp_ntz"))
    return start, end


def meteorological_day(day: Column | str) -> tuple[Column, Column]:
    """CLN11: a rain day runs from 09:00 to 08:59:59 of the next day."""
    d = F.to_date(_c(day)).cast("timestamp_ntz")
    return d + F.expr("INTERVAL 9 HOURS"), d + F.expr("INTERVAL '1 08:59:59' DAY TO SECOND")


def year_range_filter(ts: Column | str, year_from: int, year_to: int) -> Column:
    """Inclusive year range written as a half-open range so Parquet stats can prune."""
    t = _c(ts)
    lo = F.lit(f"{int(year_from):04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{int(year_to) + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (t >= lo) & (t < hi)


def quarter_label(period: Column | str) -> Column:
    """``"YYYY Qn"`` for a quarter-start date."""
    p = _c(period)
    return F.concat(F.year(p).cast("string"), F.lit(" Q"), F.quarter(p).cast("string"))


# Labels of the calendar quarters, in order.
QUARTER_LABELS = {1: "Q1 (Ene–Mar)", 2: "Q2 (Abr–Jun)", 3: "Q3 (Jul–Sep)", 4: "Q4 (Oct–Dic)"}


def quarter_name(q: Column | str) -> Column:
    col = _c(q)
    out = F.lit(None).cast("string")
    expr = None
    for k, v in QUARTER_LABELS.items():
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr.otherwise(out)
