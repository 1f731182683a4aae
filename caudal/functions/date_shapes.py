"""Dates in text, read by their shape (CLN2, CLN7, CLN12).

A value is trimmed of white space and dispatched on its shape; each shape has its own parse, JVM-side:

    iso        2020-01-02, 2020/1/2 10:30, 2020-01-02T10:30:00.5
    hour       2020-01-02 10
    zoned      2020-01-02T10:30:00Z, 2020-01-02 10:30-03:00    (wall clock in UTC)
    compact    20200102, 20200102T1030, 20200102103000
    numeric    02/01/2020, 2-1-2020 10:30, 01.02.2020 5:07 PM   (month first, or day first: see ``with_day_first``)
    named      2 Jan 2020, 02-january-2020 10:30, Jan 2, 2020

Anything else, and impossible dates and times, is null. A shape is decided value by value, so one odd value does not
cost a file its other rows; only the order of day and month is decided once per file, from its first numeric value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.text import bound, strip

_DATE = r"\d{4}([-/])\d{1,2}\1\d{1,2}"
_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?"
_WORD = "[A-Za-z]{3,9}"
_TAIL = rf"(?:,?[T ] *({_TIME})(?: ?([AaPp])[Mm])?)?"

# English month names, in order.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]

_AS_IS = r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?$"

#: Shapes in the order in which they are tried.
SHAPES = {
    "iso": rf"^{_DATE}(?:[T ] *{_TIME})?$",
    "hour": rf"^{_DATE}[T ] *\d{{1,2}}$",
    "zoned": rf"^{_DATE}[T ] *{_TIME} ?(?:[Zz]|UTC|GMT|[+-]\d{{2}}(?::?\d{{2}})?)$",
    "compact": r"^(\d{4})(\d{2})(\d{2})(?:[T ]?(\d{2}):?(\d{2})(?::?(\d{2}))?)?$",
    "numeric": rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}){_TAIL}$",
    "named": rf"^(?:(\d{{1,2}})[- ]?({_WORD})\.?[- ,]+(\d{{4}})|({_WORD})\.? ?(\d{{1,2}}),? +(\d{{4}})){_TAIL}$",
}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_shape(c: Column | str) -> Column:
    """Name of the value's shape; ``other`` if it has none, null for null."""
    def name(t):
        return reduce(lambda e, x: e.when(t.rlike(x[1]), F.lit(x[0])), SHAPES.items(), F.when(t.isNull(), F.lit(None).cast("string"))).otherwise("other")

    return bound(strip(c), name)


def _plain(t: Column) -> Column:
    """``y-m-d`` with an optional blank and ``h:mm[:ss[.f]]`` -> timestamp_ntz; fractions are cut at microseconds."""
    one_blank = F.regexp_replace(F.translate(t, "/T", "- "), " +", " ")
    return F.regexp_replace(one_blank, r"(\.\d{6})\d+$", "$1").try_cast("timestamp_ntz")


def _zoned(t: Column) -> Column:
    text = F.regexp_replace(F.translate(F.upper(t), "/T", "- "), " *(Z|U C|GM )$", "Z")  # the T of UTC and GMT is a blank by now
    text = F.regexp_replace(F.regexp_replace(text, " +", " "), r" ([+-]\d)", "$1")
    text = F.regexp_replace(F.regexp_replace(text, r"(\.\d{6})\d+", "$1"), r"( \d{1,2}:\d{2})(?=[Z+-])", "$1:00")
    instant = text.try_cast("timestamp")
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def _compact(t: Column) -> Column:
    whole = SHAPES["compact"]
    time = F.when(F.regexp_extract(t, whole, 4) == "", "").otherwise(F.regexp_replace(t, whole, " $4:$5:0$6"))
    seconds = F.regexp_replace(time, r":0(\d{2})$", ":$1")  # 0 stands where there are no seconds
    return F.concat(F.regexp_replace(t, whole, "$1-$2-$3"), seconds).try_cast("timestamp_ntz")


def _with_time(date: Column, t: Column, shape: str, at: int) -> Column:
    """A date in text and the time in group ``at`` (A or P of a 12-hour clock in the next one)."""
    time, half = F.regexp_extract(t, shape, at), F.upper(F.regexp_extract(t, shape, at + 1))
    stamp = F.concat(date, F.when(time == "", "").otherwise(F.concat(F.lit(" "), time))).try_cast("timestamp_ntz")
    hour = F.hour(stamp)
    shift = F.when((half == "P") & (hour < 12), 12).when((half == "A") & (hour == 12), -12).otherwise(0)
    zero = F.lit(0)
    return F.when((half == "") | hour.between(1, 12), stamp + F.make_dt_interval(zero, shift, zero, F.lit(0).cast("decimal(18,6)")))


def _numeric(t: Column, day_first: Column) -> Column:
    whole = SHAPES["numeric"]
    date = F.when(day_first, F.regexp_replace(t, whole, "$4-$3-$1")).otherwise(F.regexp_replace(t, whole, "$4-$1-$3"))
    return _with_time(date, t, whole, 5)


def _named(t: Column) -> Column:
    whole = SHAPES["named"]
    word = F.lower(F.regexp_replace(t, whole, "$2$4"))
    numbers = {w: i + 1 for i, m in enumerate(MONTHS) for w in (m, m[:3])}
    month = F.element_at(F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv]), word)
    date = F.concat(F.regexp_replace(t, whole, "$3$6-"), month.cast("string"), F.regexp_replace(t, whole, "-$1$5"))
    return _with_time(date, t, whole, 7)


def to_timestamp_lenient(c: Column | str, day_first: Column | None = None) -> Column:
    """Text -> timestamp_ntz by its shape; what has no shape or no such date is null.

    ``day_first``: whether numeric dates begin with the day (null and None: no).
    """
    first = F.lit(False) if day_first is None else F.coalesce(day_first, F.lit(False))
    readers = {"iso": _plain, "hour": lambda x: _plain(F.concat(x, F.lit(":00"))), "zoned": _zoned, "compact": _compact,
               "numeric": lambda x: _numeric(x, first), "named": _named}

    def by_shape(t):
        return reduce(lambda e, x: e.when(t.rlike(SHAPES[x[0]]), x[1](t)), readers.items(), F.when(t.isNull(), F.lit(None).cast("timestamp_ntz")))

    text = strip(_c(c).cast("string"))
    # by far the most values are as Spark reads them
    return F.when(text.rlike(_AS_IS), text.try_cast("timestamp_ntz")).otherwise(bound(text, by_shape))


def with_day_first(df: DataFrame, col: str, file_cols: list[str], order_cols: list[str], out: str = "day_first") -> DataFrame:
    """``df`` with the day-month order of the row's file: day first if the file's first numeric date (by ``order_cols``)
    begins with a number over 12, else month first. Files are few beside rows: one row per file is joined back.
    """
    t = strip(F.col(col).cast("string"))
    keys = [F.col(f).alias(f"__f{i}") for i, f in enumerate(file_cols)]
    first = (df.where(t.rlike(SHAPES["numeric"])).groupBy(*keys)
             .agg(F.min_by(F.regexp_extract(t, r"^\d+", 0), F.struct(*order_cols)).alias("__first"))
             .select(*[f"__f{i}" for i in range(len(file_cols))], (F.col("__first").cast("int") > 12).alias(out)))
    if not file_cols:
        return df.join(F.broadcast(first), how="left")  # one row
    same = [df[f].eqNullSafe(F.col(f"__f{i}")) for i, f in enumerate(file_cols)]
    return df.join(first, reduce(lambda a, b: a & b, same), "left").drop(*[f"__f{i}" for i in range(len(file_cols))])


def shape_counts(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Rows per shape of ``col`` (and per ``by``): shape, rows, and how many of them are dates."""
    shape = date_shape(F.col(col).cast("string"))
    return df.select(*(by or []), shape.alias("shape"), to_timestamp_lenient(col).alias("__t")).groupBy(*(by or []), "shape").agg(
        F.count(F.lit(1)).alias("rows"), F.count("__t").alias("dates"))
