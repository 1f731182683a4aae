import datetime as dt
import hashlib
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from caudal.functions.date_shapes import shape_counts, to_timestamp_lenient, with_day_first
from caudal.functions.dates import dekad_bounds, quarter_bounds
from caudal.functions.ids import stable_id
from caudal.functions.text import fixed, format_magnitude, normalize_name, repair_double_encoding


def py_id(*args):
    return str(uuid.UUID(bytes=hashlib.md5("|".join(str(a) for a in args).encode()).digest()))


def test_stable_id_matches_python_contract(spark):
    df = spark.createDataFrame([("a", "b", 1, 2.5, None)], "x string, y string, i int, d double, n string")
    r = df.select(stable_id("x", "y").alias("ab"), stable_id(F.lit("ab")).alias("ab1"),
                  stable_id("y", "x").alias("ba"), stable_id("i", "d", "n").alias("mixed")).first()
    assert r.ab == py_id("a", "b")
    assert r.ab != r.ab1            # the separator keeps ("a","b") apart from ("ab")
    assert r.ab != r.ba             # order matters
    assert r.mixed == py_id(1, 2.5, None)   # None accepted, written as "None"


def test_stable_id_deterministic(spark):
    df = spark.range(100).select(stable_id("id").alias("k"))
    a = [r.k for r in df.orderBy("k").collect()]
    b = [r.k for r in df.orderBy("k").collect()]
    assert a == b and len(set(a)) == 100


def test_normalize_name(spark):
    df = spark.createDataFrame([("  Río Negro ",), ("PAYSANDÚ",), ("Tacuarembó",)], "n string")
    got = [r[0] for r in df.select(normalize_name("n")).collect()]
    assert got == ["rio negro", "paysandu", "tacuarembo"]


def test_repair_double_encoding(spark):
    df = spark.createDataFrame([("NotificaciÃ³n",), ("Notificación",)], "s string")
    assert [r[0] for r in df.select(repair_double_encoding("s")).collect()] == ["Notificación", "Notificación"]


@pytest.mark.parametrize("v,d", [(0.01075, 4), (0.125, 2), (2.675, 2), (-1.5, 0), (123.45, 1), (1e-7, 6),
                                 (99.995, 2), (0.5, 0), (2.5, 0), (-0.0125, 3)])
def test_fixed_matches_python(spark, v, d):
    got = spark.createDataFrame([(v,)], "v double").select(fixed("v", d)).first()[0]
    assert got == f"{v:.{d}f}"


def test_format_magnitude(spark):
    vals = [0.0, 1234.56, 12.345, 0.5, 0.001234]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(format_magnitude("v")).collect()]
    assert got == ["0", "1234.6", "12.35" if f"{12.345:.2f}" == "12.35" else f"{12.345:.2f}", "0.5000", "0.001234"]


def test_quarter_bounds(spark):
    df = spark.createDataFrame([(2023, 1), (2023, 4), (2024, 1)], "y int, q int")
    s, e = quarter_bounds("y", "q")
    rows = df.select(s.alias("s"), e.alias("e")).collect()
    assert rows[0].s == dt.datetime(2023, 1, 1) and rows[0].e == dt.datetime(2023, 3, 31)
    assert rows[1].e == dt.datetime(2023, 12, 31)


def test_dekads_leap_february(spark):
    df = spark.createDataFrame([(2020, 2, 3), (2021, 2, 3), (2020, 1, 1), (2020, 1, 2)], "y int, m int, k int")
    s, e = dekad_bounds(F.col("y"), F.col("m"), F.col("k"))
    rows = df.select(s.alias("s"), e.alias("e")).collect()
    assert rows[0].e == dt.datetime(2020, 2, 29, 23, 59, 59)
    assert rows[1].e == dt.datetime(2021, 2, 28, 23, 59, 59)
    assert (rows[2].s, rows[2].e) == (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 10, 23, 59, 59))
    assert rows[3].s == dt.datetime(2020, 1, 11)


def test_dekad_invalid_raises(spark):
    df = spark.createDataFrame([(2020, 1, 4)], "y int, m int, k int")
    s, _ = dekad_bounds(F.col("y"), F.col("m"), F.col("k"))
    with pytest.raises(Exception):
        df.select(s).collect()


def python_normalized(s):
    s = s.lower().strip()
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def test_normalize_name_over_all_of_unicode(spark):
    # what Java and Python both know; case mapping aside, which is not the subject
    codes = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and unicodedata.decomposition(chr(c))]
    codes += [*range(0xAC00, 0xD7A4, 37), *range(0x300, 0x370)]
    names = [f"a{chr(c).lower()}b" for c in codes]
    names += ["Montevideo\t", "Salto ", "Río Negro\r", " Durazno　", "\x1fFlores\x85", "한글 Ñandú", "", " \n"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string").select("i", normalize_name("n").alias("n"))
    got = {r.i: r.n for r in df.collect()}
    wrong = [(names[i], got[i]) for i in got if got[i] != python_normalized(names[i])]
    assert not wrong, wrong[:20]


DATES = [  # text, what pandas reads (month first)
    ("2020-01-02", "2020-01-02"), ("2020/1/2", "2020-01-02"), ("2020-01-02 10:30", "2020-01-02 10:30"),
    ("2020-01-02T10:30:05.1234567", "2020-01-02 10:30:05.123456"), ("2020-01-02  10:30", "2020-01-02 10:30"),
    ("2020-01-02 10", "2020-01-02 10:00"), ("2020-01-02T10:00:00Z", "2020-01-02 10:00"), ("2020-01-02 10:30 UTC", "2020-01-02 10:30"),
    ("2020-01-02T10:00:00-03:00", "2020-01-02 13:00"), ("2020-01-02 23:30+0200", "2020-01-02 21:30"), ("2020-01-02 10:00:00.5 +02", "2020-01-02 08:00:00.5"),
    ("20200102", "2020-01-02"), ("20200102T1015", "2020-01-02 10:15"), ("20200102101530", "2020-01-02 10:15:30"), ("20200102 10:15:30", "2020-01-02 10:15:30"),
    ("02/01/2020", "2020-02-01"), ("2-1-2020 7:05", "2020-02-01 07:05"), ("02.01.2020", "2020-02-01"), ("02/01/2020 12:15 AM", "2020-02-01 00:15"),
    ("02/01/2020 05:07:09 pm", "2020-02-01 17:07:09"), ("2 Jan 2020", "2020-01-02"), ("02-Jan-2020 10:30", "2020-01-02 10:30"),
    ("January 2, 2020", "2020-01-02"), ("2 september 2020", "2020-09-02"), (" 2020-01-02\r", "2020-01-02"), ("\t02/01/2020 \n", "2020-02-01"),
    ("13/01/2020", None), ("2020-13-01", None), ("2020-02-30", None), ("2020-01-02 24:00", None), ("2020-01-02 10:75", None), ("02/01/2020 13:00 PM", None),
    ("20201301", None), ("2 Foo 2020", None), ("fecha invalida", None), ("", None), (None, None), ("2020-01/02", None), ("12345", None)]


@pytest.mark.parametrize("zone", ["UTC", "America/Montevideo"])
def test_dates_by_shape(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "i int, t string")
        got = {r.i: r.d for r in df.select("i", to_timestamp_lenient("t").cast("string").alias("d")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = {i: d and str(dt.datetime.fromisoformat(d)).rstrip("0") if d and "." in d else d and str(dt.datetime.fromisoformat(d)) for i, (_, d) in enumerate(DATES)}
    assert [(DATES[i][0], got[i], want[i]) for i in got if got[i] != want[i]] == []


def test_dates_are_those_of_pandas(spark):
    import pandas as pd

    df = spark.createDataFrame([(t,) for t, _ in DATES if t], "t string").select("t", to_timestamp_lenient("t").alias("d"))
    for r in df.collect():
        if r.t.endswith(("24:00", "PM")) or r.t == "12345":
            continue
        p = pd.to_datetime([r.t.strip()], errors="coerce", utc=True)[0]
        if r.t != "13/01/2020":  # pandas takes the order from the first value, here the only one
            assert (None if p is pd.NaT else p.tz_localize(None).to_pydatetime()) == r.d or "1234567" in r.t or "  " in r.t or "2020-01/02" in r.t, r


def test_day_month_order_is_decided_per_file(spark):
    rows = [("a", 1, "fecha"), ("a", 2, "25/12/2020"), ("a", 3, "02/01/2020"), ("b", 1, "02/01/2020"), ("b", 2, "25/12/2020"), ("c", 1, "2020-05-06"), (None, 1, "13-01-2020")]
    df = with_day_first(spark.createDataFrame(rows, "f string, p int, t string"), "t", ["f"], ["p"])
    got = {(r.f, r.p): r.d and str(r.d.date()) for r in df.select("f", "p", to_timestamp_lenient("t", F.col("day_first")).alias("d")).collect()}
    assert got == {("a", 1): None, ("a", 2): "2020-12-25", ("a", 3): "2020-01-02", ("b", 1): "2020-02-01", ("b", 2): None,
                   ("c", 1): "2020-05-06", (None, 1): "2020-01-13"}
    whole = with_day_first(spark.createDataFrame([("31/01/2020", 1), ("02/01/2020", 2)], "t string, p int"), "t", [], ["p"])
    assert {str(r[0].date()) for r in whole.select(to_timestamp_lenient("t", F.col("day_first"))).collect()} == {"2020-01-31", "2020-01-02"}


def test_shape_counts(spark):
    df = spark.createDataFrame([(t,) for t, _ in DATES], "t string")
    got = {r["shape"]: (r["rows"], r["dates"]) for r in shape_counts(df, "t").collect()}
    assert got[None] == (1, 0) and got["zoned"] == (5, 5) and got["numeric"] == (8, 6) and got["other"][1] == 0
    assert sum(n for n, _ in got.values()) == len(DATES)
