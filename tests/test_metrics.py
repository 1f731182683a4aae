import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.operators import ndci, risk, soil, stats
from caudal.operators.derived import half_period_trend


def rings(spark, rows):
    data = [(i, n, [[{"lon": float(x), "lat": float(y)} for x, y in ring]]) for i, n, ring in rows]
    return spark.createDataFrame(data, "departamento_id long, nombre string, "
                                       "rings array<array<struct<lon:double,lat:double>>>")


def sq(x0, y0, w):
    return [(x0, y0), (x0 + w, y0), (x0 + w, y0 + w), (x0, y0 + w), (x0, y0)]


def test_soil_fallbacks(spark):
    # D1 holds P1; D2 holds no point (fallback A: nearest = P2); D3 holds P3 without values
    # (fallback B: mean of the available means among its 12 nearest points = P1, P2, P4).
    deptos = rings(spark, [(1, "D1", sq(0, 0, 1)), (2, "D2", sq(5, 5, 0.1)), (3, "D3", sq(10, 10, 1))])
    reg = spark.createDataFrame([("P1", 0.5, 0.5), ("P2", 5.3, 5.3), ("P3", 10.5, 10.5), ("P4", 12.0, 12.0)],
                                "punto_id string, lon double, lat double")
    facts = spark.createDataFrame(
        [("P1", "IBH", dt.date(2020, 1, 1), 10.0), ("P2", "IBH", dt.date(2020, 1, 1), 20.0),
         ("P4", "IBH", dt.date(2020, 1, 1), 40.0), ("P3", "PAD", dt.date(2020, 1, 1), 99.0)],
        "punto_id string, type string, fecha_inicio date, value double").join(reg, "punto_id")
    expected = {"D1": 10.0, "D2": 20.0, "D3": pytest.approx((10 + 20 + 40) / 3)}
    ids = soil.grid_registry(reg)  # KEY4 ids of the coordinates; facts then name points by coordinates
    for points, rows in ((reg, facts), (ids, facts.drop("punto_id"))):
        got = {r.nombre: r.valor_medio
               for r in soil.soil_by_department(rows, points, deptos, "IBH", 2020, 2020).collect()}
        assert got == expected


def test_minmax_constant_and_null(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", None)], "nombre string, v double")
    got = {r.nombre: r.n for r in df.select("nombre", risk.minmax("v").alias("n")).collect()}
    assert got == {"a": 0.0, "b": 0.0, "c": None}


def test_risk_score(spark):
    soil_ = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0), ("D", 4.0)], "nombre string, valor_medio double")
    ose = spark.createDataFrame([("A", 10.0), ("B", 20.0), ("C", 30.0), ("D", 40.0)], "nombre string, pct_ose double")
    lab = spark.createDataFrame([("A", 1.0), ("D", 8.0)], "nombre string, val_gems double")
    rain = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 4.0), ("E", 8.0)], "nombre string, val_precip double")
    r = {x.nombre: x for x in risk.risk_by_department(soil_, ose, lab, rain).collect()}
    # contam: A=(0+0)/2=0, B=1/3, C=2/3, D=(1+1)/2=1 -> p66 = 0.66 -> C (0.667 > 0.66) and D
    assert r["D"].condicion_contam and r["C"].condicion_contam and not r["B"].condicion_contam
    # rain over 1,2,4,8: p66 = 3.96 (pandas' linear rule) -> C, E
    assert r["C"].condicion_precip and r["E"].condicion_precip and not r["B"].condicion_precip
    # soil p33 over 1..4 = 1.99 -> A
    assert r["A"].condicion_suelo and not r["B"].condicion_suelo
    assert r["E"].score == 1 and r["C"].score == 2


def test_lag_join_and_gap_fill(spark):
    pad = spark.createDataFrame([(1, dt.date(2020, 1, 1), 1.0), (1, dt.date(2020, 2, 1), 2.0)],
                                "location_id long, periodo date, pad double")
    idx = spark.createDataFrame([(1, dt.date(2020, 2, 1), 0.1), (1, dt.date(2020, 5, 1), 0.4)],
                                "location_id long, periodo date, ndci double")
    out = ndci.lag_join(pad, idx, "location_id", 1).orderBy("periodo").collect()
    assert [r.periodo for r in out] == [dt.date(2020, m, 1) for m in (2, 3, 4, 5)]
    assert (out[0].pad, out[0].pad_periodo, out[0].ndci) == (1.0, dt.date(2020, 1, 1), 0.1)
    assert (out[1].pad, out[1].pad_periodo) == (2.0, dt.date(2020, 2, 1))
    assert out[2].pad is None and out[2].ndci is None            # gap-filled month
    lag0 = ndci.lag_join(pad, idx, "location_id", 0).filter(F.col("pad").isNotNull() & F.col("ndci").isNotNull())
    assert lag0.count() == 1                                      # lag 0 = plain outer join on the month


def test_trend_labels(spark):
    rows = [(1, "2020 Q1", 10, 10.0), (1, "2020 Q2", 10, 30.0), (2, "2020 Q1", 5, 50.0), (3, "2020 Q1", 5, 50.0),
            (3, "2020 Q2", 5, 50.0)]
    df = spark.createDataFrame(rows, "k long, periodo_str string, total_muestras long, pct_presencia double")
    got = {r.k: r.tendencia for r in half_period_trend(df, ["k"]).collect()}
    assert got == {1: "Empeora", 2: "Período muy corto", 3: "Mejora"}


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rnd = random.Random(3)
    rows = [(0, rnd.gauss(0, 1)) for _ in range(3000)] + [(g, rnd.random()) for g in range(1, 6) for _ in range(7)]
    rows.append((9, 1.5))
    df = spark.createDataFrame(rows, "g long, v double")
    got = {r.g: r for r in stats.exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["q1", "q2", "q3"],
                                                 accuracy=200).collect()}
    for g in set(x for x, _ in rows):
        vals = np.array([v for x, v in rows if x == g])
        exp = np.percentile(vals, [25, 50, 75])
        assert (got[g].q1, got[g].q2, got[g].q3) == pytest.approx(tuple(exp))
        assert got[g].n == len(vals)


def test_exact_quantiles_coarse_sketch_still_exact(spark):
    # a very coarse sketch widens the brackets; the result must not change
    rnd = random.Random(11)
    rows = [(g, rnd.expovariate(1.0)) for g in range(3) for _ in range(500)]
    df = spark.createDataFrame(rows, "g long, v double")
    got = {r.g: r.q for r in stats.exact_quantiles(df, ["g"], "v", [0.9], ["q"], accuracy=10).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(float(np.percentile([v for x, v in rows if x == g], 90)))


def test_quantiles_of_constant_and_tied_groups(spark):
    from caudal.operators.stats import exact_quantiles
    df = spark.range(30_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 2 == 0, 7.0).otherwise((F.col("id") % 5).cast("double")).alias("v"))
    got = {r.g: (r.n, r.q25, r.q50, r.q75) for r in exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], accuracy=100).collect()}
    assert got == {0: (15_000, 7.0, 7.0, 7.0), 1: (15_000, 1.0, 2.0, 3.0)}


def test_gap_fill_keeps_every_month_once(spark):
    import datetime as dt

    from caudal.operators.ndci import monthly_gap_fill
    d = dt.date
    df = spark.createDataFrame([("a", d(2020, 1, 1), 1.0), ("a", d(2020, 4, 1), 4.0), ("a", d(2020, 5, 1), 5.0), ("b", d(2021, 12, 1), 9.0)],
                               "k string, periodo date, v double")
    got = [(r.k, r.periodo, r.v) for r in monthly_gap_fill(df, "k").orderBy("k", "periodo").collect()]
    assert got == [("a", d(2020, 1, 1), 1.0), ("a", d(2020, 2, 1), None), ("a", d(2020, 3, 1), None), ("a", d(2020, 4, 1), 4.0),
                   ("a", d(2020, 5, 1), 5.0), ("b", d(2021, 12, 1), 9.0)]
