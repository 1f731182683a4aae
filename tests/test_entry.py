import __spark_entry__ as entry
from caudal.plans import catalog


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"periodo", "code", "pct_presencia"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_query_sample_runs_at_smallest_scale(spark, sf_dir):
    q = entry.queries()
    for name in ("q16_risk_by_department", "q29_lag_correlation", "cln14_disambiguate_names", "sp5_index_load"):
        assert q[name](spark, sf_dir).count() >= 0
