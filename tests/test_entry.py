import __spark_entry__ as E

from conftest import SF001


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 30


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[:2] == ["unique_id", "timestamp"]
    assert len(rows) <= 50


def test_small_queries_run(spark):
    for k in ("wide_ragged", "table_stats", "data_freshness", "tables_overview"):
        assert E.queries()[k](spark, SF001).count() >= 1
