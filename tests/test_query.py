import datetime as dt

import pytest
from pyspark.sql import functions as F

from canopy import config
from canopy.operators import query as Q
from canopy.plans.inspect import plan_summary
from canopy.sources import testdata as td
from canopy.operators.wide import build_wide

from conftest import SF01


@pytest.fixture(scope="module")
def wide(spark):
    st = td.staged(td.events_five(spark, SF01))
    man = td.ordered_manifest(st, ["type1", "other"])
    return {c: build_wide(st, man, c).df.cache() for c in ("type1", "other")}


def test_timestamp_resolver():
    assert Q.timestamp_column(["unique_id", "timestamp", "a"], "type1") == "timestamp"
    assert Q.timestamp_column(["unique_id", "Timestamp_x", "a"], "type2") == "Timestamp_x"
    assert Q.timestamp_column(["unique_id", "timestamp_a", "a", "timestamp_b"], "other") \
        == "timestamp_a"
    assert Q.timestamp_column(["unique_id", "timestamp"], "less50") == "timestamp"
    assert Q.timestamp_column(["x", "y"], "other") == "x"
    assert Q.timestamp_column([], "other") == "unique_id"


def test_argument_checks(wide):
    with pytest.raises(ValueError):
        Q.page(wide["type1"], "nope")
    with pytest.raises(ValueError):
        Q.page(wide["type1"], "type1", limit=0)
    with pytest.raises(ValueError):
        Q.page(wide["type1"], "type1", limit=config.PAGE_LIMIT_MAX + 1)
    with pytest.raises(ValueError):
        Q.page(wide["type1"], "type1", offset=-1)
    with pytest.raises(ValueError):
        Q.unique_ids(wide["type1"], "type1", limit=1001)


def test_paging_edges(wide):
    df = wide["type1"]
    total = df.count()
    assert Q.page(df, "type1", 100, total).count() == 0
    t = Q.page_total(df, "type1", 100, total - 100).first()
    assert t.total_count == total and t.has_more is False
    assert Q.page_total(df, "type1", 100, total - 101).first().has_more is True


def test_id_zero_is_a_filter(wide):
    assert Q.page(wide["type1"], "type1", unique_id=0).count() == 0
    assert Q.page(wide["type1"], "type1", unique_id=1).count() == 1
    # empty date strings mean "no filter"
    assert Q.page_total(wide["type1"], "type1", start_date="").first().total_count \
        == wide["type1"].count()


def test_ragged_null_time_sorts_last(wide):
    df = wide["other"]
    last = Q.page(df, "other", 10, df.count() - 10).collect()
    assert last[-1]["timestamp_click"] is None
    # ... and a date filter drops it
    assert Q.page(df, "other", 10, 0, unique_id=2010, start_date="2024-01-01").count() == 0


def test_deep_page_equals_topk(wide, monkeypatch):
    df = wide["other"]
    a = [tuple(r) for r in Q.page(df, "other", 37, 1500, "2024-01-02").collect()]
    monkeypatch.setattr(config, "MAX_TOPK_ROWS", 10)
    b = Q.page(df, "other", 37, 1500, "2024-01-02")
    assert not plan_summary(b)["top_k"]
    assert sorted(a) == sorted(tuple(r) for r in b.collect())


def test_page_plan_is_topk_with_pushed_date(spark, tmp_root, wide):
    path = f"{tmp_root}/w"
    wide["type1"].write.parquet(path)
    df = spark.read.parquet(path)
    s = plan_summary(Q.page(df, "type1", 10, 5, "2024-01-10", "2024-01-12"))
    assert s["top_k"]
    pushed = " ".join(s["pushed_filters"])
    assert "GreaterThanOrEqual(timestamp" in pushed and "LessThan(timestamp" in pushed


def test_all_null_column_stats(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0)],
                               "unique_id long, a double, b double")
    got = {r.column: tuple(r)[1:] for r in Q.column_stats(df).collect()}
    assert got["a"] == (None, None, None, 0)
    assert got["b"] == (1.0, 3.0, 2.0, 2)
    assert "unique_id" not in got


def test_stats_and_time_range(wide):
    s = Q.table_stats(wide["other"], "other").first()
    assert s.total_records == s.unique_ids_count == 2017
    t = Q.time_range(wide["other"], "other").first()
    assert t.total_records == 2017 and t.unique_days == 30
    ids = [r.unique_id for r in Q.unique_ids(wide["other"], "other", 5).collect()]
    assert ids == [1, 2, 3, 4, 5]


def test_tables_overview(spark, wide):
    ov = {r.category: r for r in Q.tables_overview(spark, wide).collect()}
    assert ov["type2"].available is False and ov["type2"].row_count == 0
    assert ov["type1"].row_count == 1981
    assert [c.name for c in ov["type1"].columns][:2] == ["unique_id", "timestamp"]
    assert ov["type1"].columns[2].type == "double"


def test_column_stats_many_columns_path(spark, monkeypatch):
    df = spark.createDataFrame([(1, None, 1.0, 5), (2, None, 3.0, 7)],
                               "unique_id long, a double, b double, c int")
    wide = sorted(tuple(r) for r in Q.column_stats(df).collect())
    monkeypatch.setattr(config, "WIDE_BLOCK_POINTS", 1)
    assert sorted(tuple(r) for r in Q.column_stats(df).collect()) == wide
    empty = Q.column_stats(df.limit(0)).collect()
    assert sorted((r.column, r.non_null_count) for r in empty) == [("a", 0), ("b", 0), ("c", 0)]
