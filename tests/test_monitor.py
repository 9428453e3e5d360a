import datetime as dt

from canopy.operators import monitor as M

STATE = "point string, last_run_date date, last_run_timestamp timestamp_ntz, last_used_id long"
AS_OF = dt.datetime(2024, 1, 31, 12)


def test_freshness_edge(spark):
    st = spark.createDataFrame([("a", None, AS_OF - dt.timedelta(hours=24), 1)], STATE)
    r = M.data_freshness(st, AS_OF).first()
    assert r.fresh_tables == 0 and r.is_fresh is False
    st = spark.createDataFrame(
        [("a", None, AS_OF - dt.timedelta(hours=24) + dt.timedelta(microseconds=1), 1)], STATE)
    assert M.data_freshness(st, AS_OF).first().is_fresh is True


def test_inventory_like_patterns(spark):
    tel = spark.createDataFrame([("stagingx", 1), ("p", 1), ("p", 2)], "point string, unique_id long")
    st = spark.createDataFrame([("p", None, AS_OF, 2)], STATE)
    wide = {"type1": spark.createDataFrame([(1,)], "unique_id long"), "type2": None}
    inv = M.inventory(tel, wide, st)
    src = [r.table_name for r in M.source_inventory(inv).collect()]
    assert src == ["p", "wide_type1"]          # 'stagingx' matches 'staging_%' too
    assert [r.table_name for r in M.wide_inventory(inv).collect()] == ["wide_type1"]
    s = M.run_summary(st).first()
    assert s.tables_processed == 1 and s.latest_run == AS_OF
