import datetime as dt

import pytest
from pyspark.sql import functions as F

from canopy.operators.wide import build_wide, build_wide_join_chain
from canopy.plans.inspect import plan_summary
from canopy.sources import testdata as td
from canopy.sources.manifest import manifest_from_rows

from conftest import SF01

STAGED = "point string, unique_id long, ts timestamp_ntz, value double"
T0 = dt.datetime(2024, 1, 1)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def staged(spark, spec):
    """spec: {point: n_rows}"""
    rows = [(p, i, T0 + dt.timedelta(minutes=i), float(i)) for p, n in spec.items()
            for i in range(1, n + 1)]
    return spark.createDataFrame(rows, STAGED)


@pytest.mark.parametrize("cat", ["type1", "other"])
def test_pivot_equals_join_chain(spark, cat):
    st = td.staged(td.events_five(spark, SF01))
    w = build_wide(st, td.ordered_manifest(st, [cat]), cat)
    chain = build_wide_join_chain(st, w.points, w.names, w.kind)
    assert w.df.columns == chain.select(*w.df.columns).columns
    assert rows_of(w.df) == rows_of(chain.select(*w.df.columns))


def test_one_exchange_one_scan(spark, tmp_root):
    st = td.staged(td.events_five(spark, SF01))
    path = f"{tmp_root}/staged"
    st.write.parquet(path)
    st = spark.read.parquet(path)
    w = build_wide(st, td.ordered_manifest(st, ["other"]), "other")
    s = plan_summary(w.df)
    assert s["hash_exchanges"] == 1 and s["scans"] == 1
    assert any("In(point" in f for f in s["pushed_filters"])
    chain = plan_summary(build_wide_join_chain(st, w.points, w.names, "ragged"))
    assert chain["scans"] == 5


def test_aligned_inner_ragged_outer(spark):
    st = staged(spark, {"a_t": 3, "b_h": 5})
    man = manifest_from_rows(spark, [("type1", "a_t", 1), ("type1", "b_h", 2),
                                     ("less50", "b_h", 1), ("less50", "a_t", 2)])
    al = build_wide(st, man, "type1")
    assert al.df.columns == ["unique_id", "timestamp", "t", "h"]
    assert al.df.count() == 3
    rg = build_wide(st, man, "less50")
    assert rg.df.columns == ["unique_id", "timestamp_h", "h", "timestamp_t", "t"]
    assert rg.df.count() == 5 and rg.base_point == "b_h"
    assert rg.df.filter(F.col("t").isNull()).count() == 2


def test_empty_and_missing_points(spark):
    st = staged(spark, {"a_t": 3, "b_h": 4})
    known = spark.createDataFrame([("a_t",), ("b_h",), ("c_e",)], "point string")
    man = manifest_from_rows(spark, [("type1", "a_t", 1), ("type1", "c_e", 2),
                                     ("type1", "zz_missing", 3), ("other", "c_e", 1),
                                     ("other", "b_h", 2)])
    al = build_wide(st, man, "type1", known_points=known)
    assert al.skipped == ["zz_missing"] and al.points == ["a_t", "c_e"]
    assert al.df.count() == 0                      # resolved point without rows
    rg = build_wide(st, man, "other", known_points=known)
    assert rg.df.count() == 4 and rg.base_point == "c_e"
    assert rg.df.filter(F.col("timestamp_e").isNull()).count() == 4
    assert build_wide(st, man, "type2") is None


def test_null_reading_still_aligns(spark):
    rows = [("a_t", 1, T0, None), ("b_h", 1, T0, 2.0)]
    st = spark.createDataFrame(rows, STAGED)
    man = manifest_from_rows(spark, [("type1", "a_t", 1), ("type1", "b_h", 2)])
    got = build_wide(st, man, "type1").df.collect()
    assert len(got) == 1 and got[0]["t"] is None and got[0]["h"] == 2.0


def test_four_collisions_all_kept(spark):
    st = staged(spark, {"a_temp": 2, "b_temp": 2, "c_temp": 2, "d_temp": 2})
    man = manifest_from_rows(spark, [("type2", p, i) for i, p in
                                     enumerate(["a_temp", "b_temp", "c_temp", "d_temp"])])
    w = build_wide(st, man, "type2")
    assert w.df.columns == ["unique_id", "timestamp", "temp__a_temp", "temp__b_temp",
                            "temp__c_temp", "temp__d_temp"]
    assert w.df.count() == 2


def test_duplicate_ids_raise(spark):
    rows = [("a_t", 1, T0, 1.0), ("a_t", 1, T0, 2.0), ("b_h", 1, T0, 2.0)]
    st = spark.createDataFrame(rows, STAGED)
    man = manifest_from_rows(spark, [("other", "a_t", 1), ("other", "b_h", 2)])
    with pytest.raises(Exception, match="not unique"):
        build_wide(st, man, "other").df.collect()


@pytest.mark.parametrize("kind", ["aligned", "ragged"])
def test_many_point_path_equals_single_pivot(spark, kind):
    from canopy.operators.wide import pivot_points
    st = td.staged(td.events_five(spark, SF01))
    pts = ["click", "error", "purchase", "signup", "view"]
    a = pivot_points(st, pts, pts, kind)
    b = pivot_points(st, pts, pts, kind, block_points=2)
    assert a.columns == b.columns and a.schema == b.schema
    assert rows_of(a) == rows_of(b)


def test_many_point_path_guard(spark):
    from canopy.operators.wide import pivot_points
    rows = [("a_t", 1, T0, 1.0), ("a_t", 1, T0, 2.0), ("b_h", 1, T0, 2.0), ("c_x", 1, T0, 1.0)]
    st = spark.createDataFrame(rows, STAGED)
    with pytest.raises(Exception, match="not unique"):
        pivot_points(st, ["a_t", "b_h", "c_x"], ["t", "h", "x"], "ragged",
                     block_points=1).collect()


@pytest.mark.parametrize("kind", ["aligned", "ragged"])
def test_many_point_path_is_one_exchange(spark, kind, tmp_root):
    from canopy.operators.wide import pivot_points
    from canopy.plans.inspect import plan_summary
    path = tmp_root + "/staged"
    td.staged(td.events_five(spark, SF01)).write.parquet(path)
    pts = ["click", "error", "purchase", "signup", "view"]
    shape = plan_summary(pivot_points(spark.read.parquet(path), pts, pts, kind, block_points=2))
    assert shape["hash_exchanges"] == 1 and shape["scans"] == 1
