import datetime as dt

from pyspark.sql import functions as F

from canopy.operators.sequence import _order, assign_sequence, range_parts
from canopy.sources import testdata as td

from conftest import SF01


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_hot_split_equals_plain_window(spark):
    src = td.events_five(spark, SF01)
    plain = assign_sequence(src, "point", "ts", ["event_id"])
    split = assign_sequence(src, "point", "ts", ["event_id"], max_rows_per_task=97)
    cols = ["point", "event_id", "unique_id"]
    assert _rows(plain, cols) == _rows(split, cols)
    # ids are 1..n per point
    agg = split.groupBy("point").agg(F.min("unique_id"), F.max("unique_id"), F.count("*"))
    for _, lo, hi, n in agg.collect():
        assert lo == 1 and hi == n


def test_hot_split_lineitem_ties(spark):
    src = td.bench_source(spark, SF01)
    tb = td.LINEITEM_TIEBREAK + ["value"]
    cols = ["point", "l_orderkey", "l_linenumber", "l_partkey", "value", "unique_id"]
    a = _rows(assign_sequence(src, "point", "ts", tb), cols)
    b = _rows(assign_sequence(src, "point", "ts", tb, max_rows_per_task=40), cols)
    assert a == b


def test_base_offset_and_nulls(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("p", t + dt.timedelta(minutes=i), i, 10) for i in range(50)]
    rows += [("p", None, 100, 10), ("q", t, 1, 0)]
    df = spark.createDataFrame(rows, "point string, ts timestamp, k int, base long")
    for limit in (None, 7):
        out = {(r.point, r.k): r.unique_id for r in
               assign_sequence(df, "point", "ts", ["k"], base="base",
                               max_rows_per_task=limit).collect()}
        assert out[("p", 100)] == 11          # null time sorts first (asc nulls first)
        assert out[("p", 0)] == 12 and out[("p", 49)] == 61
        assert out[("q", 1)] == 1


def test_descending_whole_frame(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(t + dt.timedelta(hours=i), i) for i in range(30)] + [(None, 99)]
    df = spark.createDataFrame(rows, "ts timestamp, k int")
    for limit in (None, 4):
        out = {r.k: r.rank for r in assign_sequence(df, [], "ts", ["k"], out="rank",
                                                    descending=True,
                                                    max_rows_per_task=limit).collect()}
        assert out[29] == 1 and out[0] == 30 and out[99] == 31   # nulls last


def test_uneven_time_gives_even_parts(spark):
    """One reading from 1970, a burst, half of all times equal, and missing times."""
    t, limit = dt.datetime(2024, 1, 1), 100
    rows = [("p", dt.datetime(1970, 1, 1), 0)]
    rows += [("p", t + dt.timedelta(microseconds=i), i) for i in range(1, 1200)]
    rows += [("p", t + dt.timedelta(days=1), i) for i in range(1200, 5000)]
    rows += [("p", t + dt.timedelta(days=2, hours=i), i) for i in range(5000, 6500)]
    rows += [("p", None, i) for i in range(6500, 7600)] + [("q", t, i) for i in range(40)]
    df = spark.createDataFrame(rows, "point string, ts timestamp, k int").repartition(5)
    hot = df.filter("point = 'p'")
    parts = range_parts(hot, ["point"], _order("ts", ["k"], False), -(-2 * hot.count() // limit))
    assert parts.groupBy("point", "_seq_p").count().agg(F.max("count")).first()[0] <= 2 * limit
    got = _rows(assign_sequence(df, "point", "ts", ["k"], max_rows_per_task=limit), ["point", "k", "unique_id"])
    assert got == _rows(assign_sequence(df, "point", "ts", ["k"]), ["point", "k", "unique_id"])
