"""SURVEY §5 (3): the streaming extract equals the same sequence of batch
runs (one run per file drop, run id = micro-batch id)."""
import datetime as dt
import os

from pyspark.sql import functions as F

from canopy.plans.runner import open_stores, run_extract
from canopy.sources import testdata as td
from canopy.streaming.extract_stream import stage_pending, start_extract_stream

from conftest import SF001

AS_OF = dt.date(2024, 1, 31)
BOUNDS = [None, "2024-01-11", "2024-01-21", None]


def _slices(ev):
    for lo, hi in zip(BOUNDS[:-1], BOUNDS[1:]):
        sl = ev
        if lo:
            sl = sl.filter(F.col("ts") >= F.lit(lo).cast(ev.schema["ts"].dataType))
        if hi:
            sl = sl.filter(F.col("ts") < F.lit(hi).cast(ev.schema["ts"].dataType))
        yield sl


def test_stream_equals_batch_sequence(spark, tmp_root):
    ev = td.events_five(spark, SF001)
    pts = ev.select("point").distinct()
    streamed = open_stores(spark, os.path.join(tmp_root, "s"))
    src_dir, ckpt = os.path.join(tmp_root, "src"), os.path.join(tmp_root, "ckpt")
    for sl in _slices(ev):
        sl.write.mode("append").parquet(src_dir)
        start_extract_stream(spark, src_dir, ev.schema, streamed, pts, AS_OF, ckpt,
                             tiebreak=["event_id"], buffer_seconds=6 * 3600).awaitTermination()
    batched = open_stores(spark, os.path.join(tmp_root, "b"))
    for i, sl in enumerate(_slices(ev)):
        run_extract(spark, sl, pts, batched, AS_OF, run_id=i, run_ts=dt.datetime(2024, 1, 31),
                    tiebreak=["event_id"], buffer_seconds=6 * 3600)
    cols = ["point", "unique_id", "ts", "value"]
    a = sorted(tuple(r) for r in streamed.staged.read().select(*cols).collect())
    b = sorted(tuple(r) for r in batched.staged.read().select(*cols).collect())
    assert a == b and len(a) > 0
    assert streamed.staged.runs() == [0, 1, 2]


def test_row_past_midnight_waits_for_its_day(spark, tmp_root):
    """Both rows arrive in one file on the first day; the second is of the next."""
    rows = [("p", dt.datetime(2024, 1, 30, 23, 0), 1.0), ("p", dt.datetime(2024, 1, 31, 0, 5), 2.0)]
    late = [("p", dt.datetime(2024, 1, 31, 9, 0), 3.0), ("p", dt.datetime(2024, 2, 1, 9, 0), 4.0)]
    schema = "point string, ts timestamp, value double"
    pts = spark.createDataFrame([("p",)], "point string")
    days = [dt.date(2024, 1, 30), dt.date(2024, 1, 31)]
    st = open_stores(spark, os.path.join(tmp_root, "s"))
    src_dir, ckpt = os.path.join(tmp_root, "src"), os.path.join(tmp_root, "ckpt")
    for day, part in zip(days, (rows, late)):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src_dir)
        start_extract_stream(spark, src_dir, spark.createDataFrame([], schema).schema, st, pts,
                             lambda day=day: day, ckpt).awaitTermination()
    assert stage_pending(spark, st, pts, dt.date(2024, 2, 1)) is not None
    batched = open_stores(spark, os.path.join(tmp_root, "b"))
    whole = spark.createDataFrame(rows + late, schema)
    for k, day in enumerate([*days, dt.date(2024, 2, 1)]):
        run_extract(spark, whole, pts, batched, day, run_id=k)
    key = lambda df: sorted((r.unique_id, r.ts, r.value) for r in df.collect())
    assert key(st.staged.read()) == key(batched.staged.read())
    assert [v for _, _, v in key(st.staged.read())] == [1.0, 2.0, 3.0, 4.0]


def test_batch_then_stream_share_one_store(spark, tmp_root):
    schema = "point string, ts timestamp, value double"
    pts = spark.createDataFrame([("p",)], "point string")
    for first in (0, 20240130):
        root = os.path.join(tmp_root, str(first))
        st = open_stores(spark, os.path.join(root, "s"))
        one = spark.createDataFrame([("p", dt.datetime(2024, 1, 30, 1), 1.0)], schema)
        run_extract(spark, one, pts, st, dt.date(2024, 1, 30), run_id=first)
        two = spark.createDataFrame([("p", dt.datetime(2024, 1, 30, 2), 2.0)], schema)
        two.write.parquet(os.path.join(root, "src"))
        start_extract_stream(spark, os.path.join(root, "src"), two.schema, st, pts, dt.date(2024, 1, 30),
                             os.path.join(root, "ckpt")).awaitTermination()
        assert sorted((r.unique_id, r.value) for r in st.staged.read().collect()) == [(1, 1.0), (2, 2.0)]
