"""The stream with state of its own: equals batch runs; a timer releases held rows."""
import datetime as dt
import os
import time

from canopy import registry as R
from canopy import registry_stored as S
from canopy.plans.runner import open_stores, run_extract
from canopy.sources.store import StagedStore
from canopy.streaming.stateful_extract import point_state, start_stateful_extract

from conftest import SF001

SCHEMA = "point string, ts timestamp_ntz, value double, sensor string"


def rows(df):
    return sorted((r.point, r.unique_id, r.ts, r.value) for r in df.collect())


def offset_to(moment):
    return moment - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def staged(spark, root):
    found = StagedStore(spark, root).read()
    return [] if found is None else rows(found)


def test_equals_the_stream_over_snapshots(spark):
    store, checkpoint = S.stateful_stream(spark, SF001)
    assert rows(store.read()) == rows(R.q_stream_extract(spark, SF001))
    counts = {r.point: r["count"] for r in store.read().groupBy("point").count().collect()}
    assert {r.point: r.last_used_id for r in point_state(spark, checkpoint).collect()} == counts


def test_a_timer_releases_what_waits_for_its_day(spark, tmp_root):
    """Rows past midnight come with a file of the day before; no later file comes."""
    day = dt.datetime(2024, 1, 30)
    first = [(p, day + dt.timedelta(hours=h), float(h), s) for p in (" P", "q") for h in (3, 1, 2) for s in "ba"]
    past = [("P", day + dt.timedelta(days=1, seconds=5 + k), 7.0 + k, "a") for k in range(3)]
    src, ckpt, root = (os.path.join(tmp_root, x) for x in ("src", "ckpt", "store"))
    spark.createDataFrame(first + past, SCHEMA).coalesce(1).write.parquet(src)
    pts = spark.createDataFrame([("p",), ("Q ",)], "point string")
    schema = spark.createDataFrame([], SCHEMA).schema
    midnight = day + dt.timedelta(days=1)
    offset = offset_to(midnight - dt.timedelta(seconds=45))
    query = start_stateful_extract(spark, src, schema, root, pts, ckpt, clock_offset=offset, interval="1 second")
    try:
        seen, end = 0, time.time() + 150
        while time.time() < end and len(staged(spark, root)) < len(first) + len(past):
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + offset
            n = len(staged(spark, root))
            if now < midnight - dt.timedelta(seconds=3):
                seen = max(seen, n)
            time.sleep(1)
    finally:
        query.stop()
    assert seen == len(first)              # the later rows waited
    st = open_stores(spark, os.path.join(tmp_root, "batch"))
    whole = spark.createDataFrame(first + past, SCHEMA)
    for k, d in enumerate((day.date(), midnight.date())):
        run_extract(spark, whole, pts, st, d, k)
    assert staged(spark, root) == rows(st.staged.read())


def test_held_rows_without_a_timer_come_with_the_next_reading(spark, tmp_root):
    t = dt.datetime(2024, 1, 30, 12)
    src, ckpt, root = (os.path.join(tmp_root, x) for x in ("src", "ckpt", "store"))
    pts = spark.createDataFrame([("p",)], "point string")
    schema = spark.createDataFrame([], SCHEMA).schema
    drops = [(t, [("p", t, 1.0, "a"), ("p", t + dt.timedelta(days=1), 3.0, "a"), ("x", t, 9.0, "a")]),
             (t + dt.timedelta(days=1, hours=1), [("p", t + dt.timedelta(hours=20), 2.0, "a"), ("p", t, 5.0, "late")]),
             (t + dt.timedelta(days=1, hours=2), [])]
    for now, part in drops:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        start_stateful_extract(spark, src, schema, root, pts, ckpt, clock_offset=offset_to(now)).awaitTermination()
    assert [(i, v) for _, i, _, v in staged(spark, root)] == [(1, 1.0), (2, 2.0), (3, 3.0)]
