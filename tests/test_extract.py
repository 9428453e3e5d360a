"""Boundary rules of the incremental extract (inline edge rows)."""
import datetime as dt

from pyspark.sql import functions as F

from canopy.operators.extract import extract_and_stage, late_rows
from canopy.operators.state import apply_retention, last_ids, upsert_state

from conftest import SF001

AS_OF = dt.date(2024, 1, 31)
LOOKBACK = dt.datetime(2024, 1, 1)          # midnight of as_of - 30 days
END = dt.datetime(2024, 2, 1)
US = dt.timedelta(microseconds=1)
SCHEMA = "point string, ts timestamp_ntz, value double"
STAGED = "point string, unique_id long, ts timestamp_ntz, value double"
STATE = "point string, last_run_date date, last_run_timestamp timestamp_ntz, last_used_id long"


def src(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def pts(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "point string")


def ts_of(df):
    return sorted(r.ts for r in df.collect())


def test_first_run_bounds(spark):
    rows = [("p", LOOKBACK, 1.0), ("p", LOOKBACK + US, 2.0),          # lower bound strict
            ("p", END - US, 3.0), ("p", END, 4.0)]                     # upper bound
    r = extract_and_stage(src(spark, rows), pts(spark, "p"), AS_OF)
    assert ts_of(r.new_rows) == [LOOKBACK + US, END - US]
    assert [x.unique_id for x in r.new_rows.orderBy("ts").collect()] == [1, 2]


def test_buffer_and_late_rows(spark):
    hwm = dt.datetime(2024, 1, 20, 12)
    staged = spark.createDataFrame([("p", 5, hwm, 1.0)], STAGED)
    rows = [("p", hwm + dt.timedelta(seconds=10), 1.0),                # inside buffer: dropped
            ("p", hwm + dt.timedelta(seconds=10) + US, 2.0),           # read
            ("p", hwm - dt.timedelta(hours=1), 3.0)]                   # late: dropped
    r = extract_and_stage(src(spark, rows), pts(spark, "p"), AS_OF, staged=staged)
    got = r.new_rows.collect()
    assert [(x.unique_id, x.ts) for x in got] == [(6, hwm + dt.timedelta(seconds=10) + US)]
    audit = late_rows(src(spark, rows), r.staged, pts(spark, "p"), AS_OF, AS_OF).collect()
    assert audit[0].late_rows == 2


def test_null_reading_kept_and_numbered(spark):
    rows = [("p", dt.datetime(2024, 1, 5), None), ("p", dt.datetime(2024, 1, 6), 1.234)]
    r = extract_and_stage(src(spark, rows), pts(spark, "p"), AS_OF)
    got = sorted((x.unique_id, x.value) for x in r.new_rows.collect())
    assert got == [(1, None), (2, 1.23)]


def test_state_precedence(spark):
    # state row wins over data when larger; data max when the state lags; else 0
    staged = spark.createDataFrame([("a", 3, dt.datetime(2024, 1, 2), 1.0),
                                    ("b", 9, dt.datetime(2024, 1, 2), 1.0)], STAGED)
    state = spark.createDataFrame([("a", AS_OF, dt.datetime(2024, 1, 31), 40),
                                   ("b", AS_OF, dt.datetime(2024, 1, 31), 2)], STATE)
    ids = {r.point: r.last_used_id for r in
           last_ids(staged, state, pts(spark, "a", "b", "c")).collect()}
    assert ids == {"a": 40, "b": 9, "c": 0}
    rows = [(p, dt.datetime(2024, 1, 10), 1.0) for p in "abc"]
    r = extract_and_stage(src(spark, rows), pts(spark, "a", "b", "c"), AS_OF,
                          staged=staged, state=state)
    assert {x.point: x.unique_id for x in r.new_rows.collect()} == {"a": 41, "b": 10, "c": 1}


def test_no_new_rows_still_writes_state(spark):
    state = spark.createDataFrame([("p", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), 7)], STATE)
    r = extract_and_stage(src(spark, []), pts(spark, "p"), AS_OF, state=state,
                          run_ts=dt.datetime(2024, 1, 31, 9))
    s = r.state.collect()
    assert len(s) == 1 and s[0].last_used_id == 7 and s[0].last_run_date == AS_OF
    assert s[0].last_run_timestamp == dt.datetime(2024, 1, 31, 9)


def test_manifest_restricts_points(spark):
    rows = [("P", dt.datetime(2024, 1, 5), 1.0), ("other", dt.datetime(2024, 1, 5), 1.0)]
    r = extract_and_stage(src(spark, rows), pts(spark, " p "), AS_OF)
    assert [x.point for x in r.new_rows.collect()] == ["p"]
    assert [x.point for x in r.state.collect()] == ["p"]


def test_purge_boundary(spark):
    cutoff = dt.datetime(2024, 1, 1)
    staged = spark.createDataFrame([("p", 1, cutoff - US, 1.0), ("p", 2, cutoff, 1.0),
                                    ("q", 1, cutoff - US, 1.0)], STAGED)
    ret = apply_retention(staged, AS_OF, 30)
    assert [(x.point, x.unique_id) for x in ret.kept.collect()] == [("p", 2)]
    only_p = apply_retention(staged, AS_OF, 30, points=pts(spark, "p"), points_rows=1)
    assert sorted((x.point, x.unique_id) for x in only_p.kept.collect()) == [("p", 2), ("q", 1)]
    assert {x.point: x.purged_rows for x in only_p.purged.collect()} == {"p": 1}


def test_idle_restart_consumes_ids(spark):
    # staged data older than the cutoff: rows pulled after it are numbered, then purged
    staged = spark.createDataFrame([("p", 4, dt.datetime(2023, 12, 1), 1.0)], STAGED)
    rows = [("p", dt.datetime(2023, 12, 15), 1.0), ("p", dt.datetime(2024, 1, 15), 2.0)]
    r = extract_and_stage(src(spark, rows), pts(spark, "p"), AS_OF, staged=staged)
    assert sorted(x.unique_id for x in r.new_rows.collect()) == [5, 6]
    assert [x.unique_id for x in r.staged.collect()] == [6]
    assert r.state.first().last_used_id == 6


def test_upsert(spark):
    old = spark.createDataFrame([("a", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), 1),
                                 ("b", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), 2)], STATE)
    new = spark.createDataFrame([("b", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2), 5),
                                 ("c", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2), 1)], STATE)
    got = {r.point: r.last_used_id for r in upsert_state(old, new).collect()}
    assert got == {"a": 1, "b": 5, "c": 1}


def test_extract_plan_pushdown_and_broadcast(spark, tmp_root):
    """The run's upper bound reaches the Parquet scan, only the needed columns
    are read, and the per-point control table is broadcast (its row count is
    known from the manifest)."""
    from canopy.plans.inspect import plan_summary
    from canopy.sources import testdata as td
    from conftest import SF001
    src = td.events_five(spark, SF001)          # the full events table: 6 columns
    r = extract_and_stage(src, pts(spark, "click", "view"), AS_OF, tiebreak=["event_id"])
    s = plan_summary(r.new_rows)
    scan_filters = " ".join(s["pushed_filters"])
    assert "LessThan(ts," in scan_filters
    assert s["broadcasts"] >= 1
    assert s["read_schemas"] and all("props" not in rs and "user_id" not in rs
                                     for rs in s["read_schemas"])


def test_two_runs_equal_one_run_minus_late_rows(spark):
    """SURVEY §5 (3): the (point, ts) set staged by two runs plus the rows the
    audit reports as late equals what a single run over the same window
    stages; ids of the two-run staging are 1..n per point without gaps."""
    from canopy.sources import testdata as td
    from conftest import SF001
    src = td.events_five(spark, SF001)
    p = src.select("point").distinct()
    first, last, buf = dt.date(2024, 1, 15), dt.date(2024, 1, 30), 6 * 3600
    r1 = extract_and_stage(src, p, first, tiebreak=["event_id"], buffer_seconds=buf)
    r2 = extract_and_stage(src, p, last, staged=r1.staged, state=r1.state,
                           tiebreak=["event_id"], buffer_seconds=buf)
    # one run over the same window: first run's lookback, last run's end
    one = extract_and_stage(src, p, last, tiebreak=["event_id"], window_days=30 + 15)
    two = {(r.point, r.ts) for r in r2.staged.collect()}
    whole = {(r.point, r.ts) for r in one.new_rows.collect()}
    late = late_rows(src, r2.staged, p, first, last).collect()
    assert two <= whole
    assert len(whole) - len(two) == sum(r.late_rows for r in late) > 0
    per = r2.staged.groupBy("point").agg(F.min("unique_id").alias("lo"),
                                         F.max("unique_id").alias("hi"),
                                         F.count("*").alias("n")).collect()
    assert all(r.lo == 1 and r.hi == r.n for r in per)


def test_second_run_pushes_its_lower_bound(spark):
    """The scan of a later run is cut to what is new."""
    from canopy import registry as R
    from canopy.plans.inspect import plan_summary
    from canopy.sources import testdata as td

    source = td.events_five(spark, SF001)
    points = source.select("point").distinct()
    r1 = extract_and_stage(source, points, R.FIRST_AS_OF, tiebreak=["event_id"])
    r2 = extract_and_stage(source, points, R.SECOND_AS_OF, staged=R._written(r1.staged),
                           state=R._written(r1.state), tiebreak=["event_id"])
    pushed = " ".join(plan_summary(r2.new_rows)["pushed_filters"])
    newest = min(r["m"] for r in r1.staged.groupBy("point").agg(F.max("ts").alias("m")).collect())
    assert f"GreaterThan(ts,{newest.date().isoformat()}" in pushed and "LessThan(ts,2024-01-31" in pushed


def test_late_rows_share_a_time_and_outlive_a_purge(spark):
    t = dt.datetime(2024, 1, 20, 12)
    rows = [("p", t, 1.0), ("p", t, 2.0), ("p", t - dt.timedelta(days=1), 3.0), ("p", dt.datetime(2024, 1, 1), 4.0)]
    source = spark.createDataFrame(rows, "point string, ts timestamp, value double")
    staged = spark.createDataFrame([("p", 1, t, 1.0)], "point string, unique_id long, ts timestamp, value double")
    points = spark.createDataFrame([("p",)], "point string")
    got = late_rows(source, staged, points, dt.date(2024, 1, 5), dt.date(2024, 1, 25), window_days=10).collect()
    assert [(r.late_rows, r.first_late_ts) for r in got] == [(2, t - dt.timedelta(days=1))]
