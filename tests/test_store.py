"""Runner + stores: two runs through files equal the lazy two-run result;
a replayed run is idempotent; retention drops day partitions; wide tables
skip empty results; CSV export."""
import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from canopy import registry as R
from canopy.plans.runner import open_stores, run, run_extract, run_transform
from canopy.sources import testdata as td
from canopy.sources.manifest import manifest_from_rows

from conftest import SF001


def rows(df):
    return sorted(tuple(r) for r in df.select("point", "unique_id", "ts", "value").collect())


def test_two_runs_through_stores(spark, tmp_root):
    src = td.events_five(spark, SF001)
    pts = src.select("point").distinct()
    st = open_stores(spark, tmp_root)
    for i, d in enumerate([R.FIRST_AS_OF, R.SECOND_AS_OF]):
        run_extract(spark, src, pts, st, d, run_id=i + 1, tiebreak=["event_id"]).collect()
    expected = R.q_extract_incremental(spark, SF001)
    assert rows(st.staged.read()) == rows(expected)
    # replaying run 2 gives the same rows and ids
    run_extract(spark, src, pts, st, R.SECOND_AS_OF, run_id=2, tiebreak=["event_id"]).collect()
    assert rows(st.staged.read()) == rows(expected)
    state = {r.point: r.last_used_id for r in st.state.read().collect()}
    counts = {r.point: r["count"] for r in expected.groupBy("point").count().collect()}
    assert state == counts
    assert st.state.versions() == [1, 2]


def test_retention_drops_day_partitions(spark, tmp_root):
    src = td.events_five(spark, SF001)
    pts = src.select("point").distinct()
    st = open_stores(spark, tmp_root)
    run_extract(spark, src, pts, st, dt.date(2024, 1, 30), run_id=1, tiebreak=["event_id"])
    before = st.staged.read().count()
    # a later run: cutoff 2024-01-11 -> days before it are dropped
    run_extract(spark, src, pts, st, dt.date(2024, 2, 10), run_id=2, tiebreak=["event_id"])
    after = st.staged.read()
    assert after.agg(F.min("ts")).first()[0] >= dt.datetime(2024, 1, 11)
    assert 0 < after.count() < before
    # ids are not compacted
    assert after.agg(F.min("unique_id")).first()[0] > 1


def test_transform_skip_on_empty_and_export(spark, tmp_root):
    src = td.events_five(spark, SF001)
    pts = src.select("point").distinct()
    st = open_stores(spark, tmp_root)
    run_extract(spark, src, pts, st, dt.date(2024, 1, 30), run_id=1, tiebreak=["event_id"])
    man = td.ordered_manifest(src, ["type1", "other"])
    export = os.path.join(tmp_root, "export")
    status = {r.category: r for r in
              run_transform(spark, st, man, run_id=1, export_root=export,
                            when=dt.datetime(2024, 1, 30, 12)).collect()}
    assert status["type1"].rows_written > 0 and status["type2"].rows_written == 0
    assert st.wide.read("wide_other").count() == status["other"].rows_written
    exported = spark.read.option("header", True).csv(f"{export}/wide_type1_20240130_120000")
    assert exported.count() == status["type1"].rows_written
    # a manifest whose only point has no rows: the inner table is empty -> old version stays
    man2 = manifest_from_rows(spark, [("type1", "click", 1), ("type1", "nosuch", 2)])
    known_empty = manifest_from_rows(spark, [("type1", "view", 1), ("type1", "zz", 2)])
    before = st.wide.read("wide_type1").count()
    spark.createDataFrame([("zz", None, None, 0)],
                          "point string, last_run_date date, last_run_timestamp timestamp_ntz, "
                          "last_used_id long").unionByName(st.state.read()).write.parquet(
        f"{st.state.path}/run=5")
    run_transform(spark, st, known_empty, run_id=6, categories=["type1"]).collect()
    assert st.wide.read("wide_type1").count() == before


def test_run_phase_checks(spark, tmp_root):
    st = open_stores(spark, tmp_root)
    empty = spark.createDataFrame([], "point string")
    try:
        run(spark, "extract", st, source=None, points=empty, as_of=dt.date(2024, 1, 1))
        raise AssertionError("expected failure")
    except ValueError:
        pass
    src = td.events_five(spark, SF001)
    out = run(spark, "extract", st, source=src, points=src.select("point").distinct(),
              as_of=dt.date(2024, 1, 30), run_id=1, dry_run=True, tiebreak=["event_id"])
    assert "Window" in out["extract"] and st.staged.read() is None


def test_crash_between_data_and_state(spark, tmp_root):
    """Run 2 writes its rows and dies before state and marks: run 3 must
    still continue ids and high-water marks from run 2's rows (scanning only
    the un-marked run partition), equal to a clean run sequence."""
    from canopy.operators.extract import extract_and_stage
    src = td.events_five(spark, SF001)
    pts = src.select("point").distinct()
    days = [dt.date(2024, 1, 12), dt.date(2024, 1, 20), dt.date(2024, 1, 30)]
    clean = open_stores(spark, os.path.join(tmp_root, "clean"))
    for i, d in enumerate(days):
        run_extract(spark, src, pts, clean, d, run_id=i + 1, tiebreak=["event_id"]).collect()
    crash = open_stores(spark, os.path.join(tmp_root, "crash"))
    run_extract(spark, src, pts, crash, days[0], run_id=1, tiebreak=["event_id"]).collect()
    res = extract_and_stage(src, pts, days[1], crash.staged.read(before_run=2),
                            crash.state.read(before_run=2), tiebreak=["event_id"])
    crash.staged.write_run(res.new_rows, 2)                      # ... and no state / marks
    assert crash.marks.versions() == [1] and crash.state.versions() == [1]
    run_extract(spark, src, pts, crash, days[2], run_id=3, tiebreak=["event_id"]).collect()
    assert rows(crash.staged.read()) == rows(clean.staged.read())
    got = {r.point: r.last_used_id for r in crash.state.read().collect()}
    assert got == {r.point: r.last_used_id for r in clean.state.read().collect()}


def test_purged_point_restarts_from_lookback(spark, tmp_root):
    """When retention removed every row of a point, the next run starts from
    the lookback (the marks say so without a scan), ids keep counting."""
    src = td.events_five(spark, SF001)
    pts = src.select("point").distinct()
    st = open_stores(spark, tmp_root)
    run_extract(spark, src, pts, st, dt.date(2024, 1, 30), run_id=1, tiebreak=["event_id"])
    n1 = {r.point: r.last_used_id for r in st.state.read().collect()}
    run_extract(spark, src, pts, st, dt.date(2024, 3, 15), run_id=2, tiebreak=["event_id"])
    assert st.staged.read() is None                              # everything aged out
    m = st.marks.read().collect()
    assert all(r.last_ts < r.retained_from for r in m)
    status = {r.point: (r.new_rows, r.last_used_id) for r in
              run_extract(spark, src, pts, st, dt.date(2024, 3, 20), run_id=3,
                          tiebreak=["event_id"]).collect()}
    assert status == {p: (0, n) for p, n in n1.items()}


def test_purge_only_the_runs_points(spark, tmp_root):
    """Retention purges only the run's manifest points (as the original,
    which purged only the tables it processed); day folders holding other
    points are rewritten with just those points' rows."""
    src = td.events_five(spark, SF001)
    every = src.select("point").distinct()
    st = open_stores(spark, tmp_root)
    run_extract(spark, src, every, st, dt.date(2024, 1, 30), run_id=1, tiebreak=["event_id"])
    before = {r.point: r.n for r in st.staged.read().groupBy("point")
              .agg(F.count("*").alias("n")).collect()}
    only_click = spark.createDataFrame([("click",)], "point string")
    run_extract(spark, src, only_click, st, dt.date(2024, 2, 10), run_id=2, tiebreak=["event_id"])
    cutoff = dt.datetime(2024, 1, 11)
    rows_ = st.staged.read()
    click = rows_.filter(F.col("point") == "click")
    assert click.agg(F.min("ts")).first()[0] >= cutoff
    others = {r.point: r.n for r in rows_.filter(F.col("point") != "click").groupBy("point")
              .agg(F.count("*").alias("n")).collect()}
    assert others == {p: n for p, n in before.items() if p != "click"}   # untouched
    marks = {r.point: r.retained_from for r in st.marks.read().collect()}
    assert marks["click"] == cutoff and marks["view"] < cutoff
    # a later run over every point continues ids and purges everyone
    run_extract(spark, src, every, st, dt.date(2024, 2, 12), run_id=3, tiebreak=["event_id"])
    assert st.staged.read().agg(F.min("ts")).first()[0] >= dt.datetime(2024, 1, 13)


# ---------------------------------------------------------------- run ids, replay, recovery
def one_point(spark, rows):
    return spark.createDataFrame([(p, t, float(k)) for k, (p, t) in enumerate(rows)], "point string, ts timestamp, value double")


def points_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "point string")


def test_never_reporting_point_is_skipped(spark, tmp_root):
    t = dt.datetime(2024, 1, 29)
    src = one_point(spark, [("a_t", t), ("a_t", t + dt.timedelta(hours=1)), ("b_h", t)])
    st = open_stores(spark, tmp_root)
    names = ["a_ghost", "a_t", "b_h"]
    run_extract(spark, src, points_of(spark, *names), st, dt.date(2024, 1, 30), 1)
    man = manifest_from_rows(spark, [(c, n, k) for c in ("type1", "other") for k, n in enumerate(names)])
    got = {r.category: r for r in run_transform(spark, st, man, 1, ["type1", "other"]).collect()}
    assert got["type1"].rows_written == 1 and got["other"].rows_written == 2
    assert got["type1"].skipped_points == got["other"].skipped_points == "a_ghost"
    assert st.wide.read("wide_other").columns[1] == "timestamp_t"
    # rows purged since: the point stays resolved, and empty
    run_extract(spark, src.limit(0), points_of(spark, *names), st, dt.date(2024, 6, 1), 2)
    src2 = one_point(spark, [("a_t", dt.datetime(2024, 6, 2))])
    run_extract(spark, src2, points_of(spark, *names), st, dt.date(2024, 6, 2), 3)
    got = {r.category: r for r in run_transform(spark, st, man, 4, ["type1", "other"]).collect()}
    assert got["type1"].rows_written == 0 and got["other"].rows_written == 1
    assert got["other"].skipped_points == "a_ghost"


def test_run_ids_of_other_writers_are_refused(spark, tmp_root):
    t = dt.datetime(2024, 1, 29)
    src = one_point(spark, [("p", t)])
    st = open_stores(spark, tmp_root)
    run_extract(spark, src, points_of(spark, "p"), st, dt.date(2024, 1, 30), 20240130)
    with pytest.raises(ValueError, match="not newer"):
        run_extract(spark, src, points_of(spark, "p"), st, dt.date(2024, 1, 30), 5)
    assert st.ids.claim("stream-x", "0") == 20240131 == st.ids.claim("stream-x", "0")
    with pytest.raises(ValueError, match="not newer"):
        st.ids.claim("batch", "20240131", 20240131)


def test_replay_with_fewer_days_leaves_nothing_behind(spark, tmp_root):
    t = dt.datetime(2024, 1, 20)
    src = one_point(spark, [("p", t + dt.timedelta(days=k)) for k in range(4)])
    st = open_stores(spark, tmp_root)
    pts = points_of(spark, "p")
    run_extract(spark, src, pts, st, dt.date(2024, 1, 30), 1)
    assert len(st.staged.days()) == 4
    run_extract(spark, src.filter("value < 2"), pts, st, dt.date(2024, 1, 30), 1)
    assert [d for _, d in st.staged.days()] == ["2024-01-20", "2024-01-21"]
    run_extract(spark, src.limit(0), pts, st, dt.date(2024, 1, 30), 1)
    assert st.staged.read() is None


@pytest.mark.parametrize("second_rename_done", [False, True])
def test_broken_purge_is_recovered(spark, tmp_root, second_rename_done):
    t = dt.datetime(2024, 1, 20)
    st = open_stores(spark, tmp_root)
    run_extract(spark, one_point(spark, [("p", t), ("q", t)]), points_of(spark, "p", "q"), st, dt.date(2024, 1, 30), 1)
    run_dir = os.path.join(tmp_root, "staged", "run=1")
    day, aside = os.path.join(run_dir, "day=2024-01-20"), os.path.join(run_dir, "_purging_day=2024-01-20")
    if second_rename_done:
        shutil.copytree(day, aside)
    else:
        os.rename(day, aside)
    st = open_stores(spark, tmp_root)
    assert st.staged.read().count() == 2 and not os.path.exists(aside)


def test_files_follow_days_not_tasks(spark, tmp_root):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"p{k % 7}", t + dt.timedelta(minutes=4 * k)) for k in range(10000)]
    src = one_point(spark, rows).repartition(32)
    st = open_stores(spark, tmp_root)
    run_extract(spark, src, src.select("point").distinct(), st, dt.date(2024, 1, 30), 1)
    days = st.staged.days()
    files = [f for _, d in days for f in os.listdir(os.path.join(tmp_root, "staged", "run=1", f"day={d}"))
             if f.endswith(".parquet")]
    assert len(days) == 28 and len(files) <= 2 * len(days)


def test_failed_points_are_reported_and_keep_their_rows(spark, tmp_root):
    """A failed point brings no rows and is not purged; its state row moves as
    for a point without news, and a new one has a row, too."""
    t = dt.datetime(2024, 1, 29)
    st = open_stores(spark, tmp_root)
    first = one_point(spark, [("p", t), ("q", t)])
    run_extract(spark, first, points_of(spark, "P", "Q"), st, dt.date(2024, 1, 30), 1)
    later = one_point(spark, [("p", t + dt.timedelta(days=40)), ("q", t + dt.timedelta(days=40))])
    day = dt.date(2024, 3, 10)
    got = run_extract(spark, later, points_of(spark, "P", "Q", "R"), st, day, 2,
                      failed={" Q ": "table Q not found", "R": "gone"}).collect()
    assert sorted((r.point, r.new_rows, r.last_used_id, r.error) for r in got) == [
        ("p", 1, 2, None), ("q", 0, 1, "table Q not found"), ("r", 0, 0, "gone")]
    state = {r.point: (r.last_used_id, r.last_run_date) for r in st.state.read().collect()}
    assert state == {"p": (2, day), "q": (1, day), "r": (0, day)}
    assert sorted((r.point, r.ts) for r in st.staged.read().collect()) == [
        ("p", t + dt.timedelta(days=40)), ("q", t)]


def test_errors_frame_marks_failed_points(spark, tmp_root):
    t = dt.datetime(2024, 1, 29)
    st = open_stores(spark, tmp_root)
    errors = spark.createDataFrame([("Q", "b"), ("q", "a")], "point string, error string")
    got = run_extract(spark, one_point(spark, [("p", t), ("q", t)]), points_of(spark, "p", "q"), st,
                      dt.date(2024, 1, 30), 1, failed=errors).collect()
    assert sorted((r.point, r.new_rows, r.error) for r in got) == [("p", 1, None), ("q", 0, "a")]


def test_ids_do_not_depend_on_the_order_of_the_input(spark, tmp_root):
    """Readings of one time without any tie-break are numbered by value and the other columns."""
    t = dt.datetime(2024, 1, 29)
    rows = [("p", t, float(k % 3), f"s{k}", {"a": k}) for k in range(8)]
    schema = "point string, ts timestamp_ntz, value double, sensor string, tags map<string,int>"
    got = []
    for k, order in enumerate((rows, rows[::-1])):
        st = open_stores(spark, os.path.join(tmp_root, str(k)))
        run_extract(spark, spark.createDataFrame(order, schema).coalesce(1), points_of(spark, "p"), st,
                    dt.date(2024, 1, 30), 1)
        got.append(sorted((r.unique_id, r.value) for r in st.staged.read().collect()))
    assert got[0] == got[1] == [(k + 1, v) for k, v in enumerate(sorted(float(k % 3) for k in range(8)))]


def test_snapshots_and_claims_are_pruned(spark, tmp_root):
    from canopy.sources import store as S
    pts, t = points_of(spark, "p"), dt.datetime(2024, 1, 1)
    st = open_stores(spark, tmp_root)
    runs = S.KEEP_SNAPSHOTS + 4
    for k in range(runs):
        run_extract(spark, one_point(spark, [("p", t + dt.timedelta(days=k))]), pts, st,
                    dt.date(2024, 1, 1) + dt.timedelta(days=k), k)
    for name in ("state", "marks", "partials"):
        assert len([d for d in os.listdir(os.path.join(tmp_root, name)) if d.startswith("run=")]) == S.KEEP_SNAPSHOTS
    assert len(os.listdir(os.path.join(tmp_root, "writers", "batch"))) == S.KEEP_CLAIMS
    assert st.state.read().first().last_used_id == runs
    man = manifest_from_rows(spark, [("other", "p", 1)])
    for k in range(S.KEEP_WIDE + 3):
        run_transform(spark, st, man, runs + k, ["other"])
    assert len(os.listdir(os.path.join(tmp_root, "wide", "wide_other"))) == S.KEEP_WIDE
    assert st.wide.read("wide_other").count() == runs
    with pytest.raises(ValueError, match="not newer"):
        st.ids.claim("batch", "0", 0)       # an id that was given, and forgotten, is not given again


def test_ids_of_a_wide_table_have_bloom_filters(spark, tmp_root):
    """A look-up by id reads no page of the files that do not hold the id,
    though their bounds would let it in."""
    st = open_stores(spark, tmp_root)
    ids = spark.range(0, 40000).select(F.col("id").alias("unique_id"), F.rand(3).alias("v"))
    spread = ids.repartition(4).sortWithinPartitions("v")
    st.wide.replace("wide_other", spread, 1)
    top = os.path.join(tmp_root, "wide", "wide_other", "run=1")
    files = sorted(f for f in os.listdir(top) if f.endswith(".parquet"))
    assert len(files) == 4
    holds = [f for f in files if spark.read.parquet(f"{top}/{f}").filter("unique_id = 777").count()]
    import pyarrow.parquet as pq
    for f in set(files) - set(holds):
        meta = pq.ParquetFile(f"{top}/{f}").metadata
        assert meta.row_group(0).column(0).statistics.min < 777 < meta.row_group(0).column(0).statistics.max
        end = sum(meta.row_group(g).column(c).total_compressed_size for g in range(meta.num_row_groups) for c in range(2))
        data = open(f"{top}/{f}", "rb").read()
        open(f"{top}/{f}", "wb").write(data[:4] + b"\xff" * end + data[4 + end:])
        os.remove(f"{top}/.{f}.crc")
    got = st.wide.read("wide_other").filter("unique_id = 777").collect()
    assert [r.unique_id for r in got] == [777]


def test_export_keeps_all_digits_of_times(spark, tmp_root):
    st = open_stores(spark, tmp_root)
    t = dt.datetime(2024, 1, 29, 1, 2, 3, 456789)
    st.wide.replace("wide_other", spark.createDataFrame([(1, t, t)], "unique_id long, a timestamp_ntz, b timestamp"), 1)
    out = st.wide.export_csv("wide_other", os.path.join(tmp_root, "exports"), dt.datetime(2024, 1, 30))
    assert [r.value for r in spark.read.text(out).collect()][1] == "1,2024-01-29 01:02:03.456789,2024-01-29 01:02:03.456789"
