"""Kept statistics: merging, exact sums, purged days, runs that broke off."""
import datetime as dt
import math

from pyspark.sql import functions as F

from canopy import registry_stored as S
from canopy.operators import partials as P
from canopy.operators.query import column_stats
from canopy.plans.runner import open_stores, run_extract
from canopy.sources import testdata as td

from conftest import SF001

DAY = dt.datetime(2024, 1, 5)


def staged(spark, rows):
    return spark.createDataFrame([(p, i, DAY + dt.timedelta(hours=h), v) for p, i, h, v in rows],
                                 "point string, unique_id long, ts timestamp_ntz, value double")


def test_merging_is_exact_whatever_the_order(spark):
    rows = [("p", k, k % 70, 0.01 * ((k * 7919) % 10000)) for k in range(3000)]
    parts = [P.day_partials(staged(spark, rows[k::5])) for k in range(5)]
    one = P.value_stats(P.folded(parts, None)).first()
    two = P.value_stats(P.folded(parts[::-1], None)).first()
    want = sum(round(v * 100) for *_, v in rows) / 100 / len(rows)
    assert one == two and one.avg_value == want and one.non_null_count == 3000


def test_readings_beyond_decimals(spark):
    rows = [("a", 1, 0, None), ("b", 1, 0, float("nan")), ("b", 2, 1, 1.0), ("c", 1, 0, math.inf), ("d", 1, 0, 1e300),
            ("d", 2, 0, 2.5)]
    got = {r.point: r for r in P.value_stats(P.day_partials(staged(spark, rows))).collect()}
    assert (got["a"].min_value, got["a"].avg_value, got["a"].non_null_count) == (None, None, 0)
    assert math.isnan(got["b"].avg_value) and got["c"].avg_value == math.inf and got["d"].avg_value == 5e299


def test_partials_equal_the_statistics_of_the_rows(spark):
    st = S.kept_runs(spark, SF001)
    rows, (partials, _) = st.staged.read(), st.partials.latest()
    for r in P.value_stats(partials).collect():
        own = rows.filter(F.col("point") == r.point).select(F.col("value").alias("v"))
        want = column_stats(own, ["v"]).first()
        assert (r.min_value, r.max_value, r.non_null_count) == (want.min_value, want.max_value, want.non_null_count)
        assert abs(r.avg_value - want.avg_value) < 1e-9
    # nothing of the purged days is left
    assert partials.agg(F.min("day")).first()[0] == rows.agg(F.to_date(F.min("ts"))).first()[0]
    assert partials.count() == rows.select("point", F.to_date("ts")).distinct().count()


def test_a_run_without_snapshot_is_taken_in_later(spark, tmp_root):
    src = td.events_five(spark, SF001)
    pts = src.select("point").distinct()
    st = open_stores(spark, tmp_root)
    for k, day in enumerate([dt.date(2024, 1, 8), dt.date(2024, 1, 16), dt.date(2024, 1, 30)]):
        run_extract(spark, src, pts, st, day, k, tiebreak=["event_id"])
        if k == 1:                           # as if it had broken off before its snapshot and its log
            st.staged.fs.delete(f"{st.partials.path}/run=1")
            st.staged.fs.delete(f"{st.changes.path}/run=1")
    rows, (partials, _) = st.staged.read(), st.partials.latest()
    assert partials.agg(F.sum("rows")).first()[0] == rows.count()
    assert partials.agg(F.sum("rows"), F.sum("value_count")).first() == rows.agg(F.count("*"), F.count("value")).first()
    logged = st.changes.logs().groupBy("point").agg(F.max("last_id").alias("m"), F.min("first_id").alias("n"))
    assert sorted(map(tuple, logged.collect())) == sorted(map(tuple, rows.groupBy("point").agg(
        F.max("unique_id"), F.min("unique_id")).collect()))


def test_only_the_points_of_the_run_are_purged(spark, tmp_root):
    st = open_stores(spark, tmp_root)
    t = dt.datetime(2024, 1, 1)
    src = spark.createDataFrame([(p, t + dt.timedelta(days=d), 1.0) for p in "ab" for d in (0, 40)],
                                "point string, ts timestamp_ntz, value double")
    both, one = (spark.createDataFrame([(p,) for p in ps], "point string") for ps in ("ab", "a"))
    run_extract(spark, src, both, st, dt.date(2024, 1, 2), 1)
    run_extract(spark, src, one, st, dt.date(2024, 2, 10), 2)
    got = {(r.point, r.day): r.rows for r in st.partials.latest()[0].collect()}
    assert got == {("a", dt.date(2024, 2, 10)): 1, ("b", dt.date(2024, 1, 1)): 1}
