"""One scan over all points: errors beside the rows, pushed bounds, bundles."""
import datetime as dt
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan

from canopy.plans.inspect import plan_summary
from canopy.sources import testdata as td
from canopy.sources.point_scan import PointReader, scan_points

from conftest import SF001

SCHEMA = "ts timestamp_ntz, value double, event_id bigint"
POINTS = ["click", "error", "purchase", "signup", "view"]


@pytest.fixture()
def series(spark, tmp_root):
    td.events_five(spark, SF001).write.partitionBy("point").parquet(f"{tmp_root}/series")
    return {p: f"{tmp_root}/series/point={p}" for p in POINTS}


def rows(df):
    return sorted(map(tuple, df.select("point", "ts", "value", "event_id").collect()), key=str)


def test_rows_equal_the_table(spark, series):
    got, errors = scan_points(spark, {p.upper() + " ": at for p, at in series.items()}, SCHEMA, tasks=2)
    assert rows(got) == rows(td.events_five(spark, SF001)) and errors.count() == 0


def test_bounds_starts_and_cuts(spark, series):
    lo, hi, own = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 12)
    got, _ = scan_points(spark, series, SCHEMA, lower=lo, upper=hi, starts={"click": own},
                         cuts=[dt.datetime(2024, 1, d) for d in (3, 10, 15, 28)], tasks=4)
    want = td.events_five(spark, SF001).filter(
        (F.col("ts") > F.lit(lo)) & (F.col("ts") < F.lit(hi)) & ((F.col("point") != "click") | (F.col("ts") > F.lit(own))))
    assert rows(got) == rows(want)


def test_points_that_fail(spark, series, tmp_root):
    """Absent, not Parquet, without the column, and broken behind its first rows."""
    folder = series["view"]
    f = [x for x in os.listdir(folder) if x.endswith(".parquet")][0]
    open(f"{folder}/{f}", "wb").write(b"no parquet")
    spark.range(3).write.parquet(f"{tmp_root}/other")
    half = series["signup"]
    spark.createDataFrame([("x",)], "line string").write.text(f"{tmp_root}/text")
    part = [x for x in os.listdir(f"{tmp_root}/text") if x.endswith(".txt")][0]
    os.rename(f"{tmp_root}/text/{part}", f"{half}/part-99999.parquet")    # read last
    bad = series | {"purchase": f"{tmp_root}/none", "error": f"{tmp_root}/other"}
    got, errors = scan_points(spark, bad, SCHEMA, lower=dt.datetime(2024, 1, 5), cuts=[dt.datetime(2024, 1, 15)])
    assert sorted(r.point for r in errors.collect()) == ["error", "purchase", "signup", "view"]
    assert {r.point for r in got.select("point").distinct().collect()} == {"click"}


def test_an_opener_of_ones_own(spark):
    def numbers(location, lower, upper, columns):
        first = dt.datetime(2024, 1, 1)
        times = [first + dt.timedelta(hours=k) for k in range(int(location))]
        times = [t for t in times if (lower is None or t > lower) and (upper is None or t < upper)]
        yield pa.RecordBatch.from_arrays([pa.array(times, pa.timestamp("us")), pa.array([1.5] * len(times))], names=columns)
        if location == "7":
            raise RuntimeError("lost connection")

    got, errors = scan_points(spark, {"a": "5", "b": "7"}, "ts timestamp_ntz, value double", opener=numbers,
                              lower=dt.datetime(2024, 1, 1))
    assert got.count() == 4 and [tuple(r) for r in errors.collect()] == [("b", "RuntimeError: lost connection")]


def test_empty_scan(spark):
    got, errors = scan_points(spark, {}, SCHEMA)
    assert got.count() == 0 and errors.count() == 0


def test_one_scan_whatever_the_points(spark, series):
    got, _ = scan_points(spark, series, SCHEMA)
    assert plan_summary(got)["scans"] == 2       # of the written table: rows and failed points


def reader(**options):
    import json
    base = {"series": json.dumps([["a", "x", None], ["b", "y", "2024-01-05T00:00:00"]]), "schema": SCHEMA,
            "columns": json.dumps(["ts", "value", "event_id"]), "cuts": json.dumps(["2024-01-03T00:00:00"]), "tasks": "2"}
    return PointReader(base | options)


def test_pushed_filters_prune_slices():
    r = reader()
    assert sum(len(p.value) for p in r.partitions()) == 3       # b starts behind the cut
    t = dt.datetime(2024, 1, 4)
    left = list(r.pushFilters([IsNotNull(("ts",)), GreaterThan(("ts",), t), In(("point",), ("a", "b")),
                               EqualTo(("value",), 1.0)]))
    assert left == [EqualTo(("value",), 1.0)]
    assert sorted(p for part in r.partitions() for p, *_ in part.value) == ["a", "b"]
    list(r.pushFilters([EqualTo(("point",), "a"), LessThan(("ts",), dt.datetime(2024, 1, 9)), GreaterThanOrEqual(("ts",), t)]))
    assert [p.value for p in r.partitions()] == [[("a", "x", t, dt.datetime(2024, 1, 9))]]
    list(r.pushFilters([LessThan(("ts",), dt.datetime(2024, 1, 1))]))
    assert [p.value for p in r.partitions()] == [[]]
