"""Per-point source tables over JDBC (embedded, in-process Derby: no server)."""
import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from canopy.operators.extract import extract_and_stage
from canopy.plans.inspect import plan_summary
from canopy.sources.telemetry import jdbc_source


@pytest.fixture(scope="module")
def derby(spark):
    url = f"jdbc:derby:memory:src{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    t0 = dt.datetime(2024, 1, 1)
    for name, n in (("SX_AIR_TEMP", 40), ("SX_SOIL_1", 25)):
        rows = [(t0 + dt.timedelta(hours=i), float(i) + 0.125) for i in range(n)]
        df = spark.createDataFrame(rows, "timestamp timestamp, value double")
        (df.write.format("jdbc").option("url", url).option("dbtable", name)
         .option("driver", props["driver"]).mode("overwrite").save())
    return url, props


def test_partitioned_read_and_pushdown(spark, derby):
    url, props = derby
    src = jdbc_source(spark, url, ["SX_AIR_TEMP", "SX_SOIL_1"], ts_col="timestamp",
                      lower=dt.datetime(2024, 1, 1), upper=dt.datetime(2024, 1, 3),
                      num_partitions=4, properties=props)
    assert src.count() == 65
    f = src.filter((F.col("ts") > F.lit("2024-01-01 10:00:00").cast("timestamp")))
    assert any("GreaterThan(" in p for p in plan_summary(f)["pushed_filters"])
    assert f.count() == 29 + 14


def test_extract_from_jdbc(spark, derby):
    url, props = derby
    src = jdbc_source(spark, url, ["SX_AIR_TEMP", "SX_SOIL_1"], properties=props)
    pts = spark.createDataFrame([("SX_AIR_TEMP",), ("SX_SOIL_1",)], "point string")
    r = extract_and_stage(src, pts, dt.date(2024, 1, 2))
    got = {x.point: x.n for x in r.new_rows.groupBy("point").agg(F.count("*").alias("n")).collect()}
    assert got == {"sx_air_temp": 40, "sx_soil_1": 25}
    v = r.new_rows.filter(F.col("unique_id") == 1).select("value").first()[0]
    assert v == 0.13                                  # ROUND(0.125, 2) half up


def test_staged_tables_over_jdbc_to_long(spark, derby):
    """Existing per-point staging tables (unique_id, timestamp, <value>) -> long form."""
    from canopy.sources.telemetry import staged_tables_to_long, value_column
    url, props = derby
    t0 = dt.datetime(2024, 1, 1)
    for name, col, n in (("STG_A_TEMP", "temp", 3), ("STG_B_RH", "rh", 2)):
        df = spark.createDataFrame([(i + 1, t0 + dt.timedelta(hours=i), float(i)) for i in range(n)],
                                   f"unique_id long, timestamp timestamp, {col} double")
        (df.write.format("jdbc").option("url", url).option("dbtable", name)
         .option("driver", props["driver"]).mode("overwrite").save())
    frames = {t: spark.read.format("jdbc").option("url", url).option("dbtable", t)
              .option("driver", props["driver"]).load() for t in ("STG_A_TEMP", "STG_B_RH")}
    frames["EMPTY_ONE"] = spark.createDataFrame([], "unique_id long, timestamp timestamp")
    long, skipped = staged_tables_to_long(frames)
    assert skipped == ["EMPTY_ONE"]
    got = sorted((r.point, r.unique_id) for r in long.collect())
    assert got == [("stg_a_temp", 1), ("stg_a_temp", 2), ("stg_a_temp", 3),
                   ("stg_b_rh", 1), ("stg_b_rh", 2)]
    assert value_column(["UNIQUE_ID", "TimeStamp", "x", "y"]) == "x"
    assert value_column(["unique_id", "timestamp"]) is None


def test_bad_tables_are_left_out_and_named(spark, derby):
    url, props = derby
    failed = {}
    src = jdbc_source(spark, url, ["SX_AIR_TEMP", "NO_SUCH_TABLE"], properties=props, failures=failed)
    assert src.select("point").distinct().count() == 1
    assert list(failed) == ["NO_SUCH_TABLE"] and failed["NO_SUCH_TABLE"]
    with pytest.raises(Exception):
        jdbc_source(spark, url, ["NO_SUCH_TABLE"], properties=props)
    failed = {}
    jdbc_source(spark, url, ["SX_AIR_TEMP"], value_col="reading", properties=props, failures=failed)
    assert "reading" in failed["SX_AIR_TEMP"]


def test_each_table_has_its_own_lower_bound(spark, derby):
    url, props = derby
    src = jdbc_source(spark, url, ["SX_AIR_TEMP", "SX_SOIL_1"], properties=props,
                      starts={"sx_air_temp": dt.datetime(2024, 1, 2)})
    got = {r.point: r.n for r in src.groupBy("point").agg(F.count("*").alias("n")).collect()}
    assert got == {"SX_AIR_TEMP": 15, "SX_SOIL_1": 25}
    assert any("GreaterThan(" in p for p in plan_summary(src)["pushed_filters"])
