import pytest
from pyspark.sql import functions as F

from canopy.functions.names import normalise_point, value_column_name
from canopy.functions.temporal import round_reading
from canopy.operators.wide import resolve_names

CASES = [
    ("A_B_TEMP", "temp"), ("A_TEMP_1", "temp_1"), ("X_AHUR_2-b", "ahur_2_b"),
    ("Z_xAhur_T_1", "ahur_t_1"), ("NOSEP", "nosep"), ("B_7", "b_7"), ("ahur", "ahur"),
    ("A_", "a_"), ("7", "7"), ("a-b c.d", "a_b_c_d"), ("SX_CO2_PPM", "ppm"),
]


def test_value_column_name(spark):
    df = spark.createDataFrame([(a,) for a, _ in CASES], "p string")
    got = {r["p"]: r["n"] for r in df.select("p", value_column_name("p").alias("n")).collect()}
    assert got == dict(CASES)


def test_null_name(spark):
    df = spark.createDataFrame([(None,)], "p string")
    assert df.select(value_column_name("p").alias("n")).first()["n"] is None


def test_normalise_point(spark):
    df = spark.createDataFrame([("  SX_Temp_1 \t",)], "p string")
    assert df.select(normalise_point("p").alias("n")).first()["n"] == "sx_temp_1"


def test_round_reading_decimal_semantics(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (None,)], "v double")
    got = [r[0] for r in df.select(round_reading("v")).collect()]
    assert got == [1.01, 2.68, -1.01, None]


@pytest.mark.parametrize("kind", ["aligned", "ragged"])
def test_collisions_keep_every_point(kind):
    pts = ["a_temp", "b_temp", "c_rh", "d_temp", "e_temp"]
    names = resolve_names(pts, ["temp", "temp", "rh", "temp", "temp"], kind)
    assert len(set(names)) == 5
    assert names[2] == "rh"
    assert names[0] == "temp__a_temp" and names[4] == "temp__e_temp"


def test_reserved_names_are_renamed():
    names = resolve_names(["x_timestamp", "y_unique_id"], ["timestamp", "unique_id"], "aligned")
    assert names == ["timestamp__x_timestamp", "unique_id__y_unique_id"]


@pytest.mark.parametrize("value, rounded", [(2e12, 2e12), (0.0049999996, 0.0), (0.285, 0.29), (-0.125, -0.13),
                                            (1.005, 1.01), (123456789012345.675, 123456789012345.67), (1e300, 1e300),
                                            (float("inf"), float("inf")), (None, None)])
def test_rounding_of_any_double(spark, value, rounded):
    """Half up on the shortest decimal digits (123456789012345.675 reads ...45.67)."""
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(round_reading("v").alias("r")).first()["r"] == rounded
