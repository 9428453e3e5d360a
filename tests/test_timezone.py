"""Results must not depend on the session time zone: NTZ readings inside a
DST gap keep their wall-clock value and their order."""
import datetime as dt

from canopy.operators.sequence import assign_sequence
from canopy.operators.wide import pivot_points

STAGED = "point string, unique_id long, ts timestamp_ntz, value double"


def test_dst_gap_roundtrip_and_order(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        base = dt.datetime(2024, 3, 10, 1, 50)
        stamps = [base + dt.timedelta(minutes=10 * i) for i in range(12)]   # crosses 02:00-03:00
        rows = [("p", None, t, float(i)) for i, t in enumerate(stamps)]
        df = spark.createDataFrame(rows, STAGED).drop("unique_id")
        for limit in (None, 3):
            got = sorted((r.unique_id, r.ts) for r in
                         assign_sequence(df, "point", "ts", max_rows_per_task=limit).collect())
            assert [t for _, t in got] == stamps
        st = assign_sequence(df, "point", "ts")
        w = pivot_points(st.select("point", "unique_id", "ts", "value"), ["p"], ["p"], "ragged")
        assert sorted(r["timestamp_p"] for r in w.collect()) == stamps
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
