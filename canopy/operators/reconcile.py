"""Late-row audit by a reconciliation tree.

Source and staging are each summed up once into *leaves*: per point and hour
the number of readings and an order-free sum of the hashes of their times. The
leaves are small tables; rolled up they give the same pair per day and per
point. Equal pairs mean equal times, so both sides are compared from the top:
points that differ, of those the days that differ, of those the hours. Only
the readings of hours that differ are looked at again, and they alone are
grouped by time. (Two different hours pass as equal with the chance that two
sums of 64-bit hashes agree.)
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.names import normalise_point
from ..functions.temporal import from_micros, lookback_start, retention_cutoff, run_end, to_micros, ts_literal
from ..plans.joins import join_small
from ..session import written
from .extract import manifest_points

LEVELS = (["point"], ["point", "day"], ["point", "day", "hour"])
HOUR = 3_600_000_000   # microseconds


@dataclass
class Audit:
    late: DataFrame        # point, late_rows, first_late_ts, last_late_ts
    hours: DataFrame       # point, day, hour (since 1970): the leaves that differ
    source: DataFrame      # readings of those hours, as read again
    staged: DataFrame


def _hour(ts_type) -> Column:
    """The whole hours of a time since 1970; plain arithmetic, so that no
    session time zone moves a time to another hour."""
    m = to_micros("ts", ts_type)
    return ((m - F.pmod(m, F.lit(HOUR))) / F.lit(HOUR)).cast("long")


def leaves(rows: DataFrame) -> DataFrame:
    """``point, day, hour, n, h`` (partially aggregated before the shuffle)."""
    ts_type = rows.schema["ts"].dataType
    h = F.xxhash64(to_micros("ts", ts_type)).cast("decimal(38,0)")
    hour = _hour(ts_type)
    return rows.groupBy("point", F.floor(hour / F.lit(24)).alias("day"), hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h).alias("h"))


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """``point, day, hour`` of the leaves that differ, level by level."""
    # one side counts up and the other down: what is equal sums to nothing
    both = a.unionByName(b.withColumns({"n": -F.col("n"), "h": -F.col("h")}))
    for keys in LEVELS:
        open_ = both.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("h").alias("h")).filter("n <> 0 OR h <> 0")
        both = both.join(open_.select(*keys), keys, "left_semi")
    return both.select("point", "day", "hour").distinct()


def audit_late_rows(source: DataFrame, staged: DataFrame, points: DataFrame, first_as_of: dt.date,
                    last_as_of: dt.date, window_days: int = config.ROLLING_WINDOW_DAYS,
                    points_rows: int | None = None) -> Audit:
    """As ``extract.late_rows``: per point the source rows of the pulled and
    still retained window that staging does not hold."""
    ts_type = source.schema["ts"].dataType
    lo = ts_literal(lookback_start(first_as_of, window_days), ts_type)
    kept = ts_literal(retention_cutoff(last_as_of, window_days), ts_type)
    hi = ts_literal(run_end(last_as_of), ts_type)
    pts = manifest_points(points)
    src = join_small(source.filter((F.col("ts") > lo) & (F.col("ts") >= kept) & (F.col("ts") < hi))
                     .withColumn("point", normalise_point("point")), pts, "point", "left_semi", points_rows)
    own = staged.filter(F.col("ts") >= kept)
    hours = written(differing(written(leaves(src), "leaves"), written(leaves(own), "leaves")), "differing-hours")
    count, first, last = hours.agg(F.count(F.lit(1)), F.min("hour"), F.max("hour")).first()

    def below(side: DataFrame) -> DataFrame:
        """The readings of the hours that differ: their span is pushed to the scan."""
        if not count:
            return side.select("point", "ts").filter(F.lit(False))
        begin, end = (from_micros(F.lit(h * HOUR), ts_type) for h in (first, last + 1))
        span = (F.col("ts") >= begin) & (F.col("ts") < end)
        keyed = side.filter(span).select("point", "ts", _hour(ts_type).alias("hour"))
        return join_small(keyed, hours.select("point", "hour"), ["point", "hour"], "left_semi", count)

    again, mine = below(src), below(own)
    sides = again.select("point", "ts", F.lit(1).alias("n")).unionByName(mine.select("point", "ts", F.lit(-1).alias("n")))
    missing = sides.groupBy("point", "ts").agg(F.sum("n").alias("n")).filter("n > 0")
    late = missing.groupBy("point").agg(F.sum("n").alias("late_rows"), F.min("ts").alias("first_late_ts"),
                                        F.max("ts").alias("last_late_ts"))
    return Audit(late, hours, again, mine)
