"""Statistics that are kept, not recomputed: mergeable partial aggregates per
point and day.

A run adds the partials of its own rows (one map-side combined aggregate over
what it has just written); merging is another aggregate over rows of the same
form, so counts, bounds, distinct ids and exact averages of any span of whole
days come from ``points x days`` rows, however many readings there are. The
purge removes whole days of a point, so taking it off means leaving out the
days before the point's ``retained_from``.

Sums are exact: staged readings have two decimals, so a decimal sum of them
has no rounding and does not depend on the order of merging. Readings beyond
that (NaN, infinities, numbers over the decimal's range) are summed apart as
doubles and show in the average as they would in a plain one.

Ids are unique per point, so the distinct ids of a span are its row count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Decimal of the exact sums; two places, as readings are rounded to.
EXACT = "decimal(38,2)"


def day_partials(staged: DataFrame) -> DataFrame:
    """``point, day`` with counts, bounds and sums of ``staged`` rows."""
    value = F.col("value")
    exact = F.expr(f"try_cast(value AS {EXACT})")
    return (staged.withColumn("_exact", exact).groupBy("point", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("value_count"),
        F.min(value).alias("value_min"), F.max(value).alias("value_max"),
        F.sum("_exact").cast(EXACT).alias("value_sum"),
        F.sum(F.when(F.col("_exact").isNull(), value)).alias("odd_sum"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.min("unique_id").alias("first_id"), F.max("unique_id").alias("last_id")))


_MERGE = {"rows": F.sum, "value_count": F.sum, "value_min": F.min, "value_max": F.max, "value_sum": F.sum,
          "odd_sum": F.sum, "first_ts": F.min, "last_ts": F.max, "first_id": F.min, "last_id": F.max}


def merged(partials: DataFrame, *keys: str) -> DataFrame:
    """Partials of equal ``keys`` folded into one row."""
    sums = [how(c).cast(partials.schema[c].dataType).alias(c) for c, how in _MERGE.items()]
    return partials.groupBy(*keys).agg(*sums)


def folded(parts: list[DataFrame], marks: DataFrame | None) -> DataFrame:
    """The next snapshot: all parts per point and day, without the days that
    were purged for their point."""
    whole = merged(reduce(DataFrame.unionByName, parts), "point", "day")
    return whole if marks is None else retained(whole, marks)


def retained(partials: DataFrame, marks: DataFrame) -> DataFrame:
    """Whole days before a point's ``retained_from`` are left out."""
    since = marks.select("point", F.to_date("retained_from").alias("_since"))
    return (partials.join(since, "point", "left")
            .filter(F.col("_since").isNull() | (F.col("day") >= F.col("_since"))).drop("_since"))


def value_stats(partials: DataFrame) -> DataFrame:
    """Per point ``point, min_value, max_value, avg_value, non_null_count``."""
    one = merged(partials, "point")
    total = F.coalesce(F.col("value_sum").cast("double"), F.lit(0.0)) + F.coalesce("odd_sum", F.lit(0.0))
    return one.select("point", F.col("value_min").alias("min_value"), F.col("value_max").alias("max_value"),
                      F.when(F.col("value_count") > 0, total / F.col("value_count")).alias("avg_value"),
                      F.col("value_count").alias("non_null_count"))


def time_stats(partials: DataFrame) -> DataFrame:
    """Per point ``point, start_time, end_time, total_records, unique_days,
    unique_ids_count, first_id, last_id``."""
    days = partials.filter("rows > 0").groupBy("point").agg(F.count("day").alias("unique_days"))
    one = merged(partials, "point").select(
        "point", F.col("first_ts").alias("start_time"), F.col("last_ts").alias("end_time"),
        F.col("rows").alias("total_records"), F.col("rows").alias("unique_ids_count"), "first_id", "last_id")
    return one.join(days, "point")


def inventory(partials: DataFrame) -> DataFrame:
    """``table_name, row_count`` of the staged points."""
    return partials.groupBy(F.col("point").alias("table_name")).agg(F.sum("rows").alias("row_count"))
