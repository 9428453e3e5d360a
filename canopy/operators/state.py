"""Per-point run state: high-water marks, last ids, metadata upsert and the
rolling retention window -- all keyed operations over the long table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.temporal import plus_seconds, retention_cutoff, ts_literal
from ..plans.joins import join_small

STATE_SCHEMA = T.StructType([
    T.StructField("point", T.StringType(), False),
    T.StructField("last_run_date", T.DateType(), True),
    T.StructField("last_run_timestamp", T.TimestampNTZType(), True),
    T.StructField("last_used_id", T.LongType(), True),
])


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def high_water_marks(staged: DataFrame,
                     buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS) -> DataFrame:
    """``point, hwm = max(ts), next_start = hwm + buffer`` (partial aggregate:
    a hot point costs one row per task in the shuffle)."""
    return (staged.groupBy("point").agg(F.max("ts").alias("hwm"))
            .withColumn("next_start", plus_seconds("hwm", buffer_seconds)))


def last_ids(staged: DataFrame | None, state: DataFrame | None, points: DataFrame) -> DataFrame:
    """Durable counter per point: ``greatest(state.last_used_id,
    max(unique_id))``, else 0 -- so committed ids are never reused, even when
    the metadata is missing or lags the data."""
    out = points.select("point").distinct()
    if staged is not None:
        out = out.join(staged.groupBy("point").agg(F.max("unique_id").alias("max_unique_id")),
                       "point", "left")
    else:
        out = out.withColumn("max_unique_id", F.lit(None).cast("long"))
    if state is not None:
        out = out.join(state.select("point", F.col("last_used_id").alias("state_last_used_id")),
                       "point", "left")
    else:
        out = out.withColumn("state_last_used_id", F.lit(None).cast("long"))
    return out.withColumn(
        "last_used_id",
        F.coalesce(F.greatest("state_last_used_id", "max_unique_id"), F.lit(0)).cast("long"))


def upsert_state(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Insert-or-replace by ``point``: the new rows plus the old rows whose
    point is not in the new batch (anti join; no MERGE needed)."""
    new = new.select(*[c.name for c in STATE_SCHEMA.fields])
    if old is None:
        return new
    kept = old.select(*new.columns).join(new.select("point"), "point", "left_anti")
    return new.unionByName(kept)


@dataclass
class Retention:
    kept: DataFrame
    purged: DataFrame  # point, purged_rows


def apply_retention(staged: DataFrame, as_of: dt.date,
                    days: int = config.ROLLING_WINDOW_DAYS,
                    points: DataFrame | None = None, points_rows: int | None = None) -> Retention:
    """Rows with ``ts < midnight(as_of - days)`` are removed (strict: a row
    exactly at the cutoff stays).  With ``points`` only those points are
    purged (the run's manifest); others are left as they are."""
    cutoff = ts_literal(retention_cutoff(as_of, days), staged.schema["ts"].dataType)
    old = F.col("ts") < cutoff
    if points is not None:
        marked = join_small(staged, points.select("point").distinct()
                            .withColumn("_in_run", F.lit(True)),
                            "point", "left", points_rows)
        doomed = F.coalesce(F.col("_in_run"), F.lit(False)) & old
        kept = marked.filter(~doomed).drop("_in_run")
        purged = (marked.filter(F.col("_in_run")).groupBy("point")
                  .agg(F.count_if(old).alias("purged_rows")))
    else:
        kept = staged.filter(~old)
        purged = staged.groupBy("point").agg(F.count_if(old).alias("purged_rows"))
    return Retention(kept, purged)


def state_from_staged(staged: DataFrame) -> DataFrame:
    """Deterministic run state derived from the data: the run happened at the
    point's newest reading."""
    return (staged.groupBy("point")
            .agg(F.max("ts").alias("_m"), F.max("unique_id").alias("last_used_id"))
            .select("point", F.to_date("_m").alias("last_run_date"),
                    F.col("_m").cast(T.TimestampNTZType()).alias("last_run_timestamp"),
                    "last_used_id"))
