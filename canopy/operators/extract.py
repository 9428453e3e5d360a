"""Incremental extract and staging of all points in one keyed job.

For every manifest point (the original loops over tables; we key by point):

* lower bound (strict): ``max(ts) + buffer`` of what is staged for the point,
  else -- first run, nothing staged -- midnight of ``as_of - 30 days``;
* upper bound (strict): midnight after ``as_of``;
* readings rounded to 2 decimals (decimal rounding);
* numbered 1..n per point by time (total order: ts, then tie-break columns,
  then value and every other source column) continuing from the point's durable counter
  ``greatest(metadata.last_used_id, max(staged unique_id))``, else 0;
* the state row of every manifest point is rewritten each run (also with no
  new rows): ``last_run_date, last_run_timestamp, last_used_id + n``;
* retention: rows of the run's points older than midnight of
  ``as_of - 30 days`` are purged after the append (rows appended in the same
  run can be purged at once and still consume ids).

Rows at or before ``max(ts) + buffer`` are never read again (late data is
dropped, as in the original); :func:`late_rows` audits them.

Plan: the per-point control table (manifest x high-water mark x state) has one
row per manifest point. It is written once; its row count is checked before it
is broadcast, and the least of its lower bounds, together with the upper bound,
is a literal range that reaches the source's scan, so a run reads what is new
and not the history. The rows are then joined to the control row of their
point, cut by the point's own bound and numbered by ``assign_sequence``. With
``batch_path`` the un-numbered batch is written there first, so a source that
is still being written to is read once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.names import normalise_point
from ..functions.temporal import (lookback_start, plus_seconds, retention_cutoff, round_reading,
                                  run_end, ts_literal)
from ..plans.joins import join_small
from ..session import written
from .sequence import assign_sequence
from .state import Retention, apply_retention, upsert_state

STAGED_COLUMNS = ["point", "unique_id", "ts", "value"]


@dataclass
class ExtractResult:
    new_rows: DataFrame        # point, unique_id, ts, value  (this run's batch)
    batch_state: DataFrame     # one state row per manifest point
    state: DataFrame           # state after the upsert
    staged: DataFrame          # staged rows after append + retention
    purged: DataFrame          # point, purged_rows
    control: DataFrame         # point, start, base_id (for inspection)


def manifest_points(points: DataFrame) -> DataFrame:
    """Distinct normalised point names of a manifest frame."""
    return points.select(normalise_point("point").alias("point")).distinct()


def control_table(points: DataFrame, as_of: dt.date, staged: DataFrame | None,
                  state: DataFrame | None,
                  buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS,
                  window_days: int = config.ROLLING_WINDOW_DAYS,
                  ts_type: T.DataType = T.TimestampType(),
                  marks: DataFrame | None = None) -> DataFrame:
    """``point, start, base_id`` for every manifest point.  ``marks``
    (``point, _hwm, _max_id``) replaces the aggregation over ``staged``."""
    ctl = points
    if marks is not None:
        ctl = ctl.join(marks.select("point", "_hwm", "_max_id"), "point", "left")
    elif staged is not None:
        marks = staged.groupBy("point").agg(F.max("ts").alias("_hwm"),
                                            F.max("unique_id").alias("_max_id"))
        ctl = ctl.join(marks, "point", "left")
    else:
        ctl = (ctl.withColumn("_hwm", F.lit(None).cast(ts_type))
               .withColumn("_max_id", F.lit(None).cast("long")))
    if state is not None:
        ctl = ctl.join(state.select("point", F.col("last_used_id").alias("_state_id")),
                       "point", "left")
    else:
        ctl = ctl.withColumn("_state_id", F.lit(None).cast("long"))
    first_run = ts_literal(lookback_start(as_of, window_days), ts_type)
    return ctl.select(
        "point",
        F.coalesce(plus_seconds(F.col("_hwm").cast(ts_type), buffer_seconds),
                   first_run).alias("start"),
        F.coalesce(F.greatest("_state_id", "_max_id"), F.lit(0)).cast("long").alias("base_id"))


def extract_and_stage(source: DataFrame, points: DataFrame, as_of: dt.date,
                      staged: DataFrame | None = None, state: DataFrame | None = None,
                      run_ts: dt.datetime | None = None, tiebreak=None,
                      buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS,
                      window_days: int = config.ROLLING_WINDOW_DAYS,
                      points_rows: int | None = None,
                      max_rows_per_task: int | None = None,
                      marks: DataFrame | None = None, batch_path: str | None = None) -> ExtractResult:
    """One incremental run over all manifest points.

    ``source``: long source ``(point, ts, value, *tiebreak)`` (JDBC / Parquet).
    ``points``: manifest frame with a ``point`` column (already restricted,
    e.g. by biome).  ``staged`` / ``state``: what earlier runs left (``None``
    on the first run).  ``points_rows``: number of manifest points if known
    (counted here otherwise -- the manifest is small) for the broadcast check.
    ``marks``: per-point ``point, _hwm, _max_id`` known without scanning
    ``staged`` (see ``plans.runner``); then ``staged`` may be ``None``.
    ``batch_path``: where the un-numbered batch is written first.
    ``tiebreak``: columns that order readings of one time first; value and all
    other source columns follow, so ids never depend on the order of the input.
    """
    ts_type = source.schema["ts"].dataType
    run_ts = run_ts or dt.datetime.combine(as_of, dt.time(0, 0))
    pts = manifest_points(points)
    ctl = written(control_table(pts, as_of, staged, state, buffer_seconds, window_days, ts_type, marks), "control")
    least, points_rows = ctl.agg(F.min("start").cast("string"), F.count(F.lit(1))).first()

    end = ts_literal(run_end(as_of), ts_type)
    since = F.lit(least).cast(ts_type)                      # null (no rows) without points
    src = (source.filter((F.col("ts") > since) & (F.col("ts") < end))   # pushed to the scan
           .withColumn("point", normalise_point("point")))
    new = (join_small(src, ctl, "point", "inner", points_rows)  # manifest restriction
           .filter(F.col("ts") > F.col("start"))
           .withColumn("value", round_reading("value")))
    if batch_path is not None:
        new.write.mode("overwrite").parquet(batch_path)
        new = source.sparkSession.read.schema(new.schema).parquet(batch_path)
    order = total_order(new, tiebreak, ctl.columns)
    numbered = assign_sequence(new, "point", "ts", order, base="base_id",
                               max_rows_per_task=max_rows_per_task)
    new_rows = numbered.select(*STAGED_COLUMNS)

    batch_state = make_batch_state(ctl, new, as_of, run_ts)
    state_out = upsert_state(state, batch_state)

    appended = new_rows if staged is None else staged.select(*STAGED_COLUMNS).unionByName(new_rows)
    ret: Retention = apply_retention(appended, as_of, window_days, pts, points_rows)
    return ExtractResult(new_rows, batch_state, state_out, ret.kept, ret.purged, ctl)


def total_order(rows: DataFrame, tiebreak, without) -> list[str]:
    """``tiebreak``, then ``value``, then every other column that can be
    ordered (by name, so that the order of columns does not matter either)."""
    first = [*(tiebreak or ()), "value"]
    rest = sorted(f.name for f in rows.schema.fields
                  if f.name not in {*first, *without, "ts"} and _orderable(f.dataType))
    return list(dict.fromkeys([*first, *rest]))


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def make_batch_state(ctl: DataFrame, batch_rows: DataFrame, as_of: dt.date,
                     run_ts: dt.datetime) -> DataFrame:
    """One state row per manifest point (also without new rows):
    ``last_used_id = base_id + rows of the batch``.  ``batch_rows`` is the
    batch (or the batch as written back), counted per point with a partial
    aggregate."""
    counts = batch_rows.groupBy("point").agg(F.count(F.lit(1)).alias("_n"))
    return (ctl.join(counts, "point", "left")
            .select("point",
                    F.lit(as_of).cast(T.DateType()).alias("last_run_date"),
                    F.lit(run_ts.isoformat(sep=" ")).cast(T.TimestampNTZType())
                    .alias("last_run_timestamp"),
                    (F.col("base_id") + F.coalesce("_n", F.lit(0))).cast("long")
                    .alias("last_used_id")))


def late_rows(source: DataFrame, staged: DataFrame, points: DataFrame, first_as_of: dt.date,
              last_as_of: dt.date, window_days: int = config.ROLLING_WINDOW_DAYS,
              points_rows: int | None = None) -> DataFrame:
    """Audit of dropped late data: per point, source rows inside the window that
    was pulled and is still retained (after the first run's lookback, not before
    the last run's retention cutoff, before the end of its day) that staging
    does not hold. Rows of one time are compared by their number, so a late row
    that shares its time with a staged one is seen."""
    ts_type = source.schema["ts"].dataType
    lo = ts_literal(lookback_start(first_as_of, window_days), ts_type)
    kept = ts_literal(retention_cutoff(last_as_of, window_days), ts_type)
    hi = ts_literal(run_end(last_as_of), ts_type)
    pts = manifest_points(points)
    src = join_small(source.filter((F.col("ts") > lo) & (F.col("ts") >= kept) & (F.col("ts") < hi))
                     .withColumn("point", normalise_point("point")),
                     pts, "point", "left_semi", points_rows)
    sides = (src.select("point", "ts", F.lit(1).alias("n"))
             .unionByName(staged.filter(F.col("ts") >= kept).select("point", "ts", F.lit(-1).alias("n"))))
    missing = sides.groupBy("point", "ts").agg(F.sum("n").alias("n")).filter("n > 0")
    return missing.groupBy("point").agg(F.sum("n").alias("late_rows"),
                                        F.min("ts").alias("first_late_ts"),
                                        F.max("ts").alias("last_late_ts"))
