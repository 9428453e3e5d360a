"""Phase runner: extract (+ stage, state, retention), then transform (wide
tables, CSV export), against the stores of one root folder.

Write order per extract run: the batch's rows first, then the state computed
from the rows as written, then the high-water marks, the kept statistics and
the log of changed ids, then the retention drop -- so a failure in between never lets a later run reuse committed ids (the
durable counter also takes ``max(unique_id)`` of the data into account), and
a later run reads the rows of a run whose marks are missing.  High-water
marks come from the marks snapshot, not from a scan of the staged table, so
the cost of a run follows its new rows, not the retained window.  Every run has an id; a replayed
run (same id) reads only what earlier runs wrote and rewrites its own output,
giving the same ids.

``dry_run`` builds the plans without executing them and returns their
formatted explanation.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.names import normalise_point
from ..functions.temporal import retention_cutoff, ts_literal
from ..operators.extract import (control_table, extract_and_stage, make_batch_state,
                                 manifest_points)
from ..operators.partials import day_partials, folded
from ..operators.state import upsert_state
from ..operators.query import timestamp_column
from ..operators.wide import build_wide
from ..sources.store import (ChangeLog, MarksStore, PartialsStore, PendingStore, RunIds, StagedStore,
                             StateStore, WideStore)
from ..sources.wide_blocks import BlockedWide, id_ranges
from ..session import written as stored
from .inspect import explain_text


@dataclass
class Stores:
    staged: StagedStore
    state: StateStore
    wide: WideStore
    marks: MarksStore
    ids: RunIds
    pending: PendingStore
    partials: PartialsStore
    changes: ChangeLog
    blocks: BlockedWide


def open_stores(spark: SparkSession, root: str) -> Stores:
    return Stores(StagedStore(spark, root), StateStore(spark, root), WideStore(spark, root),
                  MarksStore(spark, root), RunIds(spark, root), PendingStore(spark, root),
                  PartialsStore(spark, root), ChangeLog(spark, root), BlockedWide(spark, root))


def point_starts(stores: Stores, points: DataFrame, as_of: dt.date, run_id: int,
                 buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS,
                 window_days: int = config.ROLLING_WINDOW_DAYS) -> dict[str, dt.datetime]:
    """The lower bound of every manifest point, for sources that are read point
    by point (``jdbc_source(starts=...)``); manifest-sized."""
    marks = _start_marks(stores, run_id)
    staged = stores.staged.read(before_run=run_id) if marks is None else None
    ctl = control_table(manifest_points(points), as_of, staged, stores.state.read(before_run=run_id),
                        buffer_seconds, window_days, marks=marks)
    return {r["point"]: r["start"] for r in ctl.select("point", "start").collect()}


def _start_marks(stores: Stores, run_id: int):
    """Per-point ``point, _hwm, _max_id`` of the staged rows before ``run_id``
    without scanning the whole staged table: the last marks snapshot (valid
    while ``last_ts >= retained_from``) combined with the rows of any later
    runs that never wrote marks (a crash between data and marks).  ``None``
    when no snapshot exists yet -- then the staged table is aggregated."""
    prev, version = stores.marks.latest(run_id)
    if prev is None:
        return None
    m = prev.select("point",
                    F.when(F.col("retained_from").isNull()
                           | (F.col("last_ts") >= F.col("retained_from")), F.col("last_ts"))
                    .alias("_hwm"),
                    F.lit(None).cast("long").alias("_max_id"))
    recent = stores.staged.read_runs_between(version, run_id)
    if recent is not None:
        m = m.unionByName(recent.groupBy("point").agg(
            F.max("ts").cast(prev.schema["last_ts"].dataType).alias("_hwm"),
            F.max("unique_id").alias("_max_id")))
    return m.groupBy("point").agg(F.max("_hwm").alias("_hwm"), F.max("_max_id").alias("_max_id"))


def run_extract(spark: SparkSession, source: DataFrame, points: DataFrame, stores: Stores,
                as_of: dt.date, run_id: int, run_ts: dt.datetime | None = None, tiebreak=None,
                buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS,
                window_days: int = config.ROLLING_WINDOW_DAYS,
                max_rows_per_task: int | None = None, dry_run: bool = False,
                failed: dict[str, str] | DataFrame | None = None, writer: str = "batch"):
    """One extract run; returns a per-point status frame
    ``point, new_rows, last_used_id, error`` (or the plan text when
    ``dry_run``). ``failed`` names the points whose source could not be read
    with the reason (``jdbc_source(failures=...)``, or the errors frame of
    ``point_scan.scan_points``). Such a point brings no rows, also none that
    were read before it failed, and is neither purged nor marked, but its state
    row is written as for a point without news."""
    run_ts = run_ts or dt.datetime.combine(as_of, dt.time(0, 0))
    if isinstance(failed, DataFrame):
        bad = failed.select(normalise_point("point").alias("point"), "error")
    else:
        bad = spark.createDataFrame(list((failed or {}).items()), "point string, error string").select(
            normalise_point("point").alias("point"), "error")
    healthy = points
    if failed is not None:
        bad = bad.groupBy("point").agg(F.min("error").alias("error"))
        if not dry_run:
            bad = stored(bad, "failed-points")
        healthy = manifest_points(points).join(bad, "point", "left_anti")
        source = source.withColumn("point", normalise_point("point")).join(bad.select("point"), "point", "left_anti")
    if not dry_run and writer == "batch":
        stores.ids.claim(writer, str(run_id), run_id)
    state = stores.state.read(before_run=run_id)
    marks = _start_marks(stores, run_id)
    staged = stores.staged.read(before_run=run_id) if marks is None else None
    if marks is None and staged is not None:
        marks = staged.groupBy("point").agg(F.max("ts").alias("_hwm"),
                                            F.max("unique_id").alias("_max_id"))
    res = extract_and_stage(source, points, as_of, None, state, run_ts, tiebreak,
                            buffer_seconds, window_days, max_rows_per_task=max_rows_per_task,
                            marks=marks,
                            batch_path=None if dry_run else (batch := stores.staged.scratch("batch")))
    if dry_run:
        return explain_text(res.new_rows)
    stores.staged.write_run(res.new_rows, run_id)                     # 1. data
    written = (stores.staged.read_run(run_id) if run_id in stores.staged.runs()
               else res.new_rows.limit(0))                          # the run added nothing
    batch_state = make_batch_state(res.control, written, as_of, run_ts)
    stores.state.write(upsert_state(state, batch_state), run_id)      # 2. state
    cutoff = retention_cutoff(as_of, window_days)
    pts = manifest_points(healthy)
    _write_marks(stores, marks, written, cutoff, run_id, pts)         # 3. marks
    _write_partials(stores, written, run_id)                          # 4. kept statistics, changed ids
    _write_changes(stores, written, cutoff, run_id, pts)
    counts = written.groupBy("point").agg(F.count(F.lit(1)).alias("new_rows"))
    status = stored(batch_state.join(counts, "point", "left").join(bad, "point", "left")
                    .select("point", F.coalesce("new_rows", F.lit(0)).alias("new_rows"), "last_used_id", "error"),
                    "status")
    stores.staged.purge_before(cutoff.date(), pts)                    # 5. retention (run's healthy points only)
    stores.staged.fs.delete(batch)
    return status


def _write_marks(stores: Stores, marks, written: DataFrame, cutoff: dt.datetime,
                 run_id: int, pts: DataFrame) -> None:
    """New snapshot: ``last_ts`` = newest reading ever staged per point (the
    previous marks and this run's rows); ``retained_from`` = the retention
    cutoff honoured for the point -- raised to this run's cutoff for the
    run's manifest points (the ones it purges), kept for the others."""
    ts_type = written.schema["ts"].dataType
    prev, _ = stores.marks.latest(run_id)
    null_ts = F.lit(None).cast(ts_type)
    parts = [written.groupBy("point").agg(F.max("ts").alias("last_ts"))
             .withColumn("retained_from", null_ts)]
    if marks is not None:
        parts.append(marks.select("point", F.col("_hwm").cast(ts_type).alias("last_ts"),
                                  null_ts.alias("retained_from")))
    if prev is not None:
        parts.append(prev.select("point", F.col("last_ts").cast(ts_type),
                                 F.col("retained_from").cast(ts_type)))
    last = parts[0]
    for p in parts[1:]:
        last = last.unionByName(p)
    snap = last.groupBy("point").agg(F.max("last_ts").alias("last_ts"),
                                     F.max("retained_from").alias("retained_from"))
    in_run = pts.select("point").distinct().withColumn("_in_run", F.lit(True))
    snap = (snap.join(in_run, "point", "left")
            .withColumn("retained_from",
                        F.when(F.col("_in_run"),
                               F.greatest("retained_from", ts_literal(cutoff, ts_type)))
                        .otherwise(F.col("retained_from")))
            .drop("_in_run"))
    stores.marks.write(snap, run_id)


def _write_partials(stores: Stores, written: DataFrame, run_id: int) -> None:
    """The snapshot before, folded with this run's rows and those of runs whose
    snapshot is missing (a crash), without the days that are purged by now."""
    prev, version = stores.partials.latest(run_id)
    parts = [day_partials(written)]
    if prev is not None:
        parts.append(prev)
    missed = (stores.staged.read(before_run=run_id) if version is None
              else stores.staged.read_runs_between(version, run_id))
    if missed is not None:
        parts.append(day_partials(missed))
    marks, _ = stores.marks.latest()
    stores.partials.write(folded(parts, marks), run_id)


def _write_changes(stores: Stores, written: DataFrame, cutoff: dt.datetime, run_id: int, pts: DataFrame) -> None:
    """The ids that this run added and those that its purge is about to take:
    one range per point each, as ids follow time. Only days to be purged are
    read, and runs before this one that broke off without a log."""
    ranges = id_ranges(written)
    _, version = stores.changes.latest(run_id)
    missed = None if version is None else stores.staged.read_runs_between(version, run_id)
    if missed is not None:
        ranges = ranges.unionByName(id_ranges(missed))
    old = stores.staged.read(before_day=cutoff.date())
    if old is not None:
        ranges = ranges.unionByName(id_ranges(old.join(pts.select("point"), "point", "left_semi")))
    stores.changes.write(ranges, run_id)


def run_transform(spark: SparkSession, stores: Stores, manifest: DataFrame, run_id: int,
                  categories=None, export_root: str | None = None,
                  when: dt.datetime | None = None, dry_run: bool = False):
    """Build and store the wide table of every category; returns a status
    frame ``category, table_name, rows_written, skipped_points``. A manifest
    point that never staged a reading is skipped and listed; one whose rows
    were all purged is resolved, and empty."""
    telemetry = stores.staged.read()
    # known: points that ever staged a reading (also if all were purged since)
    marks, _ = stores.marks.latest()
    rows = []
    plans = {}
    for cat in categories or config.CATEGORIES:
        name = config.wide_table_name(cat)
        if telemetry is None:
            rows.append((cat, name, 0, ""))
            continue
        known = None if marks is None else marks.filter("last_ts IS NOT NULL").select("point")
        w = build_wide(telemetry, manifest, cat, known_points=known)
        if dry_run:
            plans[cat] = None if w is None else explain_text(w.df)
            continue
        out = None
        if w is not None:
            # rows sorted by the page/filter time column inside each file (no
            # shuffle): row-group min/max statistics then let date filters skip
            tcol = timestamp_column(w.df.columns, cat)
            out = w.df.sortWithinPartitions(F.col(f"`{tcol}`"), "unique_id")
        n = stores.wide.replace(name, out, run_id)
        if n and export_root:
            stores.wide.export_csv(name, export_root, when or dt.datetime.now())
        rows.append((cat, name, n, ",".join(w.skipped) if w else ""))
    if dry_run:
        return plans
    return spark.createDataFrame(
        rows, "category string, table_name string, rows_written long, skipped_points string")


def run(spark: SparkSession, phase: str, stores: Stores, *, source: DataFrame | None = None,
        points: DataFrame | None = None, manifest: DataFrame | None = None,
        as_of: dt.date | None = None, run_id: int = 0, dry_run: bool = False, **kw):
    """``phase`` in extract / transform / all.  An extract with an empty
    manifest fails the phase (and so stops ``all`` before the transform)."""
    if phase not in ("extract", "transform", "all"):
        raise ValueError("phase must be extract, transform or all")
    out = {}
    if phase in ("extract", "all"):
        if points is None or manifest_points(points).isEmpty():
            raise ValueError("no points in the manifest: extract phase failed")
        out["extract"] = run_extract(spark, source, points, stores, as_of, run_id,
                                     dry_run=dry_run, **kw)
    if phase in ("transform", "all"):
        out["transform"] = run_transform(spark, stores, manifest, run_id, dry_run=dry_run)
    return out
