"""Registered queries over stores: tables that runs write, keep up to date and
read back. As in ``canopy.registry`` each function takes ``(spark, sf_dir)``,
works over whole tables, and has a DuckDB statement (``canopy.oracle_stored``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import config
from .functions.temporal import from_micros, run_end
from .operators import bitmaps as B
from .operators import partials as P
from .operators.extract import extract_and_stage
from .operators.reconcile import audit_late_rows
from .plans.runner import Stores, open_stores, point_starts, run_extract, run_transform
from .registry import (AUDIT_BUFFER_SECONDS, FIRST_AS_OF, RUN_HOUR, SECOND_AS_OF, STREAM_AS_OF, STREAM_SLICES,
                       _events_runs, five_staged, five_wide)
from .session import scratch_path, written
from .sources import testdata as td
from .sources.manifest import category_manifest_rows, point_manifest_rows
from .sources.ordinal import OrdinalTable, write_ordinal
from .sources.point_scan import scan_points
from .sources.store import CSV_TIME, StagedStore
from .sources.telemetry import staged_tables_to_long
from .streaming.stateful_extract import point_state, start_stateful_extract

# --- fixed values: query parameters ---
KEPT_AS_OF = [dt.date(2024, 1, 15), dt.date(2024, 1, 30)]   # two runs over events
KEPT_WINDOW_DAYS = 20                     # the second run purges days of the first
ID_BLOCK = 128                            # ids per block of the wide tables
BLOCK_ID = 900                            # an id that both tables hold at sf0.01
DEEP_LIMIT, DEEP_OFFSET, DEEP_ROWS_PER_PART = 40, 700, 150   # a page far down, parts far smaller than the table
DEEP_START, DEEP_END = "2024-01-05", "2024-01-21"
BITMAP_LIMIT = 1000
MANIFEST_FILES = 4
MANIFEST_BIOME = "NATION_9"
SHORT_EVERY, LONG_EVERY = 7, 11           # suppliers whose manifest row lacks a field, or has one too many
SCAN_AS_OF = [dt.date(2024, 1, 12), dt.date(2024, 1, 22), dt.date(2024, 1, 30)]
BROKEN, ABSENT = "view", "purchase"       # points that fail in the second run
# --- end of fixed values ---


def at_noon(d: dt.date) -> dt.datetime:
    return dt.datetime.combine(d, dt.time(RUN_HOUR))


# ---------------------------------------------------------------- two runs with a purge
def kept_runs(spark, sf, refresh: tuple[str, ...] = ()) -> Stores:
    """Two runs over ``events``; wide tables are brought up to date after each."""
    stores = open_stores(spark, scratch_path(spark, "kept"))
    src = td.events_five(spark, sf)
    pts = src.select("point").distinct()
    manifest = td.ordered_manifest(src, ["type1", "other"])
    for k, day in enumerate(KEPT_AS_OF):
        run_extract(spark, src, pts, stores, day, k + 1, at_noon(day), ["event_id"], window_days=KEPT_WINDOW_DAYS)
        for category in refresh:
            stores.blocks.refresh(stores, manifest, category, ID_BLOCK)
    return stores


def q_blocks_aligned(spark, sf) -> DataFrame:
    """Built after the first run; blocks with new and purged ids rebuilt after the second."""
    return kept_runs(spark, sf, ("type1",)).blocks.read(config.wide_table_name("type1"))


def q_blocks_ragged(spark, sf) -> DataFrame:
    return kept_runs(spark, sf, ("other",)).blocks.read(config.wide_table_name("other"))


def q_blocks_by_id(spark, sf) -> DataFrame:
    """One id: one block folder is opened."""
    return kept_runs(spark, sf, ("other",)).blocks.read(config.wide_table_name("other"), BLOCK_ID)


def q_kept_column_stats(spark, sf) -> DataFrame:
    """Column statistics of all retained readings from the kept partials alone."""
    partials, _ = kept_runs(spark, sf).partials.latest()
    return P.value_stats(partials)


def q_kept_time_stats(spark, sf) -> DataFrame:
    partials, _ = kept_runs(spark, sf).partials.latest()
    return P.time_stats(partials)


def q_kept_inventory(spark, sf) -> DataFrame:
    partials, _ = kept_runs(spark, sf).partials.latest()
    return P.inventory(partials)


# ---------------------------------------------------------------- points that fail
def scanned_runs(spark, sf) -> tuple[Stores, DataFrame]:
    """Three runs over a folder per point. In the second one point's files are
    no Parquet and another's folder is absent; in the third all can be read
    again. Returns the stores and the status of the second run with its state."""
    root = scratch_path(spark, "point-series")
    stores = open_stores(spark, f"{root}/store")
    ev = td.events_five(spark, sf)
    ev.write.partitionBy("point").parquet(f"{root}/series")
    ev.filter(F.col("point") == BROKEN).select(F.col("value").cast("string")).write.text(f"{root}/broken")
    pts = ev.select("point").distinct()
    whole = {r["point"]: f"{root}/series/point={r['point']}" for r in pts.collect()}   # manifest-sized
    second = whole | {BROKEN: f"{root}/broken", ABSENT: f"{root}/series/point=none"}
    status = None
    for k, (day, series) in enumerate(zip(SCAN_AS_OF, (whole, second, whole))):
        rows, errors = scan_points(spark, series, "ts timestamp_ntz, value double, event_id bigint",
                                   starts=point_starts(stores, pts, day, k + 1), upper=run_end(day))
        got = run_extract(spark, rows, pts, stores, day, k + 1, at_noon(day), failed=errors)
        if k == 1:
            state = stores.state.read()
            status = got.select("point", "new_rows", F.col("error").isNotNull().alias("failed")).join(state, "point")
    return stores, status


def q_scan_failed_status(spark, sf) -> DataFrame:
    """Every point has its state row of the run, also the two that failed."""
    return scanned_runs(spark, sf)[1]


def q_scan_failed_rows(spark, sf) -> DataFrame:
    """Staged rows after the third run: the failed points have caught up."""
    return scanned_runs(spark, sf)[0].staged.read()


# ---------------------------------------------------------------- stored tables in page order
def ordinal_table(spark, sf) -> OrdinalTable:
    path = scratch_path(spark, "ordinal")
    write_ordinal(five_wide(spark, sf, "type1").df, "type1", path, DEEP_ROWS_PER_PART)
    return OrdinalTable(spark, path, "type1")


def q_deep_page(spark, sf) -> DataFrame:
    """A page far down is found by the index; only its parts are read."""
    return ordinal_table(spark, sf).page(DEEP_LIMIT, DEEP_OFFSET).rows


def q_deep_page_dates(spark, sf) -> DataFrame:
    return ordinal_table(spark, sf).page(DEEP_LIMIT, DEEP_OFFSET, DEEP_START, DEEP_END).rows


def q_deep_page_total(spark, sf) -> DataFrame:
    return ordinal_table(spark, sf).page_total(DEEP_LIMIT, DEEP_OFFSET, DEEP_START, DEEP_END)


# ---------------------------------------------------------------- distinct ids by bitmaps
def id_bitmaps_by_point(spark, sf) -> DataFrame:
    """Bitmaps of the ids of every point, written once as kept versions would be."""
    return written(B.id_bitmaps(five_staged(spark, sf), "point"), "id-bitmaps")


def q_bitmap_id_counts(spark, sf) -> DataFrame:
    """Distinct ids per point, and of all points together (by OR, no row read again)."""
    bitmaps = id_bitmaps_by_point(spark, sf)
    whole = B.distinct_ids(bitmaps).select(F.lit("all").alias("point"), "unique_ids_count")
    return B.distinct_ids(bitmaps, "point").unionByName(whole)


def q_bitmap_first_ids(spark, sf) -> DataFrame:
    return B.first_ids(id_bitmaps_by_point(spark, sf), BITMAP_LIMIT)


# ---------------------------------------------------------------- late rows by a tree
def q_late_rows_tree(spark, sf) -> DataFrame:
    src, pts, _, r2 = _events_runs(spark, sf, AUDIT_BUFFER_SECONDS)
    return audit_late_rows(src, written(r2.staged, "staged"), pts, FIRST_AS_OF, SECOND_AS_OF).late


# ---------------------------------------------------------------- manifests with rejects
def manifest_folder(spark, sf) -> str:
    """``supplier`` x ``nation`` written as manifest files: a header each, rows
    in order of their key, some with a field too few or too many."""
    m = td.nation_points(spark, sf).withColumn("key", F.col("point").cast("long"))
    row = (F.when(F.col("key") % SHORT_EVERY == 0, F.col("biome"))
           .when(F.col("key") % LONG_EVERY == 0, F.concat_ws(",", "biome", "point", F.lit("x"), F.lit("y")))
           .otherwise(F.concat_ws(",", "biome", F.concat(F.lit('" P_'), "point", F.lit(' "')), F.lit("x"))))
    part = F.col("key") % MANIFEST_FILES
    lines = m.select(part.alias("part"), "key", row.alias("line"))
    heads = lines.select("part").distinct().select("part", F.lit(-1).cast("long").alias("key"),
                                                   F.lit("BIOMNAME,TABLE_NAME,OTHER").alias("line"))
    path = scratch_path(spark, "manifest")
    (lines.unionByName(heads).repartition(MANIFEST_FILES, "part").sortWithinPartitions("part", "key")
     .select("part", "line").write.partitionBy("part").text(path))
    return path


def q_manifest_points(spark, sf) -> DataFrame:
    return point_manifest_rows(spark, manifest_folder(spark, sf), MANIFEST_BIOME)[0]


def q_manifest_rejects(spark, sf) -> DataFrame:
    rejects = point_manifest_rows(spark, manifest_folder(spark, sf), MANIFEST_BIOME)[1]
    return rejects.select("record", "fields", "expected")


def q_manifest_order(spark, sf) -> DataFrame:
    """The same files as a category manifest: names normalised, rows counted in file order."""
    return category_manifest_rows(spark, manifest_folder(spark, sf), "BIOMNAME", "TABLE_NAME")[0]


# ---------------------------------------------------------------- names, exports, existing staging tables
def q_normalised_points(spark, sf) -> DataFrame:
    """Padded and upper-case names in the source and, otherwise padded, in the manifest."""
    src = td.events_five(spark, sf).withColumn("point", F.concat(F.lit("  "), F.upper("point"), F.lit("\t")))
    pts = td.events_five(spark, sf).select(F.concat(F.initcap("point"), F.lit(" ")).alias("point")).distinct()
    return extract_and_stage(src, pts, FIRST_AS_OF, run_ts=at_noon(FIRST_AS_OF), tiebreak=["event_id"]).new_rows


def q_exported_csv(spark, sf) -> DataFrame:
    """A stored wide table, exported as CSV and read back."""
    stores = open_stores(spark, scratch_path(spark, "exported"))
    src = td.events_five(spark, sf)
    pts = src.select("point").distinct()
    run_extract(spark, src, pts, stores, KEPT_AS_OF[1], 1, at_noon(KEPT_AS_OF[1]), ["event_id"])
    manifest, out = td.ordered_manifest(pts, ["other"]), scratch_path(spark, "exports")
    run_transform(spark, stores, manifest, 1, ["other"], export_root=out, when=at_noon(KEPT_AS_OF[1]))
    name = config.wide_table_name("other")
    schema = stores.wide.read(name).schema
    return (spark.read.schema(schema).option("header", True).option("timestampNTZFormat", CSV_TIME)
            .option("mode", "FAILFAST").csv(f"{out}/{name}_*"))


def q_existing_tables(spark, sf) -> DataFrame:
    """Staging tables in the original layout (one per point, the value column
    named after it), stored and read back into the long form. One lacks a value
    column and is skipped."""
    st = five_staged(spark, sf)
    root = scratch_path(spark, "existing")
    frames = {}
    for point in (r["point"] for r in st.select("point").distinct().collect()):   # manifest-sized
        one = st.filter(F.col("point") == point)
        cols = [F.col("unique_id").alias("UNIQUE_ID"), F.col("ts").alias("Timestamp"), F.col("value").alias(f"{point}_value")]
        one.select(*(cols[:2] if point == ABSENT else cols)).write.parquet(f"{root}/{point}")
        frames[f" {point.upper()} "] = spark.read.parquet(f"{root}/{point}")
    return staged_tables_to_long(frames)[0]


# ---------------------------------------------------------------- a stream with state of its own
def stateful_stream(spark, sf) -> tuple[StagedStore, str]:
    """The file drops of ``stream_extract``, staged by the stream that keeps
    counters and marks in the state store; its clock stands in the as-of day."""
    root = scratch_path(spark, "stateful-extract")
    ev = td.events_five(spark, sf)
    pts = ev.select("point").distinct()
    offset = at_noon(STREAM_AS_OF) - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    bounds = [None, *STREAM_SLICES, None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        sl = ev if lo is None else ev.filter(F.col("ts") >= F.lit(lo).cast(ev.schema["ts"].dataType))
        sl = sl if hi is None else sl.filter(F.col("ts") < F.lit(hi).cast(ev.schema["ts"].dataType))
        sl.write.mode("append").parquet(f"{root}/source")
        start_stateful_extract(spark, f"{root}/source", ev.schema, f"{root}/store", pts, f"{root}/checkpoint",
                               buffer_seconds=AUDIT_BUFFER_SECONDS, clock_offset=offset).awaitTermination()
    return StagedStore(spark, f"{root}/store"), f"{root}/checkpoint"


def q_stateful_stream(spark, sf) -> DataFrame:
    return stateful_stream(spark, sf)[0].read()


def q_stateful_stream_state(spark, sf) -> DataFrame:
    """What the state store holds after the last drop."""
    state = point_state(spark, stateful_stream(spark, sf)[1])
    return state.select("point", from_micros(F.col("newest"), T.TimestampNTZType()).alias("newest"), "last_used_id")


QUERIES = {
    "blocks_aligned": q_blocks_aligned,
    "blocks_ragged": q_blocks_ragged,
    "blocks_by_id": q_blocks_by_id,
    "kept_column_stats": q_kept_column_stats,
    "kept_time_stats": q_kept_time_stats,
    "kept_inventory": q_kept_inventory,
    "scan_failed_status": q_scan_failed_status,
    "scan_failed_rows": q_scan_failed_rows,
    "deep_page": q_deep_page,
    "deep_page_dates": q_deep_page_dates,
    "deep_page_total": q_deep_page_total,
    "bitmap_id_counts": q_bitmap_id_counts,
    "bitmap_first_ids": q_bitmap_first_ids,
    "late_rows_tree": q_late_rows_tree,
    "manifest_points": q_manifest_points,
    "manifest_rejects": q_manifest_rejects,
    "manifest_order": q_manifest_order,
    "normalised_points": q_normalised_points,
    "exported_csv": q_exported_csv,
    "existing_tables": q_existing_tables,
    "stateful_stream": q_stateful_stream,
    "stateful_stream_state": q_stateful_stream_state,
}
