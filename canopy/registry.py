"""The registered queries: one per operator family, over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns match the DuckDB statement of the same key in ``canopy.oracle``.
Parameters (as-of dates, buffers, page arguments, biomes) are fixed values of
the query, stated at the top; the data always comes from the full tables.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import config
from .functions.names import value_column_name
from .functions.temporal import round_reading
from .operators import monitor as M
from .operators import query as Q
from .operators.extract import extract_and_stage, late_rows
from .operators.sequence import assign_sequence
from .operators.state import (apply_retention, high_water_marks, last_ids,
                              state_from_staged)
from .operators.wide import build_wide
from .plans.runner import open_stores, run_extract, run_transform
from .session import scratch_path
from .sources import testdata as td
from .streaming.extract_stream import start_extract_stream

# --- fixed values: query parameters ---
FIRST_AS_OF = dt.date(2024, 1, 15)       # events: first run reads ts < 2024-01-16
SECOND_AS_OF = dt.date(2024, 1, 30)      # events: second run reads ts < 2024-01-31
AUDIT_BUFFER_SECONDS = 6 * 3600          # a buffer that actually drops rows
PURGE_AS_OF = dt.date(2024, 2, 10)       # cutoff 2024-01-11
LI_FIRST_AS_OF = dt.date(1998, 12, 31)   # lineitem runs: ten-year window
LI_SECOND_AS_OF = dt.date(2001, 12, 31)
LI_WINDOW_DAYS = 3650
RUN_HOUR = 12                            # runs happen at noon of the as-of day
BIOME = "NATION_9"
FIRST_BIOMES = ["NATION_9", "NATION_6"]
SECOND_BIOMES = ["NATION_6", "NATION_11"]
PAGE_START, PAGE_END = "2024-01-10", "2024-01-12"
PAGE_LIMIT, PAGE_OFFSET = 50, 10
RAGGED_PAGE_START = "2024-01-20"
PAGE_ID = 2010
TOTAL_LIMIT, TOTAL_OFFSET = 100, 100
ID_LIMIT = 1000
FRESH_AS_OF = dt.datetime(2024, 1, 30, 12, 0, 0)
STREAM_AS_OF = dt.date(2024, 1, 31)
STORE_AS_OF = dt.date(2024, 1, 30)       # one stored run over all of events
STORE_WINDOW_DAYS = 60
GHOST = "a_ghost"                        # a manifest point that never reports, first in order
SHORT_WINDOW_DAYS = 14                   # the second run purges rows of the first
STREAM_SLICES = ["2024-01-11", "2024-01-21"]   # file arrivals split by time
# --- end of fixed values ---


def _run_ts(d: dt.date) -> dt.datetime:
    return dt.datetime.combine(d, dt.time(RUN_HOUR, 0))


def _written(df: DataFrame) -> DataFrame:
    """What a run leaves behind is a stored table: write it (Parquet) below
    the shared checkpoint folder, so the next run reads it instead of
    recomputing the previous run's lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, "run-output")
    df.write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- fixtures
def five_staged(spark, sf):
    return td.staged(td.events_five(spark, sf))


def many_staged(spark, sf):
    return td.staged(td.events_many(spark, sf))


def five_wide(spark, sf, category: str):
    st = five_staged(spark, sf)
    return build_wide(st, td.ordered_manifest(st, [category]), category)


def slots_staged(spark, sf):
    return td.staged(td.events_slots(spark, sf))


def slots_wide(spark, sf, category: str):
    st = slots_staged(spark, sf)
    return build_wide(st, td.slot_manifest(st), category)


def _events_runs(spark, sf, buffer_seconds=config.TIMESTAMP_BUFFER_SECONDS):
    src = td.events_five(spark, sf)
    pts = src.select("point").distinct()
    r1 = extract_and_stage(src, pts, FIRST_AS_OF, run_ts=_run_ts(FIRST_AS_OF), tiebreak=["event_id"],
                           buffer_seconds=buffer_seconds, batch_path=scratch_path(spark, "batch"))
    r2 = extract_and_stage(src, pts, SECOND_AS_OF, staged=_written(r1.staged),
                           state=_written(r1.state), run_ts=_run_ts(SECOND_AS_OF), tiebreak=["event_id"],
                           buffer_seconds=buffer_seconds, batch_path=scratch_path(spark, "batch"))
    return src, pts, r1, r2


def _lineitem_runs(spark, sf, first_biomes=None, second_biomes=None):
    src = td.bench_source(spark, sf)
    tb = td.LINEITEM_TIEBREAK + ["value"]
    man = td.nation_points(spark, sf)
    p1 = man if first_biomes is None else man.filter(F.col("biome").isin(first_biomes))
    p2 = man if second_biomes is None else man.filter(F.col("biome").isin(second_biomes))
    runs = dict(tiebreak=tb, window_days=LI_WINDOW_DAYS)
    r1 = extract_and_stage(src, p1, LI_FIRST_AS_OF, run_ts=_run_ts(LI_FIRST_AS_OF),
                           batch_path=scratch_path(spark, "batch"), **runs)
    r2 = extract_and_stage(src, p2, LI_SECOND_AS_OF, staged=_written(r1.staged), state=_written(r1.state),
                           run_ts=_run_ts(LI_SECOND_AS_OF), batch_path=scratch_path(spark, "batch"), **runs)
    return r1, r2


# ---------------------------------------------------------------- step 1-2
def q_page_aligned(spark, sf):
    w = five_wide(spark, sf, "type1")
    return Q.page(w.df, "type1", PAGE_LIMIT, PAGE_OFFSET, PAGE_START, PAGE_END)


def q_assign_sequence(spark, sf):
    src = td.bench_source(spark, sf)
    out = assign_sequence(src, "point", "ts", td.LINEITEM_TIEBREAK + ["value"])
    return out.select("point", "unique_id", "ts", "value", "l_orderkey", "l_linenumber")


def q_round_reading(spark, sf):
    li = td.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey",
                     round_reading(F.col("l_extendedprice") * F.col("l_discount"))
                     .alias("reading"))


def _name_variants(spark, sf) -> DataFrame:
    part = td.table(spark, sf, "part")
    sup = td.table(spark, sf, "supplier")
    size = F.col("p_size").cast("string")
    variants = [
        ("part_full", part.p_partkey, F.concat_ws("_", "p_brand", "p_name", "p_type", size)),
        ("part_name", part.p_partkey, F.col("p_name")),
        ("part_marker", part.p_partkey,
         F.concat_ws("_", F.col("p_type"), F.concat(F.lit("AHUR"), size), F.col("p_name"))),
        ("part_trailing", part.p_partkey, F.concat(F.col("p_brand"), F.lit("_"))),
    ]
    frames = [part.select(F.lit(k).alias("kind"), i.alias("id"), e.alias("raw_name"))
              for k, i, e in variants]
    frames.append(sup.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"),
                             F.col("s_name").alias("raw_name")))
    return reduce(DataFrame.unionByName, frames)


def q_value_column_name(spark, sf):
    v = _name_variants(spark, sf)
    return v.withColumn("value_name", value_column_name("raw_name"))


# ---------------------------------------------------------------- step 3
def q_manifest_restrict(spark, sf):
    src = td.bench_source(spark, sf)
    pts = td.nation_points(spark, sf, BIOME)
    # no hint: the planner broadcasts the manifest side only if its measured
    # size is under the threshold, else a shuffled semi join
    return (src.join(pts.select("point"), "point", "left_semi")
            .select("point", "ts", "value", "l_orderkey", "l_linenumber"))


def q_extract_first_run(spark, sf):
    src = td.events_five(spark, sf)
    r = extract_and_stage(src, src.select("point").distinct(), FIRST_AS_OF,
                          run_ts=_run_ts(FIRST_AS_OF), tiebreak=["event_id"])
    return r.new_rows


def q_extract_incremental(spark, sf):
    _, _, _, r2 = _events_runs(spark, sf)
    return r2.staged


def q_late_rows_audit(spark, sf):
    src, pts, _, r2 = _events_runs(spark, sf, AUDIT_BUFFER_SECONDS)
    return late_rows(src, r2.staged, pts, FIRST_AS_OF, SECOND_AS_OF)


def q_late_rows_purged(spark, sf):
    """The second run purges rows that the first staged in time."""
    src = td.events_five(spark, sf)
    pts = src.select("point").distinct()
    runs = dict(tiebreak=["event_id"], buffer_seconds=AUDIT_BUFFER_SECONDS, window_days=SHORT_WINDOW_DAYS)
    r1 = extract_and_stage(src, pts, FIRST_AS_OF, run_ts=_run_ts(FIRST_AS_OF), **runs)
    r2 = extract_and_stage(src, pts, SECOND_AS_OF, staged=_written(r1.staged), state=_written(r1.state),
                           run_ts=_run_ts(SECOND_AS_OF), **runs)
    return late_rows(src, r2.staged, pts, FIRST_AS_OF, SECOND_AS_OF, SHORT_WINDOW_DAYS)


# ---------------------------------------------------------------- step 4
def q_high_water_marks(spark, sf):
    src = td.events_five(spark, sf)
    r = extract_and_stage(src, src.select("point").distinct(), FIRST_AS_OF,
                          run_ts=_run_ts(FIRST_AS_OF), tiebreak=["event_id"])
    return high_water_marks(r.new_rows)


def q_last_ids(spark, sf):
    _, pts, r1, r2 = _events_runs(spark, sf)
    # the metadata lags the data (state of run 1, rows of both runs)
    return last_ids(r2.staged, r1.state, pts)


def q_staged_append(spark, sf):
    _, r2 = _lineitem_runs(spark, sf)
    return r2.staged


def q_metadata_upsert(spark, sf):
    _, r2 = _lineitem_runs(spark, sf, FIRST_BIOMES, SECOND_BIOMES)
    return r2.state


def q_retention_kept(spark, sf):
    return apply_retention(five_staged(spark, sf), PURGE_AS_OF).kept


def q_retention_purged_counts(spark, sf):
    return apply_retention(five_staged(spark, sf), PURGE_AS_OF).purged


# ---------------------------------------------------------------- step 5
def q_wide_aligned(spark, sf):
    return five_wide(spark, sf, "type1").df


def q_wide_ragged(spark, sf):
    return five_wide(spark, sf, "other").df


def collision_staged(spark, sf):
    """Five points whose names collide: ``<event>_temp`` (5 letters or less)
    and ``<event>_rh_1`` (longer) -> value names ``temp`` / ``rh_1``."""
    ev = td.events_five(spark, sf)
    suffix = F.when(F.length("point") <= 5, F.lit("_TEMP")).otherwise(F.lit("_RH_1"))
    src = ev.withColumn("point", F.lower(F.concat(F.upper("point"), suffix)))
    return td.staged(src)


def q_wide_name_collisions(spark, sf):
    st = collision_staged(spark, sf)
    return build_wide(st, td.ordered_manifest(st, ["type2"]), "type2").df


def q_wide_many_points(spark, sf):
    st = slots_staged(spark, sf)
    return build_wide(st, td.ordered_manifest(st, ["other"]), "other").df


# ---------------------------------------------------------------- step 6
def q_page_ragged(spark, sf):
    w = five_wide(spark, sf, "other")
    return Q.page(w.df, "other", config.PAGE_LIMIT_DEFAULT, 0, RAGGED_PAGE_START)


def q_page_by_id(spark, sf):
    w = five_wide(spark, sf, "other")
    return Q.page(w.df, "other", unique_id=PAGE_ID)


def q_page_total(spark, sf):
    w = five_wide(spark, sf, "type1")
    return Q.page_total(w.df, "type1", TOTAL_LIMIT, TOTAL_OFFSET, PAGE_START, PAGE_END)


def _both(spark, sf, fn):
    st = five_staged(spark, sf)
    man = td.ordered_manifest(st, ["type1", "other"])
    parts = []
    for cat in ("type1", "other"):
        w = build_wide(st, man, cat)
        parts.append(fn(w.df, cat).select(F.lit(cat).alias("category"), "*"))
    return reduce(DataFrame.unionByName, parts)


def q_table_stats(spark, sf):
    return _both(spark, sf, Q.table_stats)


def q_column_stats(spark, sf):
    out = _both(spark, sf, lambda df, cat: Q.column_stats(df))
    return out.withColumn("avg_value", F.round(F.col("avg_value").cast("decimal(38,12)"), 6)
                          .cast("double"))


def q_column_stats_many_points(spark, sf):
    """Column statistics of a wide table with more columns than one aggregate
    should carry (the unpivot path)."""
    out = Q.column_stats(q_wide_many_points(spark, sf))
    return out.withColumn("avg_value", F.round(F.col("avg_value").cast("decimal(38,12)"), 6)
                          .cast("double"))


def q_unique_ids(spark, sf):
    w = five_wide(spark, sf, "other")
    return Q.unique_ids(w.df, "other", ID_LIMIT)


def q_time_range(spark, sf):
    return _both(spark, sf, Q.time_range)


def _warehouse(spark, sf) -> dict:
    st5 = five_staged(spark, sf)
    man5 = td.ordered_manifest(st5, ["type1", "other"])
    stm = slots_staged(spark, sf)
    manm = td.slot_manifest(stm)
    out = {}
    for cat, st, man in (("type1", st5, man5), ("other", st5, man5),
                         ("less50", stm, manm), ("between50and100", stm, manm)):
        w = build_wide(st, man, cat)
        out[cat] = None if w is None else w.df
    return out


def q_tables_overview(spark, sf):
    ov = Q.tables_overview(spark, _warehouse(spark, sf))
    return ov.select("category", "table_name", "row_count", "available",
                     F.size("columns").alias("column_count"))


# ---------------------------------------------------------------- step 7
def _many_state(spark, sf):
    return state_from_staged(many_staged(spark, sf))


def q_run_status(spark, sf):
    return M.run_metadata(_many_state(spark, sf))


def q_run_summary(spark, sf):
    return M.run_summary(_many_state(spark, sf))


def _inventory(spark, sf):
    stm = many_staged(spark, sf)
    wides = {}
    for cat in ("less50", "between50and100"):
        w = slots_wide(spark, sf, cat)
        wides[cat] = None if w is None else w.df
    return M.inventory(stm, wides, state_from_staged(stm))


def q_table_inventory(spark, sf):
    return M.source_inventory(_inventory(spark, sf))


def q_wide_inventory(spark, sf):
    return M.wide_inventory(_inventory(spark, sf))


def q_table_counts(spark, sf):
    return M.table_counts(_inventory(spark, sf))


def q_data_freshness(spark, sf):
    return M.data_freshness(_many_state(spark, sf), FRESH_AS_OF)


# ---------------------------------------------------------------- stored wide tables
def _stored_wide(spark, sf):
    """A stored run over all of ``events`` with a manifest point that never
    reports, the wide tables built from it, and a rebuild that comes out empty."""
    stores = open_stores(spark, scratch_path(spark, "stored-wide"))
    src = td.events_five(spark, sf)
    every = src.select("point").distinct()
    ghost = spark.createDataFrame([(GHOST,)], "point string")
    run_extract(spark, src, every.unionByName(ghost), stores, STORE_AS_OF, 1, _run_ts(STORE_AS_OF),
                ["event_id"], window_days=STORE_WINDOW_DAYS)
    cats = ["type1", "other"]
    manifest = td.ordered_manifest(every.unionByName(ghost), cats)
    run_transform(spark, stores, manifest, 1, cats)
    for cat in cats:
        name = config.wide_table_name(cat)
        stores.wide.replace(name, stores.wide.read(name).limit(0), 2)
    return stores.wide


def q_wide_missing_point(spark, sf):
    return _stored_wide(spark, sf).read(config.wide_table_name("other"))


def q_stored_wide_page(spark, sf):
    df = _stored_wide(spark, sf).read(config.wide_table_name("type1"))
    return Q.page(df, "type1", PAGE_LIMIT, PAGE_OFFSET, PAGE_START, PAGE_END)


def q_stored_wide_total(spark, sf):
    df = _stored_wide(spark, sf).read(config.wide_table_name("type1"))
    return Q.page_total(df, "type1", TOTAL_LIMIT, TOTAL_OFFSET, PAGE_START, PAGE_END)


# ---------------------------------------------------------------- step 8
def q_stream_extract(spark, sf):
    """Events arrive as three time-ordered file drops; after each drop the
    stream runs ``availableNow`` (one micro-batch per drop)."""
    root = scratch_path(spark, "stream-extract")
    src_dir, ckpt = f"{root}/source", f"{root}/checkpoint"
    stores = open_stores(spark, f"{root}/store")
    ev = td.events_five(spark, sf)
    pts = ev.select("point").distinct()
    bounds = [None] + STREAM_SLICES + [None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        sl = ev
        if lo:
            sl = sl.filter(F.col("ts") >= F.lit(lo).cast(ev.schema["ts"].dataType))
        if hi:
            sl = sl.filter(F.col("ts") < F.lit(hi).cast(ev.schema["ts"].dataType))
        sl.write.mode("append").parquet(src_dir)
        q = start_extract_stream(spark, src_dir, ev.schema, stores, pts, STREAM_AS_OF, ckpt,
                                 tiebreak=["event_id"], buffer_seconds=AUDIT_BUFFER_SECONDS)
        q.awaitTermination()
    return stores.staged.read()


QUERIES = {
    "page_aligned": q_page_aligned,
    "assign_sequence": q_assign_sequence,
    "round_reading": q_round_reading,
    "value_column_name": q_value_column_name,
    "manifest_restrict": q_manifest_restrict,
    "extract_first_run": q_extract_first_run,
    "extract_incremental": q_extract_incremental,
    "late_rows_audit": q_late_rows_audit,
    "late_rows_purged": q_late_rows_purged,
    "high_water_marks": q_high_water_marks,
    "last_ids": q_last_ids,
    "staged_append": q_staged_append,
    "metadata_upsert": q_metadata_upsert,
    "retention_kept": q_retention_kept,
    "retention_purged_counts": q_retention_purged_counts,
    "wide_aligned": q_wide_aligned,
    "wide_ragged": q_wide_ragged,
    "wide_name_collisions": q_wide_name_collisions,
    "wide_many_points": q_wide_many_points,
    "page_ragged": q_page_ragged,
    "page_by_id": q_page_by_id,
    "page_total": q_page_total,
    "table_stats": q_table_stats,
    "column_stats": q_column_stats,
    "column_stats_many_points": q_column_stats_many_points,
    "unique_ids": q_unique_ids,
    "time_range": q_time_range,
    "tables_overview": q_tables_overview,
    "run_status": q_run_status,
    "run_summary": q_run_summary,
    "table_inventory": q_table_inventory,
    "wide_inventory": q_wide_inventory,
    "table_counts": q_table_counts,
    "data_freshness": q_data_freshness,
    "wide_missing_point": q_wide_missing_point,
    "stored_wide_page": q_stored_wide_page,
    "stored_wide_total": q_stored_wide_total,
    "stream_extract": q_stream_extract,
}
