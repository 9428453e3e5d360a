"""Run status, table inventory and freshness over the run state and the
stored tables (exact counts, not catalog estimates)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def run_metadata(state: DataFrame) -> DataFrame:
    """The state rows, newest run first (ties by point)."""
    return (state.select("point", "last_run_date", "last_run_timestamp", "last_used_id")
            .orderBy(F.col("last_run_timestamp").desc_nulls_last(), "point"))


def run_summary(state: DataFrame) -> DataFrame:
    """One row: ``latest_run, tables_processed``."""
    return state.agg(F.max("last_run_timestamp").alias("latest_run"),
                     F.count(F.lit(1)).alias("tables_processed"))


def inventory(telemetry: DataFrame, wide_tables: dict, state: DataFrame | None = None) -> DataFrame:
    """``table_name, row_count`` of every stored table: one per point (from
    the long table, one aggregate), the metadata table and the wide tables.
    Built as one union of aggregates."""
    spark = telemetry.sparkSession
    parts = [telemetry.groupBy(F.col("point").alias("table_name"))
             .agg(F.count(F.lit(1)).alias("row_count"))]
    if state is not None:
        parts.append(state.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(config.METADATA_TABLE).alias("table_name"), "row_count"))
    for cat, df in wide_tables.items():
        if df is None:
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(config.wide_table_name(cat)).alias("table_name"), "row_count"))
    if not parts:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return reduce(DataFrame.unionByName, parts)


def source_inventory(inv: DataFrame) -> DataFrame:
    """Everything except ``staging_%`` (a LIKE pattern: ``_`` matches any
    single character), largest first."""
    return (inv.filter(~F.col("table_name").like("staging_%"))
            .orderBy(F.col("row_count").desc(), "table_name"))


def wide_inventory(inv: DataFrame) -> DataFrame:
    """The wide tables (``wide_%``), largest first."""
    return (inv.filter(F.col("table_name").like(f"{config.WIDE_TABLE_PREFIX}%"))
            .orderBy(F.col("row_count").desc(), "table_name"))


def table_counts(inv: DataFrame) -> DataFrame:
    """One row: the number of ``source_tables`` (all but ``staging_%``, as
    :func:`source_inventory` lists them) and of ``wide_tables``."""
    return inv.agg(F.count_if(~F.col("table_name").like("staging_%")).alias("source_tables"),
                   F.count_if(F.col("table_name").like(f"{config.WIDE_TABLE_PREFIX}%")).alias("wide_tables"))


def data_freshness(state: DataFrame, as_of: dt.datetime,
                   hours: int = config.FRESHNESS_HOURS) -> DataFrame:
    """One row: ``fresh_tables`` (runs strictly after ``as_of - hours``) and
    ``is_fresh`` (``fresh_tables > 0``)."""
    since = F.lit((as_of - dt.timedelta(hours=hours)).isoformat(sep=" ")).cast("timestamp_ntz")
    return (state.agg(F.count_if(F.col("last_run_timestamp") > since).alias("fresh_tables"))
            .withColumn("is_fresh", F.col("fresh_tables") > 0))
