"""Source series readers: the long form ``(point, ts, value, ...)``.

* :func:`jdbc_source` -- one source table per point in a relational database
  (the original layout).  Each point is read with a partitioned JDBC scan on
  ``ts`` (``numPartitions`` parallel range queries); the run's ``ts`` bounds
  are pushed to the database as ``PushedFilters``.  The frames of all points
  are unioned into the long form, so the rest is one job.
* :func:`long_source` -- an already long table (Parquet, a catalog table):
  column renames only; filters and pruning reach the scan.
* :func:`staged_tables_to_long` -- per-point *staged* tables in the original
  layout (``unique_id, timestamp, <value name>``), e.g. read over JDBC, into
  the long staged form (migration of existing staging tables).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def long_source(df: DataFrame, point: str = "point", ts: str = "ts", value: str = "value",
                extra: tuple[str, ...] = ()) -> DataFrame:
    """Rename columns of a long source to ``point, ts, value, *extra``."""
    return df.select(F.col(point).cast("string").alias("point"), F.col(ts).alias("ts"),
                     F.col(value).cast("double").alias("value"), *extra)


def jdbc_source(spark: SparkSession, url: str, tables: list[str], schema: str | None = None,
                ts_col: str = "timestamp", value_col: str = "value",
                lower: dt.datetime | None = None, upper: dt.datetime | None = None,
                num_partitions: int = 8, properties: dict | None = None,
                starts: dict[str, dt.datetime] | None = None,
                failures: dict[str, str] | None = None) -> DataFrame:
    """Union of per-point JDBC tables as ``(point, ts, value)``.

    With ``lower``/``upper`` every table is read by ``num_partitions`` parallel
    range queries on ``ts_col``.  Connection options come from the caller
    (``properties``: user, password, driver, fetchsize ...).  ``starts``
    (``plans.runner.point_starts``) gives each table its own strict lower
    bound, pushed to the database.  With ``failures`` a table that cannot be
    resolved, or lacks a column, is left out and named there with the reason
    (for ``run_extract(failed=...)``); without it the error is raised.
    """
    props = {"fetchsize": "10000", **(properties or {})}
    frames = []
    for t in tables:
        try:
            df = _one_table(spark, url, t, schema, ts_col, value_col, lower, upper, num_partitions, props)
        except Exception as error:  # whatever the driver of the database raises
            if failures is None:
                raise
            failures[t] = str(error).split("\n")[0][:500]
            continue
        start = (starts or {}).get(t.strip().lower())
        if start is not None:
            df = df.filter(F.col("ts") > F.lit(start.isoformat(sep=" ")).cast(df.schema["ts"].dataType))
        frames.append(df)
    if not frames:
        return spark.createDataFrame([], "point string, ts timestamp, value double")
    return reduce(DataFrame.unionByName, frames)


def _one_table(spark, url, t, schema, ts_col, value_col, lower, upper, num_partitions, props) -> DataFrame:
    name = f"{schema}.{t}" if schema else t
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    for k, v in props.items():
        reader = reader.option(k, v)
    if num_partitions > 1 and lower is not None and upper is not None:
        reader = (reader.option("partitionColumn", ts_col)
                  .option("lowerBound", lower.isoformat(sep=" "))
                  .option("upperBound", upper.isoformat(sep=" "))
                  .option("numPartitions", str(num_partitions)))
    df = reader.load()
    cols = {c.lower(): c for c in df.columns}
    for needed in (ts_col, value_col):
        if needed.lower() not in cols:
            raise ValueError(f"table {name} has no column {needed}")
    return df.select(F.lit(t).alias("point"), F.col(cols[ts_col.lower()]).alias("ts"),
                     F.col(cols[value_col.lower()]).cast("double").alias("value"))


EXCLUDED = ("timestamp", "unique_id")


def value_column(columns: list[str]) -> str | None:
    """The first column whose lower-cased name is neither ``timestamp`` nor
    ``unique_id``; ``None`` when there is none."""
    for c in columns:
        if c.lower() not in EXCLUDED:
            return c
    return None


def staged_tables_to_long(frames: dict[str, DataFrame]) -> tuple[DataFrame | None, list[str]]:
    """Union per-point staged tables into ``point, unique_id, ts, value``.

    A table without a value column, or with fewer than three columns, is
    skipped (returned in the second element), as the alignment step of the
    original skipped it.  Point names are normalised (trim, lower case).
    """
    from ..functions.names import normalise_point
    parts, skipped = [], []
    for point, df in frames.items():
        cols = {c.lower(): c for c in df.columns}
        v = value_column(df.columns)
        if v is None or len(df.columns) < 3 or "unique_id" not in cols or "timestamp" not in cols:
            skipped.append(point)
            continue
        parts.append(df.select(normalise_point(F.lit(point)).alias("point"),
                               F.col(cols["unique_id"]).cast("long").alias("unique_id"),
                               F.col(cols["timestamp"]).alias("ts"),
                               F.col(v).cast("double").alias("value")))
    if not parts:
        return None, skipped
    return reduce(lambda a, b: a.unionByName(b), parts), skipped
