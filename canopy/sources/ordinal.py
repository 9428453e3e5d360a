"""Wide tables stored in page order, with an ordinal index.

A deep page asks for the rows ``offset+1 .. offset+limit`` in time order.
Ranking the table for it reads all of it. Here the table is written once in
that order, in parts of a stated number of rows, with a small index of each
part's row count and bounds. A prefix sum over the counts finds the parts that
a page falls in, and only those are read; nothing is ranked beyond them. Date
filters keep a stretch of the order, so they are found the same way: whole
parts by their bounds, and the one or two parts at the edges by counting in
them.

Layout: ``<path>/data/folder_part=<k>/`` and ``<path>/index`` (written last).
Order: time descending, nulls last, then ``unique_id`` ascending. The rows are
range-partitioned into folders of ``FOLDER_ROWS`` rows (or one part, if that
is larger), a task and a file each; a folder's rows are cut into parts by
their place. So tasks, files and folders follow the size of the table, however
small its parts are, and a part inside its file is found by the page index of
its number. Folders are cut by a sample of the rows; times that are equal are
told apart by id, so a time that a third of all rows share is spread as well.
The sums over the index are taken per folder, then over the folders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..operators.query import _as_date, check_category, check_page_args, timestamp_column
from ..operators.wide import q
from ..session import written

ROWS_PER_PART = 200_000
FOLDER_ROWS = 200_000
#: Rows of a Parquet page, the least that is read: a part's, within these bounds.
PAGE_ROWS_LEAST, PAGE_ROWS_MOST = 1_000, 20_000
#: Places of rows in a task, the low bits of ``monotonically_increasing_id``.
_PLACES = (1 << 33) - 1


def _order(time: Column) -> list[Column]:
    return [time.desc_nulls_last(), F.col("unique_id").asc_nulls_first()]


def write_ordinal(df: DataFrame, category: str, path: str, rows_per_part: int = ROWS_PER_PART) -> None:
    """Write a wide table in page order (``path`` is new; a table without rows
    is refused, as stored wide tables have some)."""
    check_category(category)
    time = F.col(q(timestamp_column(df.columns, category)))
    df = written(df, "ordinal-rows")   # counted, sampled and sorted: made once
    count = df.count()
    if not count:
        raise ValueError("no rows to write")
    ranged = df.repartitionByRange(max(1, -(-count // max(rows_per_part, FOLDER_ROWS))), *_order(time))
    ordered = ranged.withColumn("folder_part", F.spark_partition_id()).sortWithinPartitions("folder_part", *_order(time))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES))
    (ordered.withColumn("part", F.shiftleft(F.col("folder_part").cast("long"), 33) + F.floor(place / rows_per_part))
     .write.partitionBy("folder_part")
     .option("parquet.page.row.count.limit", str(min(max(rows_per_part, PAGE_ROWS_LEAST), PAGE_ROWS_MOST)))
     .parquet(f"{path}/data"))
    stored = df.sparkSession.read.parquet(f"{path}/data")
    parts = stored.groupBy("folder_part", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.count(time).alias("timed"),
        F.min(F.to_date(time)).alias("first_day"), F.max(F.to_date(time)).alias("last_day"))
    inside = Window.partitionBy("folder_part").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(parts.withColumn("before", F.coalesce(F.sum("rows").over(inside), F.lit(0))), "ordinal-parts")
    # a row per folder of a stated size, so the running sum is over a small table
    ahead = Window.orderBy("folder_part").rowsBetween(Window.unboundedPreceding, -1)
    folders = parts.groupBy("folder_part").agg(F.sum("rows").alias("rows")).select(
        "folder_part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead"))
    (parts.join(F.broadcast(folders), "folder_part").withColumn("before", F.col("before") + F.col("ahead")).drop("ahead")
     .write.parquet(f"{path}/index"))


@dataclass
class Page:
    rows: DataFrame
    parts: list[int]       # parts that the page is read from
    total: int             # rows that the filter keeps


class OrdinalTable:
    def __init__(self, spark: SparkSession, path: str, category: str):
        check_category(category)
        self.spark, self.path = spark, path
        self.index = spark.read.parquet(f"{path}/index")
        self.data = spark.read.parquet(f"{path}/data")
        self.time = timestamp_column([c for c in self.data.columns if c not in ("part", "folder_part")], category)

    def read(self) -> DataFrame:
        return self.data.drop("part", "folder_part")

    def _parts(self, found: list) -> DataFrame:
        """Rows of the ``folder_part, part`` in ``found``: their folders, and in those their pages."""
        return self.data.filter(F.col("folder_part").isin(sorted({r["folder_part"] for r in found}))
                                & F.col("part").isin([r["part"] for r in found]))

    def _stretch(self, start_date, end_date) -> tuple[Column | None, DataFrame]:
        """The row filter, and ``folder_part, part, kept`` of the parts with rows
        of the stretch: counts of whole parts from the index, of parts at an edge from
        the rows."""
        lo = _as_date(start_date) if start_date else None
        hi = _as_date(end_date) if end_date else None
        if lo is None and hi is None:
            return None, self.index.select("folder_part", "part", F.col("rows").alias("kept"))
        day = F.to_date(F.col(q(self.time)))
        keep, some, all_ = F.lit(True), F.lit(True), F.col("timed") == F.col("rows")
        if lo is not None:
            keep, some, all_ = keep & (day >= F.lit(lo)), some & (F.col("last_day") >= F.lit(lo)), all_ & (F.col("first_day") >= F.lit(lo))
        if hi is not None:
            keep, some, all_ = keep & (day <= F.lit(hi)), some & (F.col("first_day") <= F.lit(hi)), all_ & (F.col("last_day") <= F.lit(hi))
        hit = self.index.filter(some)
        whole = hit.filter(all_).select("folder_part", "part", F.col("rows").alias("kept"))
        edge = hit.filter(~all_).select("folder_part", "part").collect()   # at most the two edges and the nulls'
        counted = self._parts(edge).filter(keep).groupBy("folder_part", "part").agg(F.count(F.lit(1)).alias("kept"))
        return keep, whole.unionByName(counted)

    def page(self, limit: int = config.PAGE_LIMIT_DEFAULT, offset: int = 0, start_date: dt.date | str | None = None,
             end_date: dt.date | str | None = None) -> Page:
        """Rows ``offset+1 .. offset+limit`` of the filtered table, newest first."""
        check_page_args(limit, offset)
        keep, kept = self._stretch(start_date, end_date)
        upto = F.sum("kept").over(Window.orderBy("folder_part").rowsBetween(Window.unboundedPreceding, 0))
        folders = kept.groupBy("folder_part").agg(F.sum("kept").alias("kept")).withColumn("upto", upto)   # a row per folder
        total = folders.agg(F.max("upto")).first()[0] or 0
        hit = (F.col("upto") > offset) & (F.col("upto") - F.col("kept") < offset + limit)
        near = folders.filter(hit).select("folder_part", (F.col("upto") - F.col("kept")).alias("ahead"))
        inside = F.sum("kept").over(Window.partitionBy("folder_part").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        ends = kept.join(F.broadcast(near), "folder_part").withColumn("upto", F.col("ahead") + inside)
        found = ends.filter(hit).select("folder_part", "part", (F.col("upto") - F.col("kept")).alias("before")).orderBy("part").collect()
        parts = [r["part"] for r in found]
        rows = self._parts(found)
        if keep is not None:
            rows = rows.filter(keep)
        skip = offset - found[0]["before"] if found else 0
        # the parts follow each other in the order, so the cut inside them is a top-k of their size at most
        ordered = rows.orderBy(F.col("part"), *_order(F.col(q(self.time)))).drop("part", "folder_part")
        return Page(ordered.offset(skip).limit(limit) if skip else ordered.limit(limit), parts, total)

    def page_total(self, limit: int = config.PAGE_LIMIT_DEFAULT, offset: int = 0, start_date=None,
                   end_date=None) -> DataFrame:
        """One row ``limit, offset, total_count, has_more``, from the index and
        the parts at the edges of the filter."""
        check_page_args(limit, offset)
        _, kept = self._stretch(start_date, end_date)
        return kept.agg(F.coalesce(F.sum("kept"), F.lit(0)).cast("long").alias("total_count")).select(
            F.lit(limit).alias("limit"), F.lit(offset).alias("offset"), "total_count",
            (F.lit(offset + limit) < F.col("total_count")).alias("has_more"))
