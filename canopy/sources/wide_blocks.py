"""Wide tables that are kept up to date by blocks of ids.

A wide row depends on the staged rows of its own ``unique_id`` only. So the
stored table is partitioned by ``block = unique_id DIV <ids per block>``, and
when a run has added or purged rows, only the blocks of those ids are built
again; all others stay as the files they are. A daily run over a 30-day window
touches the blocks of its newest and its oldest day, whatever the window holds.

A folder is a block as long as there are ``MAX_BLOCK_FOLDERS`` of them at most;
a full build of more ids makes it twice as wide, or four times, and so on, so
that folders, files and their listings do not grow with the table. A table
that has outgrown its folders by more than twice is built anew.

* ``wide_blocks/<table>/data-<generation>/block=<b>/`` -- the rows, sorted by
  id; ``b`` counts folders of ``folder_ids`` ids. A full build writes a new generation; a refresh replaces blocks of the current one by
  dynamic partition overwrite and then removes those that came out empty.
* ``wide_blocks/<table>/meta/run=<n>/`` -- one row: the generation, what it was
  built from (points, names, kind, ids per block and folder) and the stamps of the change
  logs it has taken in. It is written last, so a refresh that broke off is done
  again over the same logs, with the same result, and a full build that broke
  off is never seen.

What has changed is known without looking at the table or the window: each
extract run logs, per point, the range of ids it added and the range its purge
took (``ChangeLog``). The staged rows of the touched ids are found by a pushed
range on ``unique_id`` and, through the kept statistics per point and day, by
the day folders that hold such ids; other folders are not opened.

A full build takes place when there is no table yet, when the points, their
names, the kind or the block size have changed, or when a log that the table
never took in is no longer kept.

As for a table that is replaced whole, a result without any row is not
written: the previous table stays current, its changes stay due.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators.wide import pivot_points, resolve_names, resolve_points
from ..plans.joins import join_small
from ..session import written
from .store import _FS, KEEP_CHANGES, StateStore

META = ("generation string, points array<string>, names array<string>, kind string, ids_per_block long, "
        "stamps array<string>, folder_ids long")


def id_ranges(rows: DataFrame) -> DataFrame:
    """``point, first_id, last_id`` of staged rows (a partial aggregate)."""
    return rows.groupBy("point").agg(F.min("unique_id").alias("first_id"), F.max("unique_id").alias("last_id"))


def folder_ids(partials: DataFrame | None, points: list[str], ids_per_block: int) -> int:
    """Ids of a folder: those of a block, doubled until the ids that the kept
    statistics know of need ``MAX_BLOCK_FOLDERS`` folders at most."""
    if partials is None:
        return ids_per_block
    lo, hi = partials.filter(F.col("point").isin(points)).agg(F.min("first_id"), F.max("last_id")).first()
    size = ids_per_block
    while lo is not None and hi // size - lo // size >= config.MAX_BLOCK_FOLDERS:
        size *= 2
    return size


def _width(meta) -> int:
    """Ids of a folder of the stored table (of a block, where it was not noted)."""
    return meta["folder_ids"] if "folder_ids" in meta else meta["ids_per_block"]


@dataclass
class Refresh:
    how: str                  # "full", "blocks" or "none"
    blocks: int = 0           # blocks rebuilt
    removed: int = 0          # blocks that came out empty
    skipped: tuple[str, ...] = ()


class BlockedWide:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/") + "/wide_blocks"
        self.fs = _FS(spark, root)

    # ------------------------------------------------------------ reading
    def _meta(self, table: str):
        store = StateStore(self.spark, f"{self.root}/{table}")
        store.path = f"{self.root}/{table}/meta"
        df, version = store.latest()
        return (None if df is None else df.first()), version, store

    def _data(self, table: str, generation: str) -> str:
        return f"{self.root}/{table}/data-{generation}"

    def read(self, table: str, unique_id: int | None = None) -> DataFrame | None:
        """The current table; with ``unique_id`` its row alone, for which one
        block folder is opened (ids are sorted inside it)."""
        meta, _, _ = self._meta(table)
        if meta is None:
            return None
        df = self.spark.read.parquet(self._data(table, meta["generation"]))
        if unique_id is not None:
            df = df.filter((F.col("block") == F.lit(unique_id // _width(meta)))
                           & (F.col("unique_id") == F.lit(unique_id)))
        return df.drop("block")

    def blocks(self, table: str) -> list[int]:
        """Blocks of the current table, listed by one call."""
        meta, _, _ = self._meta(table)
        if meta is None:
            return []
        found = self.fs.found(f"{self._data(table, meta['generation'])}/block=*")
        return sorted(int(p.rsplit("=", 1)[1]) for p in found)

    # ------------------------------------------------------------ writing
    def refresh(self, stores, manifest: DataFrame, category: str, ids_per_block: int = config.WIDE_ID_BLOCK,
                full: bool = False) -> Refresh:
        """Bring the table of ``category`` up to the staged rows of ``stores``."""
        table, kind = config.wide_table_name(category), config.join_kind(category)
        marks, _ = stores.marks.latest()
        if marks is None:
            return Refresh("none")
        resolved, skipped = resolve_points(marks, manifest, category, marks.filter("last_ts IS NOT NULL"))
        if not resolved:
            return Refresh("none", skipped=tuple(skipped))
        points = [p for p, _ in resolved]
        names = resolve_names(points, [d for _, d in resolved], kind)
        meta, version, store = self._meta(table)
        logs = stores.changes.logs()
        # one row per kept log: its stamp, which also has the run
        stamps = [] if logs is None else sorted(r["stamp"] for r in logs.select("stamp").distinct().collect())
        built = (points, names, kind, ids_per_block)
        width = folder_ids(stores.partials.latest()[0], points, ids_per_block)
        same = (meta is not None and (meta["points"], meta["names"], meta["kind"], meta["ids_per_block"]) == built
                and width <= 2 * _width(meta))
        out = Refresh("full", skipped=tuple(skipped))
        generation = uuid.uuid4().hex[:12]
        if same and not full and not self._lost(stores, meta["stamps"]):
            due = [s for s in stamps if s not in set(meta["stamps"])]
            late = self._unlogged(stores)
            out, generation, width = Refresh("blocks", skipped=tuple(skipped)), meta["generation"], _width(meta)
            if not due and late is None or not self._rebuild(stores, table, meta, logs, due, late, out):
                return Refresh("none", skipped=tuple(skipped))
        elif not self._build(stores, table, generation, (points, names, kind, width)):
            return Refresh("none", skipped=tuple(skipped))
        row = (generation, points, names, kind, ids_per_block, stamps, width)
        store.write(self.spark.createDataFrame([row], META), (version or 0) + 1)
        if meta is not None and generation != meta["generation"]:
            self._drop_generations(table, {generation, meta["generation"]})   # readers may still be at the last one
        return out

    def _lost(self, stores, taken: list[str]) -> bool:
        """Whether a log may have been removed that the table never took in:
        as many as are kept came after all that it took."""
        kept = set(stores.changes.versions())
        return len(kept) >= KEEP_CHANGES and not any(int(s.split(":")[0]) in kept for s in taken)

    def _unlogged(self, stores) -> DataFrame | None:
        """Id ranges of runs that staged rows and broke off before their log
        (the next run's log has them too)."""
        logged = stores.changes.versions()
        rows = stores.staged.read_runs_between(logged[-1], sys.maxsize) if logged else None
        return None if rows is None else id_ranges(rows)

    def _wide(self, rows: DataFrame, built) -> DataFrame:
        points, names, kind, size = built
        wide = pivot_points(rows, points, names, kind)
        return wide.withColumn("block", F.expr(f"unique_id DIV {int(size)}"))

    def _write(self, wide: DataFrame, path: str) -> None:
        """Files follow blocks and size, not tasks; ids are sorted inside."""
        (wide.hint("rebalance", "block").sortWithinPartitions("block", "unique_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block").parquet(path))

    def _build(self, stores, table: str, generation: str, built) -> bool:
        rows = stores.staged.read()
        if rows is None:
            return False
        path = self._data(table, generation)
        self._write(self._wide(rows, built), path)
        if self.fs.found(f"{path}/block=*"):
            return True
        self.fs.delete(path)
        return False

    def _rebuild(self, stores, table: str, meta, logs: DataFrame | None, due: list[str], late: DataFrame | None,
                 out: Refresh) -> bool:
        """Rebuild the touched blocks; ``False`` when the table would be empty."""
        size = _width(meta)
        ranges = [] if logs is None else [logs.filter(F.col("stamp").isin(due)).select("point", "first_id", "last_id")]
        ranges += [] if late is None else [late]
        touched = written(reduce(DataFrame.unionByName, ranges).filter(F.col("point").isin(meta["points"])).select(
            F.explode(F.expr(f"sequence(first_id DIV {size}, last_id DIV {size})")).alias("block")).distinct(),
            "touched-blocks")
        if touched.isEmpty():
            return True                                    # other points' news: nothing to do, logs are taken in
        rows = changed_rows(stores, touched, size, meta["points"])
        built = (meta["points"], meta["names"], meta["kind"], size)
        path = self._data(table, meta["generation"])
        before = {int(p.rsplit("=", 1)[1]): p for p in self.fs.found(f"{path}/block=*")}
        hit = {r["block"] for r in touched.toLocalIterator()} & set(before)   # a number a block
        wide = written(self._wide(rows, built), "rebuilt-blocks")
        after = {r["block"] for r in wide.select("block").distinct().collect()}
        if not after and hit == set(before):
            return False
        if after:
            self._write(wide, path)
        for gone in hit - after:
            self.fs.delete(before[gone])
        out.blocks, out.removed = len(after), len(hit - after)
        return True

    def _drop_generations(self, table: str, keep: set[str]) -> None:
        for p in self.fs.found(f"{self.root}/{table}/data-*"):
            if p.rsplit("data-", 1)[1] not in keep:
                self.fs.delete(p)


def spans(blocks: list[int], size: int) -> list[tuple[int, int]]:
    """Neighbouring blocks as ranges of ids, ends included."""
    out: list[list[int]] = []
    for b in sorted(blocks):
        if out and b == out[-1][1] + 1:
            out[-1][1] = b
        else:
            out.append([b, b])
    return [(a * size, (b + 1) * size - 1) for a, b in out]


def changed_rows(stores, touched: DataFrame, size: int, points: list[str]) -> DataFrame:
    """Staged rows of ``points`` in the ``touched`` blocks: day folders by the
    kept statistics, row groups by a pushed range of ids."""
    count, lo, hi = touched.agg(F.count(F.lit(1)), F.min("block"), F.max("block")).first()
    whole = [(lo * size, (hi + 1) * size - 1)]
    listed = [r["block"] for r in touched.collect()] if count <= config.MAX_LISTED_BLOCKS else None
    exact = whole if listed is None else spans(listed, size)
    ranges = exact if len(exact) <= config.MAX_ID_RANGES else whole

    def within(first: str, last: str) -> Column:
        return reduce(lambda a, b: a | b, [(F.col(first) <= F.lit(b)) & (F.col(last) >= F.lit(a)) for a, b in ranges])

    partials, _ = stores.partials.latest()
    days = [r["day"] for r in partials.filter(F.col("point").isin(points) & within("first_id", "last_id"))
            .select("day").distinct().collect()]           # of the retained window
    rows = stores.staged.read(days=days)
    if rows is None:
        kind = partials.schema["first_ts"].dataType.simpleString()
        rows = touched.sparkSession.createDataFrame([], f"point string, unique_id long, ts {kind}, value double")
    rows = rows.filter(F.col("point").isin(points) & within("unique_id", "unique_id"))
    if ranges != exact or listed is None:
        rows = join_small(rows.withColumn("block", F.expr(f"unique_id DIV {size}")), touched, "block", "left_semi",
                          count).drop("block")
    return rows
