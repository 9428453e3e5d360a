"""Stored tables on the shared file system (Parquet), written by Spark.

Layouts (all below one root folder):

* ``staged/run=<id>/day=<yyyy-mm-dd>/part-*`` -- the long staged telemetry.
  A run (batch job or stream micro-batch) writes its own ``run`` partition
  with dynamic partition overwrite, so a replayed run rewrites exactly its
  own files (idempotent).  Readers can ask for the rows of runs before a given
  id, which is what makes a replayed micro-batch number its rows the same way.
  Retention drops whole ``day`` partitions older than the cutoff -- a
  metadata operation, no rewrite (the cutoff is always a midnight); only a
  day folder that also holds points outside the run's manifest is rewritten.
* ``state/run=<id>/`` -- one full snapshot of the per-point run state per
  run; the newest complete snapshot is current.  A new snapshot never
  overwrites the folder it was computed from; the newest few are kept, so that
  a replayed run finds the one before it.
* ``marks/run=<id>/`` -- per-point ``last_ts`` (newest reading ever staged)
  and ``retained_from`` (retention cutoff honoured by the store), so a run
  knows every point's high-water mark without scanning the staged table.
* ``partials/run=<id>/`` -- per point and day the counts, bounds and exact sum
  of what is retained (``operators.partials``), folded on with every run.
* ``changes/run=<id>/`` -- per point the ids that a run added and that its purge
  took away, for tables that are kept up to date (``sources.wide_blocks``).
* ``wide/<table>/run=<id>/`` -- one version per transform run; versions that
  came out empty are removed again, so the previous table stays current
  (skip-on-empty); the newest few are kept for readers that have begun.
* ``writers/<writer>/<key>/run=<id>`` -- empty folders that hold which writer
  was given which run id. A writer that repeats a key gets the id it had; a new
  id is always newer than every other, so no two writers share one.
* ``pending/run=<id>/`` -- source rows that a stream has read but that lie
  after its run's upper bound; the next micro-batch takes them up.
* ``_scratch/`` -- tables that are moved in place by a rename; below the root,
  so that the rename stays on one file system.
* CSV exports: ``<export>/<table>_<yyyymmdd_HHMMSS>/`` (a folder of parts,
  header row, never overwritten).

Directory listing and deletes use the Hadoop FileSystem of the session, so
the same code runs on HDFS, object stores or a local disk.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import STAGED_COLUMNS


class _FS:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._Path(root).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return bool(self.fs.exists(self._Path(path)))

    def children(self, path: str) -> list[str]:
        p = self._Path(path)
        if not self.fs.exists(p):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(p) if s.isDirectory()]

    def found(self, pattern: str) -> list[str]:
        """Paths that match a glob pattern, by one call."""
        got = self.fs.globStatus(self._Path(pattern))
        return [] if got is None else [s.getPath().toString() for s in got]

    def make(self, path: str) -> None:
        self.fs.mkdirs(self._Path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._Path(path), True)

    def rename(self, src: str, dst: str) -> None:
        parent = self._Path(dst).getParent()
        if not self.fs.exists(parent):
            self.fs.mkdirs(parent)
        if not self.fs.rename(self._Path(src), self._Path(dst)):
            raise OSError(f"rename failed: {src} -> {dst}")


#: Times in CSV exports.
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
#: Versions of a snapshot that are kept, versions of a wide table, run ids per
#: writer, and change logs.
KEEP_SNAPSHOTS = 8
KEEP_WIDE = 3
KEEP_CLAIMS = 8
KEEP_CHANGES = 400


def complete_runs(fs: _FS, path: str) -> list[int]:
    """Runs whose folder below ``path`` was written to the end, by one call."""
    return sorted(int(p.rsplit("/", 2)[1][4:]) for p in fs.found(f"{path}/run=*/_SUCCESS"))


def prune(fs: _FS, path: str, keep: int) -> None:
    for run in _runs(fs, path)[:-keep]:
        fs.delete(f"{path}/run={run}")


def _runs(fs: _FS, path: str) -> list[int]:
    out = []
    for name in fs.children(path):
        if name.startswith("run="):
            try:
                out.append(int(name[4:]))
            except ValueError:
                pass
    return sorted(out)


class RunIds:
    """Run ids given out to the writers of one store (one job at a time writes
    to a store, as the numbering of ids already asks)."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.path = self.root + "/writers"
        self.fs = _FS(spark, root)

    def _given(self) -> dict[int, str]:
        out = {}
        for p in self.fs.found(f"{self.path}/*/*/run=*"):
            writer, key, run = p.rsplit("/", 3)[1:]
            out[int(run[4:])] = f"{writer}/{key}"
        return out

    def claim(self, writer: str, key: str, wanted: int | None = None) -> int:
        """The run id of ``key`` of ``writer``: the one it already has, else
        ``wanted`` or the next free one. A wanted id that another writer has, or
        that is older than an id in use, is refused."""
        name = f"{re.sub('[^A-Za-z0-9_.-]', '_', writer)}/{re.sub('[^A-Za-z0-9_.-]', '_', key)}"
        given = self._given()
        for run, owner in given.items():
            if owner == name:
                return run
        used = set(given)
        for kind in ("staged", "state", "marks"):
            used.update(_runs(self.fs, f"{self.root}/{kind}"))
        newest = max(used, default=-1)
        run = newest + 1 if wanted is None else wanted
        if run <= newest:
            raise ValueError(f"run id {run} of {name} is not newer than {newest}, "
                             f"which {given.get(newest, 'an earlier version')} has written")
        self.fs.make(f"{self.path}/{name}/run={run}")
        mine = name.split("/")[0] + "/"   # older ids of this writer are replayed no more
        for old in sorted(r for r, owner in given.items() if owner.startswith(mine))[:-(KEEP_CLAIMS - 1)]:
            self.fs.delete(f"{self.path}/{given[old]}")
        return run


class StagedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, root.rstrip("/") + "/staged"
        self.root = root.rstrip("/")
        self.fs = _FS(spark, root)
        self.recover()

    def scratch(self, name: str) -> str:
        """A fresh folder below the store's root."""
        return f"{self.root}/_scratch/{name}-{uuid.uuid4().hex[:12]}"

    def recover(self) -> None:
        """End a purge that broke off between its two renames: a day that was
        moved aside goes back unless its new version is already in place."""
        for aside in self.fs.found(f"{self.path}/run=*/_purging_day=*"):
            target = aside.replace("/_purging_day=", "/day=")
            if self.fs.exists(target):
                self.fs.delete(aside)
            else:
                self.fs.rename(aside, target)

    def days(self) -> list[tuple[int, str]]:
        """``(run, day)`` of every day partition, listed by one call."""
        out = []
        for p in self.fs.found(f"{self.path}/run=*/day=*"):
            run, day = p.rsplit("/", 2)[1:]
            out.append((int(run[4:]), day[4:]))
        return sorted(out)

    def runs(self) -> list[int]:
        """Runs that still hold at least one day partition."""
        return sorted({r for r, _ in self.days()})

    def read(self, before_run: int | None = None, days: list[dt.date] | None = None,
             before_day: dt.date | None = None) -> DataFrame | None:
        """Staged rows (of runs ``< before_run``, of the listed days, of days
        before one, if given: folders of others are not opened); ``None`` if empty."""
        runs = [r for r in self.runs() if before_run is None or r < before_run]
        if not runs:
            return None
        df = self.spark.read.option("basePath", self.path).parquet(self.path)
        if before_run is not None:
            df = df.filter(F.col("run") < F.lit(before_run))
        if days is not None:
            df = df.filter(F.col("day").isin(days))
        if before_day is not None:
            df = df.filter(F.col("day") < F.lit(before_day))
        return df.select(*STAGED_COLUMNS)

    def read_runs_between(self, after: int, before: int) -> DataFrame | None:
        """Rows of runs ``after < run < before`` (partition-pruned); ``None``
        when there are none."""
        if not [r for r in self.runs() if after < r < before]:
            return None
        return (self.spark.read.option("basePath", self.path).parquet(self.path)
                .filter((F.col("run") > F.lit(after)) & (F.col("run") < F.lit(before)))
                .select(*STAGED_COLUMNS))

    def read_run(self, run_id: int) -> DataFrame:
        return (self.spark.read.option("basePath", self.path).parquet(self.path)
                .filter(F.col("run") == F.lit(run_id)).select(*STAGED_COLUMNS))

    def write_run(self, rows: DataFrame, run_id: int) -> None:
        """Write one run's rows in place of what the run wrote before (a replay
        may hold fewer days). Rows are dealt by day into files of the advisory
        size, so their number follows the days and the size, not the tasks."""
        out = (rows.select(*STAGED_COLUMNS)
               .withColumn("run", F.lit(run_id).cast("long"))
               .withColumn("day", F.to_date("ts"))
               .hint("rebalance", "day")
               .sortWithinPartitions("day", "point", "ts"))
        self.fs.delete(f"{self.path}/run={run_id}")
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", "day").parquet(self.path))

    def purge_before(self, cutoff: dt.date, points: DataFrame | None = None) -> int:
        """Retention: remove rows with ``day < cutoff``. Without ``points`` every
        old ``day`` folder is dropped (metadata only). With ``points`` (the run's
        manifest) only those points are purged: an old folder that holds nothing
        else is dropped; one that also holds other points is rewritten with just
        their rows (by one Spark job below the store's root, then moved in
        place; the old folder is moved aside first and :meth:`recover` moves it
        back if the job ends in between). Returns the number of folders removed
        or rewritten."""
        old = [(r, d) for r, d in self.days() if d < cutoff.isoformat()]
        if not old:
            return 0
        keep_parts: set[tuple[int, str]] = set()
        scratch = self.scratch("purge")
        if points is not None:
            rows = (self.spark.read.option("basePath", self.path).parquet(self.path)
                    .filter(F.col("day") < F.lit(cutoff)))
            keep = rows.join(points.select("point").distinct(), "point", "left_anti")
            (keep.select(*STAGED_COLUMNS, "run", "day").hint("rebalance", "run", "day")
             .sortWithinPartitions("day", "point", "ts").write.partitionBy("run", "day").parquet(scratch))
            for p in self.fs.found(f"{scratch}/run=*/day=*"):
                run, day = p.rsplit("/", 2)[1:]
                keep_parts.add((int(run[4:]), day[4:]))
        for r, d in old:
            target = f"{self.path}/run={r}/day={d}"
            if (r, d) in keep_parts:
                aside = f"{self.path}/run={r}/_purging_day={d}"
                self.fs.rename(target, aside)
                self.fs.rename(f"{scratch}/run={r}/day={d}", target)
                self.fs.delete(aside)
            else:
                self.fs.delete(target)
        self.fs.delete(scratch)
        for r in set(_runs(self.fs, self.path)) - set(self.runs()):   # runs with nothing left
            self.fs.delete(f"{self.path}/run={r}")
        return len(old)


class PendingStore:
    """Source rows that wait for a later run: everything that was still pending
    after a run, so a replayed run finds what it found before."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, root.rstrip("/") + "/pending"
        self.fs = _FS(spark, root)

    def version(self, before_run: int | None = None) -> int | None:
        vs = [r for r in complete_runs(self.fs, self.path) if before_run is None or r < before_run]
        return vs[-1] if vs else None

    def read(self, before_run: int | None = None) -> DataFrame | None:
        v = self.version(before_run)
        return None if v is None else self.spark.read.parquet(f"{self.path}/run={v}")

    def write(self, rows: DataFrame, run_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/run={run_id}")
        prune(self.fs, self.path, 3)   # a replay needs the one before it


class StateStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, root.rstrip("/") + "/state"
        self.fs = _FS(spark, root)

    def versions(self) -> list[int]:
        return complete_runs(self.fs, self.path)

    def read(self, before_run: int | None = None) -> DataFrame | None:
        vs = [v for v in self.versions() if before_run is None or v < before_run]
        if not vs:
            return None
        return self.spark.read.parquet(f"{self.path}/run={vs[-1]}")

    def latest(self, before_run: int | None = None) -> tuple[DataFrame | None, int | None]:
        """The newest snapshot (before a run) and the run that wrote it."""
        vs = [v for v in self.versions() if before_run is None or v < before_run]
        if not vs:
            return None, None
        return self.spark.read.parquet(f"{self.path}/run={vs[-1]}"), vs[-1]

    def write(self, state: DataFrame, run_id: int) -> None:
        state.write.mode("overwrite").parquet(f"{self.path}/run={run_id}")
        prune(self.fs, self.path, KEEP_SNAPSHOTS)


class PartialsStore(StateStore):
    """Kept statistics per point and day (``operators.partials``)."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.path = root.rstrip("/") + "/partials"


class ChangeLog(StateStore):
    """``point, first_id, last_id, stamp`` per run: ids that it added or purged.
    A replayed run writes its log anew, under another stamp."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.path = root.rstrip("/") + "/changes"

    def write(self, ranges: DataFrame, run_id: int) -> None:
        stamped = ranges.withColumn("stamp", F.lit(f"{run_id}:{uuid.uuid4().hex[:12]}"))
        stamped.write.mode("overwrite").parquet(f"{self.path}/run={run_id}")
        prune(self.fs, self.path, KEEP_CHANGES)

    def logs(self) -> DataFrame | None:
        """All kept logs, with their ``run``."""
        if not self.versions():
            return None
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/run=*")


class MarksStore(StateStore):
    """Per-point high-water marks ``point, last_ts, retained_from`` (one
    snapshot per run): the newest reading ever staged for the point and the
    retention cutoff applied to the store.  The high-water mark of the staged
    rows is then ``last_ts`` when ``last_ts >= retained_from`` (else every row
    of the point was purged) -- exact, without scanning the staged table."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.path = root.rstrip("/") + "/marks"


class WideStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, root.rstrip("/") + "/wide"
        self.fs = _FS(spark, root)

    def tables(self) -> list[str]:
        return sorted(self.fs.children(self.path))

    def read(self, table: str) -> DataFrame | None:
        vs = complete_runs(self.fs, f"{self.path}/{table}")
        if not vs:
            return None
        return self.spark.read.parquet(f"{self.path}/{table}/run={vs[-1]}")

    def replace(self, table: str, df: DataFrame | None, run_id: int) -> int:
        """Write a new version; an empty (or absent) result is dropped again
        and the previous version stays current.  Returns the rows written.
        Files are sorted by time, and the ids of a ragged table are spread over
        them, so ids have Bloom filters: a look-up by id skips the row groups
        that its bounds cannot exclude."""
        if df is None:
            return 0
        target = f"{self.path}/{table}/run={run_id}"
        (df.write.mode("overwrite").option("parquet.bloom.filter.enabled#unique_id", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(target))
        n = self.spark.read.parquet(target).count()
        if n == 0:
            self.fs.delete(target)
        else:
            prune(self.fs, f"{self.path}/{table}", KEEP_WIDE)
        return n

    def export_csv(self, table: str, export_root: str, when: dt.datetime) -> str | None:
        """CSV copy of the current version, header row, timestamped folder; times
        with all their digits."""
        df = self.read(table)
        if df is None:
            return None
        target = f"{export_root.rstrip('/')}/{table}_{when.strftime('%Y%m%d_%H%M%S')}"
        (df.write.mode("errorifexists").option("header", True)
         .option("timestampNTZFormat", CSV_TIME).option("timestampFormat", CSV_TIME).csv(target))
        return target
