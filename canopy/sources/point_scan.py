"""One scan over the source series of all points, with an error side.

``point_series`` is a Python data source: its partitions are slices of
``(point, time range)``, bundled so that their number does not follow the
number of points, and each slice is opened where it is read, on an executor.
The driver opens nothing, builds no frame per point, and the plan has one scan
whatever the number of points.

A point whose series cannot be opened, lacks a column, or breaks while being
read does not fail the job: its slice ends in an error row, and
:func:`scan_points` parts the readings of healthy points from the errors. The
rows that a failed point gave before it broke are left out with it, also those
of its other slices, so a run never stages half a point. (An error row's ``ts``
is the first instant its slice was asked for, so it obeys the scan's filters.)

Filters on ``ts`` and ``point`` are taken over by the scan (``pushFilters``):
slices that cannot match are never dealt out, and the rest is handed to the
opener of the series as bounds. ``starts`` gives every point its own lower
bound besides.

Series are read by an *opener*: ``open_series(location, lower, upper, columns)``
yields Arrow batches of ``columns`` with ``lower < ts < upper`` (``None``: no
bound). The one for Parquet folders is here; any other function of that form,
such as one that asks a database through its driver, can be given.
"""

from __future__ import annotations

import base64
import datetime as dt
import json
import pickle
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual)

from ..functions.names import normalise_point
from ..session import written

# executors get the classes and functions of this module themselves, so they
# need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of an error that are kept.
ERROR_CHARS = 500
_TYPES = {"timestamp_ntz": pa.timestamp("us"), "timestamp": pa.timestamp("us", tz="UTC"), "double": pa.float64(),
          "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def open_parquet(location: str, lower, upper, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of a Parquet file or folder on any file system that Arrow can
    open by its URI; bounds on the first column prune row groups."""
    import pyarrow.dataset as ds
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(location) if "://" in location or location.startswith("file:") else (
        fs.LocalFileSystem(), location)
    data = ds.dataset(path, filesystem=system, format="parquet")
    names = {n.lower(): n for n in data.schema.names}
    missing = [c for c in columns if c.lower() not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    own = [names[c.lower()] for c in columns]
    kind = data.schema.field(own[0]).type
    keep = ds.field(own[0]).is_valid()
    for bound, op in ((lower, "__gt__"), (upper, "__lt__")):
        if bound is not None:
            zoned = bound.replace(tzinfo=dt.timezone.utc) if getattr(kind, "tz", None) else bound
            keep = keep & getattr(ds.field(own[0]), op)(pa.scalar(zoned, kind))
    for batch in data.to_batches(columns=own, filter=keep):
        yield batch


class PointSeries(DataSource):
    """Options: ``series`` (JSON list of ``[point, location, start or null]``),
    ``columns`` (names in the series; the first two are time and value),
    ``schema`` (of the rows, besides point and error), ``opener`` (a pickled
    function), ``cuts`` (JSON list of times at which every series is cut into
    slices) and ``tasks``."""

    @classmethod
    def name(cls) -> str:
        return "point_series"

    def schema(self) -> str:
        return f"point string, {self.options['schema']}, error string"

    def reader(self, schema) -> PointReader:
        return PointReader(self.options)


class PointReader(DataSourceReader):
    def __init__(self, options):
        self.columns = json.loads(options["columns"])
        self.kinds = [part.rsplit(" ", 1) for part in options["schema"].split(", ")]
        self.opener = options.get("opener")
        self.tasks = int(options.get("tasks") or 64)
        self.series = [(p, at, None if s is None else dt.datetime.fromisoformat(s))
                       for p, at, s in json.loads(options["series"])]
        self.cuts = sorted(dt.datetime.fromisoformat(c) for c in json.loads(options.get("cuts") or "[]"))
        self.lower: dt.datetime | None = None     # exclusive
        self.upper: dt.datetime | None = None     # exclusive
        self.only: set[str] | None = None

    def pushFilters(self, filters):
        """Bounds on ``ts`` and lists of points; the rest stays with Spark."""
        tick = dt.timedelta(microseconds=1)
        for f in filters:
            if getattr(f, "attribute", None) == ("ts",) and isinstance(getattr(f, "value", None), dt.datetime):
                # times are compared without a zone; a zoned one is given in UTC
                v = f.value.astimezone(dt.timezone.utc).replace(tzinfo=None) if f.value.tzinfo else f.value
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    v = v if isinstance(f, GreaterThan) else v - tick
                    self.lower = v if self.lower is None else max(self.lower, v)
                    continue
                if isinstance(f, (LessThan, LessThanOrEqual)):
                    v = v if isinstance(f, LessThan) else v + tick
                    self.upper = v if self.upper is None else min(self.upper, v)
                    continue
            if getattr(f, "attribute", None) == ("point",) and isinstance(f, (EqualTo, In)):
                these = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = these if self.only is None else self.only & these
                continue
            if isinstance(f, IsNotNull) and f.attribute in (("point",), ("ts",)):
                continue                          # no row lacks them
            yield f

    def partitions(self) -> list[InputPartition]:
        """Each holds the ``(point, location, lower, upper)`` that one task reads."""
        slices = []
        edges = [None, *self.cuts, None]
        tick = dt.timedelta(microseconds=1)
        for point, at, start in self.series:
            if self.only is not None and point not in self.only:
                continue
            least = max((b for b in (start, self.lower) if b is not None), default=None)
            for lo, hi in zip(edges[:-1], edges[1:]):        # lo <= ts < hi
                low = max((b for b in (least, None if lo is None else lo - tick) if b is not None), default=None)
                high = min((b for b in (hi, self.upper) if b is not None), default=None)
                if low is None or high is None or low + tick < high:
                    slices.append((point, at, low, high))
        dealt = [slices[k::self.tasks] for k in range(min(self.tasks, len(slices)))]
        return [InputPartition(parts) for parts in dealt] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        open_series = pickle.loads(base64.b64decode(self.opener)) if self.opener else open_parquet
        tick = dt.timedelta(microseconds=1)
        kinds = [_TYPES[k] for _, k in self.kinds]
        names = ["point", *[n for n, _ in self.kinds], "error"]
        for point, at, lower, upper in partition.value:
            try:
                for batch in open_series(at, lower, upper, self.columns):
                    rows = [c.cast(k) for c, k in zip(batch.columns, kinds)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([point] * batch.num_rows, pa.string()), *rows, pa.nulls(batch.num_rows, pa.string())],
                        names=names)
            except Exception as error:  # whatever the opener meets: the point fails, not the job
                said = f"{type(error).__name__}: {error}".split("\n")[0][:ERROR_CHARS]
                first = lower + tick if lower is not None else upper - tick if upper is not None else dt.datetime(1970, 1, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([point], pa.string()), pa.array([first], pa.timestamp("us")).cast(kinds[0]),
                     *[pa.nulls(1, k) for k in kinds[1:]], pa.array([said], pa.string())], names=names)


def scan_points(spark: SparkSession, series: dict[str, str], schema: str = "ts timestamp, value double",
                columns: list[str] | None = None, opener: Callable | None = None,
                starts: dict[str, dt.datetime] | None = None, lower: dt.datetime | None = None,
                upper: dt.datetime | None = None, cuts: list[dt.datetime] | None = None,
                tasks: int = 64) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)`` of the points in ``series`` (point -> location):
    readings ``point, <schema>`` with ``lower < ts < upper`` and after the
    point's own start, and ``point, error`` of the points that failed (one row
    each). The series are read once, into the shared scratch folder; both sides
    are read from there.

    ``schema``: time and value first, then further columns; ``columns``: their
    names in the series, if others. ``starts`` is by normalised point name
    (``plans.runner.point_starts``). Readings without a time are left out.
    """
    names = [part.rsplit(" ", 1)[0] for part in schema.split(", ")]
    if names[:2] != ["ts", "value"]:
        raise ValueError("schema must begin with ts and value")
    spark.dataSource.register(PointSeries)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")   # off by default; this source asks for it
    own = {k.strip().lower(): v for k, v in (starts or {}).items()}
    listed = [[p, at, None if (s := own.get(p.strip().lower())) is None else s.isoformat()]
              for p, at in sorted(series.items())]
    df = (spark.read.format("point_series").option("series", json.dumps(listed)).option("schema", schema)
          .option("columns", json.dumps(columns or names))
          .option("opener", "" if opener is None else base64.b64encode(cloudpickle.dumps(opener)).decode())
          .option("cuts", json.dumps([c.isoformat() for c in cuts or []])).option("tasks", str(tasks)).load())
    kind = df.schema["ts"].dataType
    failed = F.col("error").isNotNull()
    if lower is not None:
        df = df.filter(F.col("ts") > F.lit(lower.isoformat(sep=" ")).cast(kind))
    if upper is not None:
        df = df.filter(F.col("ts") < F.lit(upper.isoformat(sep=" ")).cast(kind))
    read = written(df, "point-scan")
    errors = read.filter(failed).groupBy(normalise_point("point").alias("point")).agg(F.min("error").alias("error"))
    rows = read.filter(~failed).drop("error").withColumn("point", normalise_point("point"))
    return rows.join(errors.select("point"), "point", "left_anti"), errors
