"""Helpers shared by the operators: shipping the package to executors, cutting
Arrow batches by bytes, and free column names."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that a Python task holds at a time; a longer single text is held alone.
SLICE_BYTES = 8 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application);
    a worker on another machine has no copy of the driver's source folder."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    target = os.path.join(tempfile.mkdtemp(prefix="canopy-ship-"), f"{name}_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)


def text_or_empty(col: str | Column) -> Column:
    """The text with null counted as empty."""
    c = F.col(quoted(col)) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def quoted(name: str) -> str:
    """A column name that may hold dots or back ticks, for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def slices(arr: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """``(start, end)`` row ranges of at most ``limit`` text bytes (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def strings(arr: pa.Array) -> pa.Array:
    """A plain string array without nulls, whatever string type Spark sent."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    return pc.fill_null(arr.cast(pa.string()), "")


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # a GNU C library call; others need none


def release() -> None:
    """Hand memory that a worker no longer uses back to the machine; workers
    live on between stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def joined(parts: Iterable[pa.Array], kind: pa.DataType) -> pa.Array:
    """One array of ``parts`` (possibly none) of type ``kind``."""
    parts = list(parts)
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def hash_share(h: Column, wanted: int, rows: int) -> Column:
    """A condition that holds for about ``wanted`` of ``rows`` rows, by their
    64-bit hash alone: with it a bounded sample is cut where the rows are, and
    only what is left is ordered for the exact bound."""
    parts = 1 << 40
    return F.pmod(h, F.lit(parts)) < F.lit(parts if rows <= wanted else parts * wanted * 5 // (rows * 4))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
