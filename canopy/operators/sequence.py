"""Per-key sequence numbering (``row_number`` by time), safe for hot keys.

``row_number() OVER (PARTITION BY point ORDER BY ts, ...)`` sorts every point
in one task. When one point holds a large share of all rows that task gets it
all. Keys with more than ``max_rows_per_task`` rows (found by a partial
aggregate, which costs a hot key nothing in the shuffle) are numbered by a
distributed sort instead:

1. their rows are range-partitioned by key, time and tie-break columns, into
   parts of about half of ``max_rows_per_task`` rows, and written with the
   number of their part to the shared scratch folder. The bounds of the parts
   come from a sample of the rows, so a burst, a clock that is years off, many
   equal times (split by the tie-break) or many missing ones (split likewise)
   give parts of the same size;
2. a count per key and part, and its running sum, give each part its offset (a
   key has about ``2 n / max_rows_per_task`` parts);
3. within a key and part, ``row_number`` plus that offset is the number.

Because the parts are written once, their counts and their rows are the same
rows, whatever happens to an executor. Nothing is collected, and joins with
the hot keys and the offsets are planned by measured size.

When no key is hot (the usual case) the plan is the plain single window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..session import written


def _order(ts: str, tiebreak, descending: bool) -> list[Column]:
    first = F.col(ts).desc_nulls_last() if descending else F.col(ts).asc_nulls_first()
    return [first] + [F.col(c).asc_nulls_first() for c in tiebreak]


def assign_sequence(df: DataFrame, keys, ts: str, tiebreak=(), out: str = "unique_id",
                    base: str | Column | None = None, descending: bool = False,
                    max_rows_per_task: int | None = None) -> DataFrame:
    """Add ``out`` = 1..n per key in ``(ts, *tiebreak)`` order, plus ``base``.

    ``keys``: column name(s) to number within (``[]`` numbers the whole frame).
    ``tiebreak``: columns completing a total order (ties in ``ts`` are not
    left to chance).  ``base``: a per-row long column added to the number
    (the stored last id of the key).  ``descending``: order by ``ts`` desc
    (nulls last) instead of asc (nulls first).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    whole = not keys
    if whole:  # number the whole frame: one constant key
        df = df.withColumn("_seq_k", F.lit(0))
        keys = ["_seq_k"]
    limit = max_rows_per_task or config.MAX_ROWS_PER_SEQUENCE_TASK
    base_col = (F.lit(0) if base is None else
                (F.col(base) if isinstance(base, str) else base))
    order = _order(ts, list(tiebreak), descending)

    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_seq_n")).filter(F.col("_seq_n") > limit)
    rows = hot.agg(F.sum("_seq_n")).first()[0]
    if not rows:
        w = Window.partitionBy(*keys).orderBy(*order)
        res = df.withColumn(out, (F.row_number().over(w) + base_col).cast("long"))
    else:
        hot = written(hot, "hot-keys")
        cold = _match(df, hot, keys, "left_anti")
        w = Window.partitionBy(*keys).orderBy(*order)
        plain = cold.withColumn(out, (F.row_number().over(w) + base_col).cast("long"))
        res = plain.unionByName(_number_parts(_match(df, hot, keys, "left_semi"), keys, order, out, base_col,
                                              -(-2 * rows // limit)))
    return res.drop("_seq_k") if whole else res


def range_parts(df: DataFrame, keys: list[str], order: list[Column], parts: int) -> DataFrame:
    """The rows, written, with the number ``_seq_p`` of their part in sort order."""
    ranged = df.repartitionByRange(int(parts), *[F.col(k) for k in keys], *order)
    return written(ranged.withColumn("_seq_p", F.spark_partition_id()), "sequence-parts")


def _number_parts(df: DataFrame, keys: list[str], order: list[Column], out: str, base: Column,
                  parts: int) -> DataFrame:
    ranged = range_parts(df, keys, order, parts)
    counts = ranged.groupBy(*keys, "_seq_p").agg(F.count(F.lit(1)).alias("_seq_c"))
    before = Window.partitionBy(*keys).orderBy("_seq_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_seq_p", F.coalesce(F.sum("_seq_c").over(before), F.lit(0)).alias("_seq_o"))
    inside = Window.partitionBy(*keys, "_seq_p").orderBy(*order)
    numbered = ranged.withColumn(out, F.row_number().over(inside))
    res = _match(numbered, offsets, [*keys, "_seq_p"], "left")
    return res.withColumn(out, (F.col(out) + F.col("_seq_o") + base).cast("long")).drop("_seq_p", "_seq_o")


def _match(df: DataFrame, side: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Null-safe join on ``keys``; the side's key columns are dropped."""
    named = side.select(*[F.col(k).alias(f"_m_{k}") for k in keys], *[c for c in side.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
    return df.join(named, on, how).drop(*[f"_m_{k}" for k in keys])

