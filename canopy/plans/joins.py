"""Join helpers that only broadcast a side whose size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               small_rows: int | None = None,
               max_bytes: int = config.MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with a per-point (manifest-sized) ``small`` side.

    The broadcast hint is given only when the caller knows the row count of
    the small side and rows times row width stay under ``max_bytes``; otherwise the planner and AQE
    decide from measured sizes (sort-merge join with skew splitting beyond
    the broadcast threshold).
    """
    if small_rows is not None and small_rows * row_width(small) <= max_bytes:
        small = F.broadcast(small)
    return big.join(small, on, how)


def row_width(df: DataFrame) -> int:
    """Bytes of a row of names, numbers and times in memory, generously."""
    return 32 + sum(config.NAME_BYTES if isinstance(f.dataType, T.StringType) else 16 for f in df.schema.fields)
