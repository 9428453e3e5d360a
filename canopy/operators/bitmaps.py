"""Exact distinct ids by bitmaps.

``count(DISTINCT id)`` sends every id through a shuffle. Ids are dense numbers
here, so a set of them is a row of bits per bucket of 32,768 ids: each task
sets the bits of its own rows, and only buckets (4 KB each) are shuffled.
Bitmaps of parts (runs, versions, points) merge by OR, so a count over any of
them never reads the rows again. The result is exact.

Ids below 1 have buckets of their own (``bitmap_bucket_number`` is negative
there); a null id is in no bitmap, as it is in no distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, *keys: str, id_col: str = "unique_id") -> DataFrame:
    """``*keys, bucket, bits`` of the ids in ``df``."""
    return (df.filter(F.col(id_col).isNotNull())
            .groupBy(*keys, F.bitmap_bucket_number(id_col).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits")))


def merged_bitmaps(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps of equal ``keys`` and bucket joined by OR."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_ids(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """``*keys, unique_ids_count``; one row without keys, 0 for no bitmap."""
    counted = merged_bitmaps(bitmaps, *keys).select(*keys, F.bitmap_count("bits").alias("n"))
    return counted.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("unique_ids_count"))


def first_ids(bitmaps: DataFrame, limit: int, id_col: str = "unique_id") -> DataFrame:
    """The first ``limit`` distinct ids ascending: only as many buckets as can
    hold them are opened (a prefix sum over their counts)."""
    from pyspark.sql import Window
    counted = merged_bitmaps(bitmaps).select("bucket", "bits", F.bitmap_count("bits").alias("n"))
    # a row per 32,768 ids, so the running sum is over a small table
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    opened = counted.withColumn("before", F.coalesce(before, F.lit(0))).filter((F.col("before") < limit) & (F.col("n") > 0))
    position = F.explode(F.sequence(F.lit(0), F.lit(32767)))
    bit = opened.select("bucket", "bits", position.alias("p")).filter(
        F.expr("(CAST(conv(hex(substring(bits, CAST(p DIV 8 AS INT) + 1, 1)), 16, 10) AS INT) & shiftleft(1, p % 8)) <> 0"))
    # bucket 1 starts at id 1; bucket 0 and below hold the ids up to 0, counted downwards
    own = F.expr("CASE WHEN bucket > 0 THEN (bucket - 1) * 32768 + p + 1 ELSE bucket * 32768 - p END")
    return bit.select(own.cast("long").alias(id_col)).orderBy(id_col).limit(limit)
