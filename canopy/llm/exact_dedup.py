"""Exact deduplication by 128-bit content hash with a byte comparison.

Rows are grouped by the MD5 of their text *and* the text itself. The hash
deals the rows out; the equality of the text inside a group is the comparison
of bytes, so two texts that share a hash stay apart. The grouping combines
copies before the shuffle: each task sends a text once however many copies it
holds, and a group that holds a third of all rows costs a task one row.

Every row then finds its group by hash and SHA-256, which together name one
text (the byte comparison above has already parted texts that share the MD5).
That join's hot keys are split by the engine's skew handling.

Defined results: a null text equals the empty text; of equal texts the row
with the largest id stays (``keep="max"``) or the smallest (``"min"``); a null
id loses to any other, and a group of null ids keeps null; rows that repeat
both id and text are all marked kept in :func:`exact_duplicates`, and
:func:`drop_exact_duplicates` leaves one of them; an empty table gives no
rows. Other columns are not read by the first and carried by the second,
whatever their names and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, text_or_empty


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(quoted(id_col)).alias("id"), text_or_empty(text_col).alias("text")).select(
        "id", "text", F.unhex(F.md5("text")).alias("hash"), F.sha2("text", 256).alias("digest"))


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "max") -> DataFrame:
    """``hash, digest, keep_id, group_size`` per distinct text."""
    best = {"max": F.max, "min": F.min}[keep]
    texts = keyed(df, id_col, text_col).groupBy("hash", "digest", "text").agg(
        best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return texts.select("hash", "digest", "keep_id", "group_size")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "max") -> DataFrame:
    """``id, keep_id, group_size, kept, digest`` for every row."""
    rows = keyed(df, id_col, text_col).select("id", "hash", "digest")
    groups = duplicate_groups(df, id_col, text_col, keep)
    return rows.join(groups, ["hash", "digest"]).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          keep: str = "max") -> DataFrame:
    """One row per distinct text, with all columns of ``df``."""
    best = {"max": F.max_by, "min": F.min_by}[keep]
    row = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns) if c != text_col])
    key = df.select(text_or_empty(text_col).alias("text"), F.col(quoted(text_col)).isNull().alias("none"),
                    F.col(quoted(id_col)).alias("id"), row.alias("row"))
    # rows that share the id are told apart by a hash of their other columns; maps and
    # variants have no hash of their own, so they are hashed as JSON
    plain = F.xxhash64("row") if hashable(key.schema["row"].dataType) else F.xxhash64(F.to_json("row"))
    order = F.struct(F.col("id").isNull() if keep == "min" else F.col("id").isNotNull(), "id", plain, "none")
    kept = key.groupBy(F.unhex(F.md5("text")).alias("hash"), "text").agg(
        best(F.struct("row", "none"), order).alias("best"))
    out = []
    for i, c in enumerate(df.columns):
        out.append((F.when(~F.col("best.none"), F.col("text")) if c == text_col
                    else F.col(f"best.row.c{i}")).alias(c))
    return kept.select(*out)
