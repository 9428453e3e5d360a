"""Manifests: which points to pull (by biome) and which points form each
wide-table category (row order = alignment order).

Both are small configuration files (CSV with a header row). The header names
the columns, all are read as text by that explicit schema, and no row is taken
without a word: a row with too few or too many fields, or without the name it
is read for, is a *reject*, returned beside the rows that are good. Files are
read whole, so a row's place is its place in its file (files in order of their
paths), however large the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import normalise_point

POINT_MANIFEST_SCHEMA = "point string, biome string"
CATEGORY_MANIFEST_SCHEMA = "category string, point string, ord int"
_CORRUPT = "_corrupt_record"
_QUOTED = '"(?:[^"]|"")*"'


def read_rows(spark: SparkSession, path: str, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of a manifest file or folder. ``good`` has the
    ``needed`` columns, ``file`` and ``place`` (row order inside the file);
    ``rejects`` has ``file, place, record, fields, expected``."""
    files = spark.read.option("header", True).option("recursiveFileLookup", True)   # folder names are no columns
    header = files.csv(path).columns
    missing = [c for c in needed if c not in header]
    if missing:
        raise ValueError(f"manifest has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
    raw = (files.schema(schema).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _CORRUPT)
           .option("columnPruning", False)   # else only the fields that are asked for are counted
           .option("multiLine", True)        # a file is read by one task, in its order
           .csv(path))
    rows = raw.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"))
    named = [F.col(_q(c)) for c in needed]
    bad = F.col(_CORRUPT).isNotNull()
    for c in named:
        bad = bad | c.isNull() | (F.trim(c) == "")
    line = F.coalesce(_CORRUPT, F.concat_ws(",", *[F.coalesce(F.col(_q(c)), F.lit("")) for c in header]))
    rejects = rows.filter(bad).select("file", "place", F.rtrim(line, F.lit("\r\n")).alias("record"), fields(line).alias("fields"),
                                      F.lit(len(header)).alias("expected"))
    return rows.filter(~bad).select(*named, "file", "place"), rejects


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fields(line: Column) -> Column:
    """Fields of a CSV line: commas outside quotes, plus one."""
    return F.size(F.split(F.regexp_replace(line, _QUOTED, ""), ",", -1))


def point_manifest_rows(spark: SparkSession, path: str, biome: str, biome_col: str = "BIOMNAME",
                        table_col: str = "TABLE_NAME") -> tuple[DataFrame, DataFrame]:
    """``(points, rejects)``: ``point, biome`` of one biome, and all rows that
    could not be taken."""
    good, rejects = read_rows(spark, path, [biome_col, table_col])
    points = good.filter(F.col(_q(biome_col)) == F.lit(biome)).select(
        F.col(_q(table_col)).alias("point"), F.col(_q(biome_col)).alias("biome"))
    return points, rejects


def point_manifest(spark: SparkSession, path: str, biome: str,
                   biome_col: str = "BIOMNAME", table_col: str = "TABLE_NAME") -> DataFrame:
    """Points of one biome. A file that is missing, unreadable, lacks a column
    or has a row with too many fields is refused as a whole: the frame is
    empty, and the run then has nothing to do. Rows with too few fields are
    left out; :func:`point_manifest_rows` returns them."""
    try:
        points, rejects = point_manifest_rows(spark, path, biome, biome_col, table_col)
        if rejects.filter("fields > expected").isEmpty():
            return points
    except Exception:  # missing path, unreadable file, no such column
        pass
    return spark.createDataFrame([], POINT_MANIFEST_SCHEMA)


def category_manifest_rows(spark: SparkSession, path: str, id_col: str = "Id",
                           table_col: str = "Table Name") -> tuple[DataFrame, DataFrame]:
    """``(category, point, ord)`` and the rejects. ``ord`` counts the good rows
    of a category in the order of the file (the first is its base point)."""
    good, rejects = read_rows(spark, path, [id_col, table_col])
    in_order = Window.partitionBy(_q(id_col)).orderBy("file", "place")   # a category's rows, a manifest's share
    rows = good.withColumn("ord", F.row_number().over(in_order).cast("int"))
    return rows.select(F.col(_q(id_col)).alias("category"), normalise_point(_q(table_col)).alias("point"), "ord"), rejects


def category_manifest(spark: SparkSession, path: str, id_col: str = "Id",
                      table_col: str = "Table Name") -> DataFrame:
    """``category, point, ord`` of the good rows."""
    return category_manifest_rows(spark, path, id_col, table_col)[0]


def manifest_from_rows(spark: SparkSession, rows: list[tuple[str, str, int]]) -> DataFrame:
    """A category manifest from literal rows (tests and examples)."""
    return spark.createDataFrame(rows, CATEGORY_MANIFEST_SCHEMA)
