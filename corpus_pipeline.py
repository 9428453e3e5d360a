"""The corpus pipeline: quality rules, exact and near duplicates, personal data,
packing. Every stage is one operator of ``canopy.llm`` with production
parameters, applied to all that the stage before it kept.

Every stage's result is written to the shared scratch folder and read again.
Once it is, the stage's input and what the stage wrote on its way are removed,
so no unredacted text outlives the stage after which it is not needed. What the
last stage reads (the redacted documents, and its own table of ids) stays for
as long as its result is used.

Defined results: a null or empty text has too few words and goes in the first
stage; a document without a language, or of a rare one, is judged by the base
rules alone; of equal texts the smallest id stays (a null id only without
another), of rows that share id and text one; ids that repeat under different
texts are each kept; an empty table gives no rows; other columns, of any name
and type, are carried unchanged up to the last stage, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm import exact_dedup, minhash, packing, pii, quality
from canopy.llm.common import read_table
from canopy.session import drop_scratch, scratch_path, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs, keep="min")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every near-duplicate class (five-word shingles, 0.8) one document stays."""
    return minhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    own = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
    return clean.withColumn("n_chars", own.cast(kind))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences, as pieces with their ids."""
    return packing.pack(docs).withColumnRenamed("doc", "doc_id").withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packed),
]

#: Learned references, trees and MinHash classes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            drop_scratch(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
