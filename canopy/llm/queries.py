"""Registered queries of the operators: each applies one operator to its whole
table with production parameters and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_pipeline import run as pipeline

from ..session import scratch_path
from . import (bpe, exact_dedup, lexical, minhash, packing, pii, quality, spelling, suffix_dedup, token_counts,
               token_files, toxicity, url_filters)
from .common import read_table, ship, text_or_empty
from .oracle import ORACLE_SQL  # noqa: F401

# --- fixed values: the URL rules of the query ---
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
TOXIC_FROM = 0.7
# --- end of fixed values ---


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digests(packing.pack(read_table(spark, sf, "documents")))


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.assess(read_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf, "documents")
    both = docs.select("doc_id", bpe.round_trip(text_or_empty("text")).alias("b"))
    return both.select("doc_id", (F.octet_length("b.ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("b.ids", 256).alias("ids_sha256"), F.sha2("b.text", 256).alias("decoded_sha256"))


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    rated = toxicity.rate(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))
    return rated.select(F.col("id").alias("doc_id"), "held_out", "score",
                        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op6_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf, "documents"), words=2).withColumnRenamed("id", "doc_id")


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(read_table(spark, sf, "documents"))
    count = [pii.base_count(F.col("spans"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(F.col("id").alias("doc_id"), *count,
                        F.sha2(pii.written(F.col("spans"), only_base=True), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op9_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = url_filters.rule_table(spark, URL_RULES)
    return url_filters.judge(read_table(spark, sf, "pages"), rules).withColumnRenamed("id", "page_id")


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(read_table(spark, sf, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    found = lexical.search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(read_table(spark, sf, "documents"), path)
    return token_files.read(spark, path).select(
        F.col("doc").alias("doc_id"), "start", "n_tokens", token_files.checksum(F.col("ids")).alias("ids_crc32"))


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf, "documents"), slip_one_in=spelling.SLIP_ONE_IN)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_bpe": op3_bpe,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_minhash": op6_minhash,
    "op7_pii": op7_pii,
    "op8_token_counts": op8_token_counts,
    "op9_url_filters": op9_url_filters,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_files": op12_token_files,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}
