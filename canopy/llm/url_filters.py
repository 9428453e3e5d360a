"""URL filters by host-suffix and path-prefix expressions.

A rule is a host and a path. It fits a URL whose host is the rule's host or a
subdomain of it and whose path starts with the rule's path. Every URL is
expanded into the expressions that a rule could have: each suffix of its host
at a dot, joined with each prefix of its path of a length that some rule path
has. Expressions meet rules in an equi-join on a short hash prefix (32 bits of
SHA-256); the full digest confirms the match. Of the rules that fit, the
longest expression wins, then the longer host; the aggregate that picks it
combines per task first. URLs are judged once however many pages share them.

The path lengths come from the rules, so the expansion is bounded by (labels
of the host) x (distinct lengths of rule paths), not by the length of a URL.
The rule table is broadcast only behind a count of its rows.

Defined results: a null URL, or one without ``://``, has an empty host and an
empty path, and fits no rule; no rule means the default verdict; a host or
path that is null in a rule drops the rule; repeated rules count once, and a
rule that says both ``block`` and ``allow`` blocks; repeated rows are each
judged; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted

BLOCK, ALLOW = "block", "allow"
PREFIX_HEX = 8
#: A rule table of at most this many rows (about 200 bytes each) is broadcast.
BROADCAST_RULES = 100_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``verdict, host, path`` rows of a short list."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = ALLOW) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row of ``df``."""
    clean = (rules.select("verdict", F.lower("host").alias("host"), "path")
             .filter(F.col("host").isNotNull() & F.col("path").isNotNull())
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))  # block > allow
    lengths = F.array_sort(F.collect_set(F.length("path")))
    bounds = clean.agg(F.count(F.lit(1)).alias("n"), lengths.alias("lengths")).first()
    digest = _digest(F.concat("host", "path"))
    table = clean.select(digest.alias("rule_digest"), F.substring(digest, 1, PREFIX_HEX).alias("prefix"),
                         F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"),
                         F.col("verdict").alias("rule_verdict"))
    if bounds["n"] <= BROADCAST_RULES:
        table = F.broadcast(table)
    rows = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(url_col)).cast("string").alias("url")).select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    distinct = rows.filter(F.col("host") != "").groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.array(*[F.lit(n) for n in bounds["lengths"]]).cast("array<int>")
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = (distinct.select("host", "path", prefixes.alias("prefixes"), F.explode(suffixes).alias("suffix"))
                   .select("host", "path", "suffix", F.explode("prefixes").alias("start"))
                   .select("host", "path", F.concat("suffix", "start").alias("expression"))
                   .select("host", "path", _digest(F.col("expression")).alias("digest")))
    hits = expressions.select("*", F.substring("digest", 1, PREFIX_HEX).alias("prefix")).join(table, "prefix").filter(
        F.col("digest") == F.col("rule_digest"))
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("length"), "host_length", "rule", "rule_verdict")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"))
