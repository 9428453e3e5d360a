"""Spelling variants by permuterm rotations.

A word is marked with a terminator and turned: for every way to part it into
``x`` and ``y`` there is the rotation ``y$x``. Two words that differ in one
code point have rotations that differ in their last place only:

* replaced, ``x a y`` and ``x b y``: ``y$x a`` and ``y$x b``;
* inserted or deleted, ``x y`` and ``x a y``: ``y$x`` and ``y$x a``.

So near words meet under the prefix ``y$x`` that skips the edited place. Every
word gives its rotations by that prefix and the code point behind it ('' for
the rotation that is the prefix itself); they are dealt out and sorted by the
prefix, and a scan of the groups finds the neighbours. A prefix and the code
point behind it spell out one word, so a group holds a row per code point of
the alphabet at most, however frequent the words are, and no pairs are ever
written: a member needs the number of the others and the best of them, and
the three best of a group are enough for every member's best.

Replaced pairs meet under one prefix. A pair with an inserted code point meets
once for each place in a run of that code point; it counts where the code
point does not repeat the one before it.

Words are counted first, with a partial count per task, so a very frequent
word costs a task one row. A word's form has at least twice its count, so the
path from form to form is as long as the binary logarithm of the largest count
at most; its end is found by pointer doubling, each round a join of written
tables.

Defined results: a null text has no words; a text of any length is taken
whole; rows that repeat are counted each; an empty table gives no words; equal
counts are told apart by code-point order; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import quoted

# --- fixed values: letters of a word, the share of slips, the least length and count ---
LETTERS = r"[A-Za-zÀ-ÿ]+"
SLIP_ONE_IN = 97
MIN_LENGTH = 5
MIN_COUNT = 3
# --- end of fixed values ---
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands in no word.
TERMINATOR = "$"
#: Rotations of as many words share a shuffle partition (about a kilobyte each).
WORDS_PER_PARTITION = 50_000


def slipped(word: Column, doc: Column, one_in: int = SLIP_ONE_IN) -> Column:
    """The word, or for one of ``one_in`` (by a checksum of document and word)
    the word without one of its code points."""
    h = F.crc32(F.concat(doc.cast("string"), F.lit(":"), word))
    at = F.pmod(h, F.char_length(word)).cast("int")
    short = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(h % one_in == 0, short).otherwise(word)


def words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          slip_one_in: int | None = None) -> DataFrame:
    """Every run of letters of every text, A-Z lower-cased: ``word``. With
    ``slip_one_in`` that share of them loses a code point (a null id then
    counts as the empty one)."""
    low = F.translate(F.col(quoted(text_col)).cast("string"), UPPER, LOWER)
    rows = df.select(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).alias("doc"),
                     F.explode(F.regexp_extract_all(low, F.lit(LETTERS), F.lit(0))).alias("run"))
    if slip_one_in is None:
        return rows.select(F.col("run").alias("word"))
    return rows.select(slipped(F.col("run"), F.col("doc"), slip_one_in).alias("word"))


def counted(all_words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    return (all_words.filter(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def rotations(vocabulary: DataFrame) -> DataFrame:
    """``prefix, last, n``: for each word its rotations ``y$x``, each once as a
    prefix of its own (``last`` empty) and, where a code point lies between
    ``x`` and ``y``, as the prefix that skips it (``last`` is that code point)."""
    w, size = F.col("word"), F.char_length("word")

    def part(i: Column, skip: int) -> Column:
        return F.concat(F.substring(w, i + 1 + skip, size), F.lit(TERMINATOR), F.substring(w, F.lit(1), i))

    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        part(i, 0).alias("prefix"), F.lit("").alias("last")))
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        part(i, 1).alias("prefix"), F.substring(w, i + 1, F.lit(1)).alias("last")))
    return vocabulary.select("n", F.inline(F.concat(whole, skipped)))


def neighbours(turned: DataFrame, partitions: int) -> DataFrame:
    """``word, near, best``: per word and prefix the number of near words that
    meet it there, and ``best = (-n, word)`` of the first of them."""
    met = F.count(F.lit(1)).over(Window.partitionBy("prefix"))  # sorts the rotations; most meet no other
    group = (turned.repartition(partitions, "prefix").withColumn("met", met).filter("met > 1")
             .groupBy("prefix").agg(F.collect_list(F.struct("last", "n")).alias("m")))
    x, y = F.substring_index("prefix", TERMINATOR, -1), F.substring_index("prefix", TERMINATOR, 1)
    run = F.when(x == "", F.lit(None)).otherwise(F.substring(x, -1, 1))  # a code point that repeats the one before
    member = F.transform("m", lambda r: F.struct(
        (-r["n"]).alias("rank"), F.concat(x, r["last"], y).alias("word"), (r["last"] == "").alias("bare"),
        F.coalesce(r["last"] == run, F.lit(False)).alias("again")))
    named = group.select(F.array_sort(member).alias("m")).select(
        "m", F.slice("m", 1, 3).alias("top"),
        F.size(F.filter("m", lambda r: r["bare"])).alias("bares"), F.size(F.filter("m", lambda r: r["again"])).alias("agains"))
    each = named.select(F.explode("m").alias("own"), "top", F.size("m").alias("size"), "bares", "agains")
    own = F.col("own")
    # a word and the same word with a code point repeated count where the run begins
    apart = F.when(own["bare"], F.col("agains")).when(own["again"], F.col("bares")).otherwise(F.lit(0))
    others = F.filter("top", lambda r: (r["word"] != own["word"]) & ~(own["bare"] & r["again"])
                      & ~(own["again"] & r["bare"]))
    return each.select(
        own["word"].alias("word"), (F.col("size") - 1 - apart).cast("long").alias("near"),
        F.transform(F.slice(others, 1, 1), lambda r: F.struct(r["rank"].alias("rank"), r["word"].alias("word")))
        .alias("best")).filter("near > 0").select("word", "near", F.col("best")[0].alias("best"))


def forms(vocabulary: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n`` for every row of a (written)
    vocabulary ``word, n``: the form is the near word of largest count (ties:
    the first in code-point order) if it has at least twice the word's count."""
    size = vocabulary.count()
    found = (neighbours(rotations(vocabulary), max(1, -(-size // WORDS_PER_PARTITION)))
             .groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))
    best_n = -F.col("best.rank")
    takes = best_n >= 2 * F.col("n")
    return vocabulary.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("best.word")).alias("form"), F.when(takes, best_n).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` for the rows of ``links`` (``word, form``, no cycles):
    each round a word's pointer becomes its pointer's pointer."""
    now = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(now.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip_one_in: int | None = None,
             min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``df``."""
    vocabulary = written(counted(words(df, id_col, text_col, slip_one_in), min_length, min_count), "spelling-words")
    formed = written(forms(vocabulary), "spelling-forms")
    ends = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
