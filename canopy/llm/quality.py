"""Quality rules by distribution divergence.

Every document is compared with a reference of its language in two ways: the
histogram of its character classes and the histogram of the language's common
words (each common word a bin, all other words one bin more). The measure is
the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1).

References come from all documents of the table: a task adds up the counts of
its documents, and the sums are combined per language. A word is common when
it makes up at least ``COMMON_SHARE`` of a language's words, so a language has
at most ``1 / COMMON_SHARE`` of them. A language has a reference when it holds
``MIN_DOCUMENTS`` documents with ``MIN_DOCUMENTS * MIN_WORDS`` words, whatever its
share of the table. The ``1 / LANGUAGE_SHARE`` largest languages are brought to the
tasks; the references of all others stay a table that is joined by language. A
document without a language, or of one with too little for a reference, is not
rejected for its distribution.

The word distance alone cannot reject what lacks a language's common words: where
they make up a quarter of all words, a text without any is at 0.37 only. So the lack
has a limit of its own: a text is rejected that holds less than ``LEAST_COMMON`` of the
common words that a text of its length would, where that is ``EXPECTED_COMMON`` or more.

Guards: a histogram is judged only when the document is long enough for it
(``MIN_CHARS`` characters, ``MIN_WORDS`` words); a shorter one is not rejected
for its distribution. The base rules fail a text with fewer than 50 words, or
with more than half its words inside repeated three-word windows.

Defined results: a null text has no words and fails the base; repeated rows
are each judged; ids are only carried; an empty table gives no rows; other
columns are not read by :func:`assess` and carried by :func:`keep_good`,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, quoted, release, ship, slices, strings

# --- fixed values: the base rules ---
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
LEAST_WORDS = 50
REPEAT_PERCENT = 50
# --- end of fixed values ---

# --- production parameters of the divergence verdict ---
COMMON_SHARE = 1 / 400
LANGUAGE_SHARE = 1 / 500
MIN_DOCUMENTS = 10
MIN_CHARS = 250
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.45
LEAST_COMMON = 0.1
EXPECTED_COMMON = 10
# --- end of parameters ---

NO_LANGUAGE = ""
CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "symbol", "control", "other")
#: Distinct words a task holds before it hands on its sums.
TASK_WORDS = 300_000


def class_table() -> np.ndarray:
    """The character class of each byte; -1 for bytes that continue a character."""
    table = np.full(256, CLASSES.index("symbol"))
    table[:32] = table[127] = CLASSES.index("control")
    table[128:192] = -1
    table[192:] = CLASSES.index("other")
    for name, members in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                          ("digit", b"0123456789"), ("space", SPACES), ("stop", b".,;:!?"), ("mark", b"'\"()-/")):
        table[list(members)] = CLASSES.index(name)
    return table


_CLASS_OF = class_table()
_TO_CLASS = np.zeros((256, len(CLASSES)), dtype=np.int64)
for _b in range(256):
    if _CLASS_OF[_b] >= 0:
        _TO_CLASS[_b, _CLASS_OF[_b]] = 1


def byte_counts(raw: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    hit = np.fromiter((count[w] > 1 for w in windows), dtype=bool, count=len(windows))
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(windows)] |= hit
    return int(covered.sum())


def base_counts(raw: bytes, words: list[bytes], by_byte: np.ndarray) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    characters = len(raw) - int(by_byte[128:192].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), characters - int(by_byte[list(SPACES)].sum()), int(by_byte[list(SYMBOLS)].sum()),
            len(lines) - len(set(lines)), repeated_words(words))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, 0 to 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    a, b = p > 0, q > 0
    d = (p[a] * np.log2(p[a] / m[a])).sum() + (q[b] * np.log2(q[b] / m[b])).sum()
    return float(np.sqrt(min(1.0, max(0.0, d / 2))))


@dataclass
class Reference:
    """Histograms of one language."""
    classes: np.ndarray
    words: dict[bytes, int] = field(default_factory=dict)  # common word -> bin
    shares: np.ndarray = field(default_factory=lambda: np.ones(1))  # the last bin is "any other word"

    def distances(self, words: list[bytes], by_byte: np.ndarray) -> tuple[float | None, float | None, float | None]:
        """Of classes and of words, and the common words held over those expected."""
        by_class = by_byte @ _TO_CLASS
        of_class = of_words = common = None
        if by_class.sum() >= MIN_CHARS and self.classes.sum():
            of_class = js_distance(by_class, self.classes)
        if len(words) >= MIN_WORDS and self.words:
            bins, count = np.zeros(len(self.shares)), Counter(words)
            for w, k in self.words.items():
                bins[k] = count.get(w, 0)
            held = bins.sum()
            bins[-1] = len(words) - held
            of_words = js_distance(bins, self.shares)
            expected = len(words) * self.shares[:-1].sum() / self.shares.sum()
            if expected >= EXPECTED_COMMON:
                common = float(held / expected)
        return of_class, of_words, common


def corpus_counts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, kind, item, n``: documents, character classes and words of every language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[str, Counter]] = {}  # by language and kind

        def out() -> Iterator[pa.RecordBatch]:
            for lang, kinds in sums.items():
                for kind, counter in kinds.items():
                    n = len(counter)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n, pa.string()), pa.array([kind] * n, pa.string()),
                         pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())],
                        names=["lang", "kind", "item", "n"])

        for batch in batches:
            langs, texts = strings(batch.column(0)), strings(batch.column(1))
            for a, b in slices(texts):
                by_lang: dict[str, list[bytes]] = {}
                for lang, raw in zip(langs.slice(a, b - a).to_pylist(),
                                     texts.slice(a, b - a).cast(pa.binary()).to_pylist()):
                    by_lang.setdefault(lang, []).append(raw)
                for lang, raws in by_lang.items():
                    kinds = sums.setdefault(lang, {k: Counter() for k in ("documents", "class", "words", "word")})
                    whole = b"\n".join(raws)
                    kinds["documents"][b""] += len(raws)
                    for name, n in zip(CLASSES, (byte_counts(whole) @ _TO_CLASS).tolist()):
                        kinds["class"][name.encode()] += n
                    words = whole.split()
                    kinds["words"][b""] += len(words)
                    kinds["word"].update(words)
                if sum(len(kinds["word"]) for kinds in sums.values()) > TASK_WORDS:
                    yield from out()
                    sums.clear()
                    release()
        yield from out()
        sums.clear()
        release()

    rows = df.select(F.coalesce(F.col(quoted(lang_col)).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                     F.col(quoted(text_col)).cast("string").alias("text"))
    return (rows.mapInArrow(run, "lang string, kind string, item binary, n long")
            .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))


class References(dict[str, Reference]):
    """The references of the largest languages; ``rest`` is a table of the others, if any."""
    rest: DataFrame | None = None


def _reference(total: int, parts: list[dict]) -> Reference:
    by_name = {bytes(r["item"]).decode(): r["n"] for r in parts if r["kind"] == "class"}
    listed = sorted((bytes(r["item"]), r["n"]) for r in parts if r["kind"] == "word")
    shares = np.array([n for _, n in listed] + [total - sum(n for _, n in listed)], dtype=float)
    return Reference(np.array([by_name.get(c, 0) for c in CLASSES], dtype=float),
                     {w: k for k, (w, _) in enumerate(listed)}, shares)


#: Without counts nothing is far from it.
NO_REFERENCE = Reference(np.zeros(len(CLASSES)))


def references(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
               common_share: float = COMMON_SHARE, language_share: float = LANGUAGE_SHARE) -> References:
    """The reference of every language with enough documents, and the empty one of no language."""
    spark = df.sparkSession
    ship(spark)
    from ..session import scratch_path
    path = scratch_path(spark, "quality-counts")
    corpus_counts(df, text_col, lang_col).write.parquet(path)
    counts = spark.read.parquet(path).filter(F.col("lang") != NO_LANGUAGE)

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n")))

    able = (counts.filter("kind in ('documents', 'words')").groupBy("lang")
            .agg(of("documents").alias("documents"), of("words").alias("total"))
            .filter((F.col("documents") >= MIN_DOCUMENTS) & (F.col("total") >= MIN_DOCUMENTS * MIN_WORDS)))
    most = round(1 / language_share)
    largest = able.orderBy(F.desc("documents"), "lang").limit(most + 1).collect()
    own = spark.createDataFrame([(r["lang"], r["total"]) for r in largest[:most]], "lang string, total long")
    counted = counts.filter("kind in ('class', 'word')")

    def parts(rows: DataFrame) -> DataFrame:
        kept = rows.filter((F.col("kind") == "class") | (F.col("n") >= common_share * F.col("total")))
        return kept.groupBy("lang", "total").agg(F.collect_list(F.struct("kind", "item", "n")).alias("parts"))

    out = References((r["lang"], _reference(r["total"], r["parts"]))
                     for r in parts(counted.join(F.broadcast(own), "lang")).collect())
    out[NO_LANGUAGE] = NO_REFERENCE
    if len(largest) > most:  # none of these is large
        path = scratch_path(spark, "quality-references")
        parts(counted.join(F.broadcast(own), "lang", "left_anti").join(able, "lang")).write.parquet(path)
        out.rest = spark.read.parquet(path)
    return out


_RESULT = pa.struct([*((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                     ("base_failed", pa.bool_()), ("class_distance", pa.float64()),
                     ("word_distance", pa.float64()), ("common_ratio", pa.float64()), ("kept", pa.bool_())])
RESULT_DDL = ("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
              "base_failed:boolean,class_distance:double,word_distance:double,common_ratio:double,kept:boolean>")


def judge_text(raw: bytes, reference: Reference, max_class: float = MAX_CLASS_DISTANCE,
               max_word: float = MAX_WORD_DISTANCE) -> tuple:
    """All results of one text."""
    words, by_byte = raw.split(), byte_counts(raw)
    base = base_counts(raw, words, by_byte)
    failed = base[0] < LEAST_WORDS or 100 * base[4] > REPEAT_PERCENT * base[0]
    of_class, of_words, common = reference.distances(words, by_byte)
    far = ((of_class is not None and of_class > max_class) or (of_words is not None and of_words > max_word)
           or (common is not None and common < LEAST_COMMON))
    return (*base, failed, of_class, of_words, common, not failed and not far)


def _structs(rows: list[tuple]) -> pa.StructArray:
    columns = list(zip(*rows)) if rows else [()] * len(_RESULT)
    release()
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], fields=list(_RESULT))


def verdict(text: Column, lang: Column, refs: dict[str, Reference], max_class: float = MAX_CLASS_DISTANCE,
            max_word: float = MAX_WORD_DISTANCE) -> Column:
    """The struct of all results for a text column, against given references."""
    refs = dict(refs)

    @F.arrow_udf(RESULT_DDL)
    def judge(texts: pa.Array, langs: pa.Array) -> pa.Array:
        texts, langs, rows = strings(texts), strings(langs), []
        for a, b in slices(texts):
            for raw, own in zip(texts.slice(a, b - a).cast(pa.binary()).to_pylist(), langs.slice(a, b - a).to_pylist()):
                rows.append(judge_text(raw, refs.get(own, NO_REFERENCE), max_class, max_word))
        return _structs(rows)

    return judge(text, lang)


def joined_verdict(text: Column, lang: Column, total: Column, parts: Column) -> Column:
    """The struct of all results, against the reference that each row brings (null: none)."""

    @F.arrow_udf(RESULT_DDL)
    def judge_joined(texts: pa.Array, langs: pa.Array, totals: pa.Array, own: pa.Array) -> pa.Array:
        texts, langs, rows = strings(texts), strings(langs), []
        last, reference = None, NO_REFERENCE  # joined rows of a language follow each other
        for a, b in slices(texts):
            for k, raw in enumerate(texts.slice(a, b - a).cast(pa.binary()).to_pylist(), a):
                if (lang := langs[k].as_py()) != last:
                    last = lang
                    reference = _reference(totals[k].as_py(), own[k].as_py()) if own[k].is_valid else NO_REFERENCE
                rows.append(judge_text(raw, reference))
        return _structs(rows)

    return judge_joined(text, lang, total, parts)


def _judged(df: DataFrame, text_col: str, lang_col: str, refs: dict[str, Reference] | None) -> tuple[DataFrame, str]:
    """``df`` with all results in one more column, and its name."""
    ship(df.sparkSession)
    refs = references(df, text_col, lang_col) if refs is None else refs
    q = free_name(df, "quality")
    text = F.col(quoted(text_col)).cast("string")
    lang = F.coalesce(F.col(quoted(lang_col)).cast("string"), F.lit(NO_LANGUAGE))
    rest = getattr(refs, "rest", None)
    if rest is None:
        return df.withColumn(q, verdict(text, lang, refs)), q
    known, key, total, parts = lang.isin(*refs, NO_LANGUAGE), *(free_name(df, f"{q}_{c}") for c in ("lang", "total", "parts"))
    table = rest.select(F.col("lang").alias(key), F.col("total").alias(total), F.col("parts").alias(parts))
    others = df.filter(~known).withColumn(key, lang).join(table, key, "left")
    others = others.withColumn(q, joined_verdict(text, F.col(key), F.col(total), F.col(parts)))
    own = df.filter(known).withColumn(q, verdict(text, lang, refs))
    return own.unionByName(others.select(*map(quoted, df.columns), q)), q


def assess(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           refs: dict[str, Reference] | None = None) -> DataFrame:
    """``id`` and all results for every row."""
    judged, q = _judged(df, text_col, lang_col, refs)
    return judged.select(F.col(quoted(id_col)).alias("id"), F.col(q)).select("id", f"{q}.*")


def keep_good(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
              refs: dict[str, Reference] | None = None) -> DataFrame:
    """The rows of ``df`` that are kept, with their columns unchanged."""
    judged, q = _judged(df, text_col, lang_col, refs)
    return judged.filter(F.col(q)["kept"]).drop(q)
