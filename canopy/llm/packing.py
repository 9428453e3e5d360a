"""Packing: concatenate all documents and cut into fixed windows.

Pass one encodes each document once and writes, per input partition, its ids
with the running token count inside that partition; the partition totals are
then a small table. A prefix sum over those totals gives every partition, and
so every document, its global token offset. Pass two cuts at multiples of the
window length: a document gives one piece per window that it touches, and a
piece that ends at a window's edge is the boundary record that continues in
the next window. Only the last window of the whole corpus is not full.

No document, window or partition is ever gathered anywhere: pass two is a map
over the written ids, and the only shuffle is the sum of the totals.

Defined results: a null or empty text is one end token; rows that repeat or
share an id are packed each on their own; a null id is kept as null; an empty
table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import byte_letters, gather, vocabulary_path
from .common import quoted, release, ship, slices, strings, text_or_empty

VOCABULARY = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2
#: Partition totals are broadcast up to this many partitions (24 bytes each).
BROADCAST_PARTITIONS = 200_000

CACHE_WORDS = 300_000
#: Pieces of these characters (after composition) split and lower-case alike
#: in every library; all others are left to the tokenizer itself.
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile(rf"[A-Za-z0-9À-ÖØ-öø-ÿß\t\n\r !\"#$%&'()*+,\-./:;=>?@\[\\\]^_`{{|}}~]*")
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")


class WordTokens:
    """Ids of a lower-casing, space-dropping tokenizer file, with the distinct
    words of a worker encoded once by the tokenizer's own merge model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            shown = word.encode().decode("latin-1").translate(self.letters)
            ids = np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
            self.words[word] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        """The ids of a text without spaces at which it could be cut."""
        ids = self.pieces.get(piece)
        if ids is None:
            if _PLAIN.fullmatch(piece):
                ids = b"".join(map(self._word, _WORD.findall(piece.lower())))
            else:
                own = self.tokenizer.encode(piece, add_special_tokens=False).ids
                ids = np.array(own, dtype="<u4").tobytes()
            self.pieces[piece] = ids
        return ids

    def encode_arrow(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text. White space never reaches a token of this
        vocabulary, so a text is the sequence of its parts between spaces."""
        for a, b in slices(texts):
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            if len(self.pieces) > CACHE_WORDS:
                self.pieces.clear()
            cut = pc.split_pattern(texts.slice(a, b - a), " ")
            at = cut.offsets.to_numpy()
            code = cut.values.dictionary_encode()
            codes = code.indices.to_numpy(zero_copy_only=False)
            ids = [self.piece(p) for p in code.dictionary.to_pylist()]
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            size = np.array([len(x) // 4 for x in ids] or [0], dtype=np.int64)
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            for k in range(b - a):
                mine = codes[at[k]:at[k + 1]]
                yield gather(flat, start[mine], size[mine]).tobytes()


@lru_cache(maxsize=4)
def word_tokens(vocabulary: str = VOCABULARY) -> WordTokens:
    return WordTokens(vocabulary_path(vocabulary))


def encoded(df: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY,
            end_id: int | None = END_ID) -> DataFrame:
    """Pass one: ``doc, part, before, n, ids`` for every row, where ``part`` is
    the input partition and ``before`` the tokens ahead of the row in it."""
    id_type = df.schema[id_col].dataType.simpleString()
    end = b"" if end_id is None else np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        tokens = word_tokens(vocabulary)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                ids = [x + end for x in tokens.encode_arrow(texts.slice(a, b - a))]
                n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                ahead = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part, np.int32)),
                     pa.array(ahead), pa.array(n), pa.array(ids, pa.binary())],
                    names=["doc", "part", "before", "n", "ids"])
            release()

    return (df.select(F.col(quoted(id_col)).alias("doc"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, f"doc {id_type}, part int, before long, n long, ids binary"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int | None = END_ID) -> DataFrame:
    """Pieces ``doc, start, length, doc_tokens, sequence_id, offset,
    sequence_length, ids``: ``length`` ids of a document from its ``start`` on,
    lying at ``offset`` of sequence ``sequence_id``; ``ids`` are those ids
    (binary, little-endian unsigned 32-bit)."""
    spark = df.sparkSession
    ship(spark)
    path = scratch_path(spark, "packing")
    (encoded(df, id_col, text_col, vocabulary, end_id)
     .write.option("compression", "zstd").parquet(path))
    rows = spark.read.parquet(path)
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("tokens"))
    # one row per input partition, so the running sum is over a small table
    in_order = Window.orderBy("part")
    up_to = in_order.rowsBetween(Window.unboundedPreceding, 0)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = totals.select("part", (F.sum("tokens").over(up_to) - F.col("tokens")).alias("base"),
                          F.sum("tokens").over(whole).alias("total"))
    parts = rows.agg(F.max("part")).first()[0]  # the written table's partition numbers, one column
    if parts is not None and parts < BROADCAST_PARTITIONS:
        bases = F.broadcast(bases)
    at = F.col("base") + F.col("before")
    w = F.lit(window).cast("long")
    placed = (rows.filter(F.col("n") > 0).join(bases, "part")
              .select("doc", "n", "ids", "total", at.alias("at")))
    first, last = F.expr(f"at DIV {int(window)}"), F.expr(f"(at + n - 1) DIV {int(window)}")
    cut = placed.select("*", F.explode(F.sequence(first, last)).alias("sequence_id"))
    begin = F.greatest(F.col("at"), F.col("sequence_id") * w)
    stop = F.least(F.col("at") + F.col("n"), (F.col("sequence_id") + 1) * w)
    start, length = begin - F.col("at"), stop - begin
    return cut.select(
        "doc", start.alias("start"), length.alias("length"), F.col("n").alias("doc_tokens"),
        "sequence_id", (begin - F.col("sequence_id") * w).alias("offset"),
        F.least(w, F.col("total") - F.col("sequence_id") * w).alias("sequence_length"),
        F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The windows themselves: ``sequence_id, ids`` (binary), each joined from
    its pieces in order; a group holds one window of tokens at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b"").cast("binary"),
                    lambda all_, p: F.concat(all_, p["ids"])).alias("ids"))


def padding(length: Column, window: int = WINDOW) -> Column:
    """Pad tokens of a sequence: up to the window, none at a power of two."""
    return F.when(length.bitwiseAND(length - 1) == 0, F.lit(0)).otherwise(F.lit(window) - length).cast("long")


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return pieces.select(
        F.col("doc").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "sequence_length", padding(F.col("sequence_length")).alias("padding"))
