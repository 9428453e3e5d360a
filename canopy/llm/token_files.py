"""Token-ID files: Parquet list columns laid out for selective reads.

A token table is a folder with two Parquet tables, both written by Spark.

``data`` holds a row per document in id order:
``shard, doc, start, n_tokens, ids``. ``ids`` is a list column with dictionary
encoding (a vocabulary of 2^16 ids costs 16 bits an id before compression);
``shard``, ``doc``, ``start`` and ``n_tokens`` are delta-encoded. Row groups
and pages are of a stated size and carry column and offset indexes, so a read
of a few documents decodes a few pages, and one of the metadata alone no
token. ``start`` counts from the start of the document's shard, so a shard is
written without knowing any other.

``shards`` has a row per shard: its documents, tokens, least and greatest id,
and ``base``, the tokens of all shards before it. ``base + start`` is a
document's place among all ids.

Writing is one range partitioning of the texts by id; each partition is
sorted, encoded and written by one task as one shard. Of rows that share an id
the order is by a hash of the text, then by place in the input, and those keys
take part in the partitioning, so a repeated id is no hot key. A lost executor
costs the shards it was writing, which are made again from the shuffle.

Defined results: a null or empty text is the end token alone (no ids without
one); a null id comes first; rows that repeat are each kept; an empty table
gives an empty data table and no shards; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import gather, vocabulary_path
from .common import quoted, release, ship, slices, strings, text_or_empty
from .packing import _LETTERS, _PLAIN, END_ID, VOCABULARY, WordTokens

#: Text bytes of a shard.
SHARD_BYTES = 32 << 20
ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 256
#: Rows of the shard table up to which it is broadcast (under 100 bytes each).
BROADCAST_SHARDS = 100_000
#: Distinct words whose ids a worker keeps.
KEPT_WORDS = 400_000

_PLAIN_PIECE = f"^(?:{_PLAIN.pattern})$"
_NEXT_WORD = rf"[\t\n\r ]*('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\t\n\r {_LETTERS}0-9]+)[\t\n\r ]*"
_CUT = "\x01"


class SliceTokens(WordTokens):
    """Ids of a whole slice of texts at once: pieces between spaces, and words
    within them, are found, made distinct and looked up by Arrow; a word is
    encoded once, by the tokenizer's own merge model."""

    def __init__(self, path: str):
        super().__init__(path)
        self._keep(pa.array([""]), np.zeros(0, "<u4"), np.zeros(1, np.int64))

    def _keep(self, words: pa.Array, flat: np.ndarray, size: np.ndarray) -> None:
        """The known words, all their ids one after another, and their number per word."""
        self.known, self.flat, self.size, self.begin = words, flat, size, np.cumsum(size) - size

    def _of_words(self, words: pa.Array) -> np.ndarray:
        """The place of each word, distinct but for empty ones, among the known ones."""
        if len(self.known) > KEPT_WORDS:
            self._keep(self.known[:1], self.flat[:0], self.size[:1])
        found = pc.index_in(words, value_set=self.known)
        fresh = words.filter(pc.is_null(found))
        at = pc.fill_null(found, -1).to_numpy()
        if len(fresh):
            at = np.where(at < 0, len(self.known) - 1 + np.cumsum(at < 0), at)
            ids, size, tokenize = [], [], self.model.tokenize
            shown = "\n".join(fresh.to_pylist()).encode().decode("latin-1").translate(self.letters)
            for word in shown.split(self.letters[ord("\n")]):  # no word has a line break
                got = tokenize(word)
                size.append(len(got))
                ids += [t.id for t in got]
            self._keep(pa.concat_arrays([self.known, fresh]), np.concatenate([self.flat, np.array(ids, "<u4")]),
                       np.concatenate([self.size, np.array(size, np.int64)]))
        return at

    def _of_plain(self, whole: pa.Array, mixed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces that are a word each, then of those to be cut, and their number per piece."""
        marked = pc.replace_substring_regex(mixed, _NEXT_WORD, r"\1" + _CUT)
        cut = pc.split_pattern(marked, _CUT)
        code = pa.concat_arrays([whole, cut.values]).dictionary_encode()
        # a piece of white space alone has no word and is left as it is
        at = self._of_words(pc.utf8_trim(code.dictionary, "\t\n\r "))[code.indices.to_numpy(zero_copy_only=False)]
        own = self.size[at]
        size = np.concatenate([own[:len(whole)], sums(own[len(whole):], cut.offsets.to_numpy())])
        return gather(self.flat, self.begin[at], own), size

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and their number per text."""
        cut = pc.split_pattern(texts, " ")
        code = cut.values.dictionary_encode()
        pieces = code.dictionary
        plain = pc.match_substring_regex(pieces, _PLAIN_PIECE).to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(pieces)
        whole = plain & pc.utf8_is_alpha(low).to_numpy(zero_copy_only=False)  # letters alone are one word
        kinds = [np.flatnonzero(x) for x in (whole, plain & ~whole, ~plain)]
        flat, size = self._of_plain(low.take(pa.array(kinds[0])), low.take(pa.array(kinds[1])))
        if len(kinds[2]):
            other = [self.piece(p) for p in pieces.take(pa.array(kinds[2])).to_pylist()]
            self.pieces.clear()
            flat = np.concatenate([flat, np.frombuffer(b"".join(other), "<u4")])
            size = np.concatenate([size, np.array([len(x) // 4 for x in other], dtype=np.int64)])
        own, begin = np.empty(len(pieces), dtype=np.int64), np.empty(len(pieces), dtype=np.int64)
        place = np.concatenate(kinds)
        own[place], begin[place] = size, np.cumsum(size) - size
        codes = code.indices.to_numpy(zero_copy_only=False)
        return gather(flat, begin[codes], own[codes]), sums(own[codes], cut.offsets.to_numpy())


def sums(size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of ``size`` over each range between neighbours of ``at``."""
    total = np.concatenate([[0], np.cumsum(size)])
    return total[at[1:]] - total[at[:-1]]


@lru_cache(maxsize=4)
def slice_tokens(vocabulary: str = VOCABULARY) -> SliceTokens:
    return SliceTokens(vocabulary_path(vocabulary))


def write(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
          vocabulary: str = VOCABULARY, end_id: int | None = END_ID,
          shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text of ``df`` into the token table at ``path`` (new)."""
    spark = df.sparkSession
    ship(spark)
    id_type = df.schema[id_col].dataType.simpleString()
    text = text_or_empty(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        tokens = slice_tokens(vocabulary)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                flat, n = tokens.encode_slice(texts.slice(a, b - a))
                if end_id is not None:
                    flat, n = np.insert(flat, np.cumsum(n), end_id), n + 1
                start = before + np.cumsum(n) - n
                before += int(n.sum())
                at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, shard, np.int32)), batch.column(0).slice(a, b - a), pa.array(start),
                     pa.array(n), pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.int32)))],
                    names=["shard", "doc", "start", "n_tokens", "ids"])
            release()

    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = df.select(F.col(quoted(id_col)).alias("doc"), text.alias("text"))
    keyed = rows.select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
    ordered = (keyed.repartitionByRange(max(1, -(-int(size) // shard_bytes)), "doc", "tie", "place")
               .sortWithinPartitions("doc", "tie", "place").select("doc", "text"))
    encoded = ordered.mapInArrow(run, f"shard int, doc {id_type}, start long, n_tokens long, ids array<int>")
    (encoded.write.option("compression", "zstd")
     .option("parquet.writer.version", "v2")                        # integers are delta-encoded ...
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")  # ... ids by dictionary
     .option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES))
     .option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .parquet(f"{path}/data"))
    data = spark.read.parquet(f"{path}/data")
    shards = data.groupBy("shard").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"),
        F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    # a row per shard of some tens of MB, so the running sum is over a small table
    up_to = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    shards.withColumn("base", F.sum("tokens").over(up_to) - F.col("tokens")).write.parquet(f"{path}/shards")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``shard, documents, tokens, first_doc, last_doc, base``."""
    return spark.read.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc, start, n_tokens, ids`` with ``start`` counted over all documents.
    A filter on ``doc`` prunes row groups and pages by their indexes; columns
    that are not selected are not read."""
    shards = read_shards(spark, path)
    bases = shards.select("shard", "base")
    if shards.count() <= BROADCAST_SHARDS:
        bases = F.broadcast(bases)
    return spark.read.parquet(f"{path}/data").join(bases, "shard").select(
        "doc", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")


def read_span(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """``doc, start, n_tokens, ids`` of the places ``first <= place < last``
    among all ids; the first and the last document are cut there. Shards
    outside are skipped by their number, and in the data by its statistics."""
    base, tokens = F.col("base"), F.col("tokens")
    hit = read_shards(spark, path).filter((base < F.lit(last)) & (base + tokens > F.lit(first)))
    lo, hi = hit.agg(F.min("shard"), F.max("shard")).first()
    data = spark.read.parquet(f"{path}/data")
    inside = data.filter(F.lit(False)) if lo is None else data.filter(F.col("shard").between(lo, hi))
    at = base + F.col("start")
    rows = inside.join(hit.select("shard", "base"), "shard").filter(
        (at < F.lit(last)) & (at + F.col("n_tokens") > F.lit(first)))
    begin, stop = F.greatest(at, F.lit(first)), F.least(at + F.col("n_tokens"), F.lit(last))
    own = F.slice("ids", (begin - at + 1).cast("int"), (stop - begin).cast("int"))
    return rows.select("doc", begin.alias("start"), (stop - begin).alias("n_tokens"), own.alias("ids"))


def checksum(ids: Column) -> Column:
    """Unsigned CRC-32 of an id list as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def ids_crc32(lists: pa.Array) -> pa.Array:
        at = lists.offsets.to_numpy()
        flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))
        view = memoryview(flat).cast("B")
        return pa.array([zlib.crc32(view[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())

    return ids_crc32(ids)
