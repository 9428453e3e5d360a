"""Ranked lexical search by presence masks.

For each item (a query) the documents of a block are grouped by the set of the
item's terms that they hold, a bit mask. What a document of a mask can score
is bounded by the mask alone: each present term by its weight, its greatest
frequency in the block and the block's shortest document. Masks are evaluated
by descending bound, their documents scored exactly, until the bound is below
the score of the last place; the rest cannot enter. (At an equal bound the
search goes on, since a smaller id would win.)

Plan. Items are taken in blocks of bounded text, so what a task holds of them
is bounded whatever their number; usually there is one. For a block of items:

1. one pass over the texts writes, per document, its length and the item terms
   in it with their frequencies (``postings``, a small part of the text);
2. document counts per term are summed per task and then over all, and give
   the weights: one number per item term;
3. a pass over the postings keeps the best ``k`` documents of every item per
   task by presence masks, the last place carried on from block to block;
4. the tasks' bests, ``k`` rows an item and task, are ranked per item.

No text or posting is shuffled, no document meets an item it shares no term
with, and a term that every document holds costs no more than its postings.

Defined results: null and empty texts have no terms and are in no ranking;
equal scores are ordered by id, a null id last; rows that share an id are
ranked each; items that repeat id and text count once, items that share an id
only are ranked each under it; an empty table, or one without terms, gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import quoted, release, ship, slices, strings, text_or_empty

# --- fixed values: the score ---
PLACES = 10
LENGTH_PERCENT = 75
SCALE = 1_000_000_000
TF_FACTOR, LENGTH_FACTOR = 1000, 8
WEIGHT_SCALE = 1000
# --- end of fixed values ---
#: Text of the items that one pass over the documents takes.
ITEM_BLOCK_BYTES = 16 << 20
#: Documents whose masks are grouped at a time.
BLOCK_DOCUMENTS = 4096
#: Documents scored between two looks at the bounds.
SCORE_STEP = 256

#: Every byte that stands in no term becomes a space, A-Z become a-z; bytes of
#: longer UTF-8 characters all stand in terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Items:
    """Items of a block: their ids, and per item its terms (numbers in
    ``vocabulary``) and how often it has each."""
    ids: list
    vocabulary: list[bytes]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def item_block(rows: list[tuple[object, str | None]]) -> Items:
    place: dict[bytes, int] = {}
    ids, terms, repeats = [], [], []
    for item, text in rows:
        own = [place.setdefault(t, len(place)) for t in terms_of(text)]
        if own:
            t, n = np.unique(np.array(own, dtype=np.int64), return_counts=True)
            ids.append(item)
            terms.append(t)
            repeats.append(n.astype(np.int64))
    return Items(ids, list(place), terms, repeats)


def find_postings(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per text, and of the texts' vocabulary terms: number per text,
    term and frequency, by text and term."""
    raw = texts.cast(pa.binary())
    at = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset:raw.offset + len(raw) + 1].copy()
    data = raw.buffers()[2]
    own = data.slice(int(at[0]), int(at[-1] - at[0])).to_pybytes() if data else b""
    folded = own.translate(_FOLD)
    clean = pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(at - at[0]), pa.py_buffer(folded)])
    cut = pc.split_pattern(clean, b" ")
    words = cut.values
    of = np.repeat(np.arange(len(raw)), np.diff(cut.offsets.to_numpy()))
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    length = np.bincount(of[full], minlength=len(raw)).astype(np.int64)
    known = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    hit = known >= 0
    pair, tf = np.unique(of[hit] * np.int64(max(1, len(vocabulary))) + known[hit], return_counts=True)
    doc, term = pair // max(1, len(vocabulary)), pair % max(1, len(vocabulary))
    return length, np.bincount(doc, minlength=len(raw)).astype(np.int64), term.astype(np.int32), tf.astype(np.int32)


def write_postings(df: DataFrame, items: Items, id_col: str, text_col: str) -> str:
    """A table ``doc, n, terms, tf``: a document's length in terms and, as
    little-endian 32-bit integers, the item terms in it and their frequencies."""
    vocabulary = items.vocabulary
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.binary())
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                length, count, term, tf = find_postings(texts.slice(a, b - a), known)
                at = (4 * np.concatenate([[0], np.cumsum(count)])).tolist()
                t, f = term.astype("<i4").tobytes(), tf.astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(length),
                     pa.array([t[x:y] for x, y in zip(at[:-1], at[1:])], pa.binary()),
                     pa.array([f[x:y] for x, y in zip(at[:-1], at[1:])], pa.binary())],
                    names=["doc", "n", "terms", "tf"])
            release()

    path = scratch_path(df.sparkSession, "lexical-postings")
    (df.select(F.col(quoted(id_col)).alias("doc"), text_or_empty(text_col).alias("text"))
     .mapInArrow(run, f"doc {id_type}, n long, terms binary, tf binary").write.parquet(path))
    return path


def document_counts(postings: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term, summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                raw = b"".join(batch.column(0).slice(a, b - a).to_pylist())
                count += np.bincount(np.frombuffer(raw, "<i4"), minlength=size)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(count[held])], names=["term", "df"])

    summed = postings.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, dtype=np.int64)
    table = summed.toArrow()  # a row per term of the item block at most
    out[table["term"].to_numpy()] = table["df"].to_numpy()
    return out


def weights(documents: int, held: np.ndarray) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * d + 1))) for d in held.tolist()],
                    dtype=np.int64)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds per unit of weight; more for a greater ``tf`` and a smaller ``m``."""
    return (SCALE * tf) // (TF_FACTOR * tf + LENGTH_FACTOR * m)


class Ranking:
    """The best ``places`` documents of every item among those seen."""

    def __init__(self, items: Items, weight: np.ndarray, places: int):
        self.items, self.weight, self.places = items, weight, places
        self.best: list[list[tuple[int, bool, object]]] = [[] for _ in items.ids]  # (-score, id is null, id)
        self.masks = self.scored = 0

    def block(self, ids: list, m: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray) -> None:
        """Postings of a block of documents, by document and term."""
        if not len(term):
            return
        order = np.argsort(term, kind="stable")
        term, doc, tf = term[order], doc[order], tf[order].astype(np.int64)
        used, first = np.unique(term, return_index=True)
        last = np.append(first[1:], len(term))
        most = gain(np.maximum.reduceat(tf, first), m.min())  # of any document of the block
        where = {t: k for k, t in enumerate(used.tolist())}
        for k, (own, repeats) in enumerate(zip(self.items.terms, self.items.repeats)):
            weight = self.weight[own] * repeats
            held = [(j, where[t]) for j, t in enumerate(own.tolist()) if weight[j] and t in where]
            if held:
                self._item(k, ids, m, weight, held, most, first, last, doc, tf)

    def _item(self, k, ids, m, weight, held, most, first, last, doc, tf) -> None:
        freq = np.zeros((len(ids), len(held)), dtype=np.int64)
        for c, (_, p) in enumerate(held):
            freq[doc[first[p]:last[p]], c] = tf[first[p]:last[p]]
        w = weight[[j for j, _ in held]]
        bits = np.packbits(freq > 0, axis=1)
        mask = np.ascontiguousarray(bits).view(np.dtype((np.void, bits.shape[1]))).ravel()
        masks, group = np.unique(mask, return_inverse=True)
        sets = np.unpackbits(masks.view(np.uint8).reshape(len(masks), -1), axis=1, count=len(held)).astype(np.int64)
        bound = sets @ (w * most[[p for _, p in held]])
        rank = np.argsort(-bound, kind="stable")
        place = np.empty(len(rank), dtype=np.int64)
        place[rank] = np.arange(len(rank))
        by_mask = np.argsort(place[group], kind="stable")
        limit = bound[group[by_mask]]
        self.masks += len(masks)
        best, at = self.best[k], 0
        while at < len(by_mask):
            floor = -best[-1][0] if len(best) == self.places else 1
            stop = min(at + SCORE_STEP, int(np.searchsorted(-limit, -floor, side="right")))  # bounds of the floor or more
            if stop <= at:
                break
            rows = by_mask[at:stop]
            score = gain(freq[rows], m[rows, None]) @ w
            self.scored += len(rows)
            for r, s in zip(rows[score >= floor].tolist(), score[score >= floor].tolist()):
                best.append((-s, ids[r] is None, ids[r] if ids[r] is not None else 0))
            best.sort()
            del best[self.places:]
            at = stop


def search(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", places: int = PLACES) -> DataFrame:
    """``item, rank, doc, score``: the best ``places`` documents of every item."""
    ship(df.sparkSession)
    queries = items.select(F.col(quoted(item_id_col)).alias("item"),
                           text_or_empty(item_text_col).alias("text")).distinct()
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // ITEM_BLOCK_BYTES))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    found = []
    for b in range(blocks):
        rows = dealt.filter(F.col("block") == b).orderBy("item", "text").collect()  # a block of bounded text
        found.append(_search_block(df, item_block([(r["item"], r["text"]) for r in rows]),
                                   queries.schema["item"].dataType.simpleString(), id_col, text_col, places))
    return reduce(DataFrame.unionByName, found)


def _search_block(df: DataFrame, items: Items, item_type: str, id_col: str, text_col: str, places: int) -> DataFrame:
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType
    postings = spark.read.parquet(write_postings(df, items, id_col, text_col))
    documents, length = postings.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    weight = weights(documents, document_counts(postings, len(items.vocabulary)))
    length = length or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Ranking(items, weight, places)
        for batch in batches:
            for a, b in slices(batch.column(2)):
                for lo in range(a, b, BLOCK_DOCUMENTS):
                    part = batch.slice(lo, min(b - lo, BLOCK_DOCUMENTS))
                    terms, tfs = part.column(2).to_pylist(), part.column(3).to_pylist()
                    n = part.column(1).to_numpy()
                    m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n * documents // length
                    doc = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
                    best.block(part.column(0).to_pylist(), m, np.frombuffer(b"".join(terms), "<i4"), doc,
                               np.frombuffer(b"".join(tfs), "<i4"))
        rows = [(k, None if none else doc, -s) for k, own in enumerate(best.best) for s, none, doc in own]
        item, docs, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(docs, kind), pa.array(score, pa.int64())],
                                         names=["query", "doc", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(id_type)
    bests = (postings.filter(F.octet_length("terms") > 0).select("doc", "n", "terms", "tf")
             .mapInArrow(run, f"query int, doc {id_type.simpleString()}, score long"))
    first = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = bests.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= places)
    # a row per item of the block
    names = spark.createDataFrame(list(enumerate(items.ids)), f"query int, item {item_type}")
    return ranked.join(F.broadcast(names), "query").select("item", "rank", "doc", "score")
