"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: lower-cased words and the first letters of
longer words, each hashed to ``HASH_BITS`` bits. The score is

    sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>)

so a pair of terms (an insult and the mention of a group) can weigh more, or
less, than its two parts, which additive weights cannot express. The pair sum
is taken as half of ``|sum v|^2 - sum |v|^2``, in time linear in the terms.

Training takes a bounded sample of labelled rows (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN``, chosen by the hash of their ids; each class is weighted back
to its share of all labelled rows). Its ids are picked from the label
table alone and, being bounded, are sent to the documents; of an id that
repeats one text is taken, by hash. A quarter of the sample, by hash of the
terms, is held back for the calibration of the score.

A term enters the machine for either of two reasons; the others have weight
zero. Its rates in the two classes differ clearly. Or it is half of a pair that
tells more than its parts: among the documents that hold both terms the toxic
share is not the one that the two terms' own shares explain together (their
log odds added up, as additive weights would). So terms that say nothing alone
are learned with the terms that give them a meaning. Pairs are counted, term by
term, in up to ``PAIR_ROWS`` sampled documents of each class (those of more
than ``PAIR_TERMS`` such terms say little about any one pair and are not among
them); the clearer a pair must be, the more pairs were looked at.

Terms are counted in Spark. The driver holds the counts of terms in at least
``MIN_ROWS`` sampled documents, the terms of the pair rows, and of every
sampled document the chosen terms only.

Defined results: a null or empty text has no terms and gets the score of the
bias; rows that repeat are each scored; labels that are null are not used and
a document labelled twice counts as toxic if either label says so; without
labels of both classes every score is the share of toxic labels (0 if none);
an empty table gives no rows; language, source, ids and labels never enter a
score; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .bpe import gather
from .common import hash_share, quoted, ship, slices, strings, text_or_empty

# --- production parameters ---
HASH_BITS = 30
PREFIX = 5            # letters of a word's start that form a term of their own
SAMPLE_TOXIC, SAMPLE_CLEAN = 5000, 10000
MIN_ROWS = 4          # sampled documents that must hold a term
MIN_Z = 3.0           # difference of its rates in the two classes, in standard errors
PAIR_ROWS, PAIR_TERMS = 2000, 1500  # documents of a class, and terms of one, in which pairs are counted
PAIR_MIN = 12         # of them that must hold a term, and a pair
FACTORS, EPOCHS, BATCH, STEP, DECAY, SEED = 8, 15, 256, 0.1, 1e-4, 7
CACHE_PIECES = 400_000
# --- end of parameters ---

_WORD = re.compile(r"[^\W\d_]+")


def terms(piece: str) -> list[int]:
    """Hashed terms of a text."""
    out = []
    for w in _WORD.findall(piece.lower()):
        raw = w.encode()
        out.append(zlib.crc32(raw) >> (32 - HASH_BITS))
        if len(w) > PREFIX:
            out.append(zlib.crc32(b"^" + w[:PREFIX].encode()) >> (32 - HASH_BITS))
    return out


@dataclass
class Machine:
    """Bias, weights and factors of the chosen terms, and the calibration."""
    index: dict[int, int] = field(default_factory=dict)
    bias: float = 0.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(0))
    v: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        """The raw sum for each set of term positions."""
        size = np.array([len(r) for r in rows], dtype=np.int64)
        at = np.concatenate(rows).astype(np.int64) if size.sum() else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), size)
        linear = np.bincount(owner, self.w[at], len(rows))
        total = np.zeros((len(rows), FACTORS))
        np.add.at(total, owner, self.v[at])
        squares = np.bincount(owner, (self.v[at] ** 2).sum(axis=1), len(rows))
        return self.bias + linear + 0.5 * ((total ** 2).sum(axis=1) - squares)

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        z = self.scale * self.margin(rows) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def fit(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> Machine:
        """AdaGrad on the weighted logistic loss."""
        rng = np.random.default_rng(SEED)
        n = len(self.index)
        share = np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4)
        self.bias, self.w = float(np.log(share / (1 - share))), np.zeros(n)
        self.v = rng.normal(0, 0.05, (n, FACTORS))
        seen_b, seen_w, seen_v = 1e-6, np.full(n, 1e-6), np.full((n, FACTORS), 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for first in range(0, len(order), BATCH):
                pick = order[first:first + BATCH]
                own = [rows[i] for i in pick]
                size = np.array([len(r) for r in own], dtype=np.int64)
                at = np.concatenate(own).astype(np.int64)
                owner = np.repeat(np.arange(len(own)), size)
                held = self.v[at]
                total = np.zeros((len(own), FACTORS))
                np.add.at(total, owner, held)
                pairs = 0.5 * ((total ** 2).sum(axis=1) - np.bincount(owner, (held ** 2).sum(axis=1), len(own)))
                z = self.bias + np.bincount(owner, self.w[at], len(own)) + pairs
                g = weight[pick] * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[pick])
                seen_b += float(g.sum()) ** 2
                self.bias -= STEP * float(g.sum()) / np.sqrt(seen_b)
                if not len(at):
                    continue
                used, place = np.unique(at, return_inverse=True)
                gw = np.bincount(place, g[owner]) + DECAY * self.w[used]
                gv = np.zeros((len(used), FACTORS))
                np.add.at(gv, place, g[owner, None] * (total[owner] - held))
                gv += DECAY * self.v[used]
                seen_w[used] += gw ** 2
                seen_v[used] += gv ** 2
                self.w[used] -= STEP * gw / np.sqrt(seen_w[used])
                self.v[used] -= STEP * gv / np.sqrt(seen_v[used])
        return self

    def calibrate(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> Machine:
        """Logistic calibration on rows that the fit has not seen."""
        m, a, b = self.margin(rows), 1.0, 0.0
        for _ in range(100):  # Newton steps with a pull to the identity
            p = 1 / (1 + np.exp(-np.clip(a * m + b, -50, 50)))
            h, g = weight * p * (1 - p) + 1e-9, weight * (p - y)
            hess = np.array([[(h * m * m).sum() + 1, (h * m).sum()], [(h * m).sum(), h.sum() + 1]])
            step = np.linalg.solve(hess, [(g * m).sum() + a - 1, g.sum() + b])
            a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
            if np.abs(step).max() < 1e-7:
                break
        self.scale, self.shift = max(a, 0.05), b
        return self


def telling(toxic: np.ndarray, every: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Whether terms' rates in the classes differ: of each the toxic and all
    documents that hold it, and the documents of both classes."""
    p1, p0, p = toxic / n1, (every - toxic) / n0, every / (n1 + n0)
    z = np.abs(p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    return (every >= MIN_ROWS) & (z >= MIN_Z)


def interacting(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Terms of pairs that tell more than their parts, from documents' term
    sets: for one term at a time all terms beside it are counted."""
    size = np.array([len(r) for r in rows], dtype=np.int64)
    every = np.concatenate(rows) if size.sum() else np.zeros(0, np.int64)
    kinds, at, n = np.unique(every, return_inverse=True, return_counts=True)
    able = n >= PAIR_MIN
    owner = np.repeat(np.arange(len(rows)), size)[able[at]]
    term = (np.cumsum(able) - 1)[at][able[at]]
    kinds, n = kinds[able], n[able].astype(float)
    if len(kinds) < 2:
        return kinds[:0]
    begin = np.searchsorted(owner, np.arange(len(rows) + 1))
    held = owner[np.argsort(term, kind="stable")]                     # documents of each term
    of_term = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    toxic = np.bincount(term, y[owner], len(kinds))

    def odds(t, k):
        return np.log((t + 0.5) / (k - t + 0.5))

    own, base = odds(toxic, n), odds(y.sum(), len(y))
    best, tested = np.zeros(len(kinds)), 0
    for i in range(len(kinds)):
        docs = held[of_term[i]:of_term[i + 1]]
        length = begin[docs + 1] - begin[docs]
        beside = gather(term, begin[docs], length)
        both = np.bincount(beside, minlength=len(kinds))
        both[:i + 1] = 0                                              # each pair once
        j = np.flatnonzero(both >= PAIR_MIN)
        if not len(j):
            continue
        tested += len(j)
        share = np.bincount(beside, np.repeat(y[docs], length), len(kinds))[j]
        q = np.clip(1 / (1 + np.exp(-(own[i] + own[j] - base))), 0.05, 0.95)
        z = np.abs(share - both[j] * q) / np.sqrt(both[j] * q * (1 - q))
        best[i] = max(best[i], z.max())
        best[j] = np.maximum(best[j], z)
    # about the largest that as many pairs reach by chance, and a little over
    return kinds[best >= 1 + np.sqrt(2 * np.log(2 * max(tested, 1)))]


def pair_rows(rows: list[np.ndarray], y: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The first rows of each class, equal ones once."""
    out: list[tuple[np.ndarray, float]] = []
    for k in (1, 0):
        seen: set[bytes] = set()
        for r, label in zip(rows, y):
            if label == k and len(seen) < PAIR_ROWS and len(r) <= PAIR_TERMS and r.tobytes() not in seen:
                seen.add(r.tobytes())
                out.append((r, label))
    return [r for r, _ in out], np.array([label for _, label in out])


def fitted(chosen: np.ndarray, sets: list[np.ndarray], y: np.ndarray, weight: np.ndarray, held: np.ndarray) -> Machine:
    """A machine over the ``chosen`` terms (in order), from documents' positions
    among them; calibrated on the rows that are ``held`` back."""
    machine = Machine(index={int(t): i for i, t in enumerate(chosen)})
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    fit, back = np.flatnonzero(~held), np.flatnonzero(held)
    machine.fit([sets[i] for i in fit], y[fit], weight[fit])
    return machine.calibrate([sets[i] for i in back], y[back], weight[back]) if len(back) else machine


def among(terms_: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Positions in the sorted ``chosen`` of those terms that are there."""
    at = np.searchsorted(chosen, terms_)
    inside = at < len(chosen)
    inside[inside] = chosen[at[inside]] == terms_[inside]
    return at[inside]


def is_held(row: np.ndarray) -> bool:
    return int(row.sum() + len(row)) % 4 == 0


def learn(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> Machine:
    """A machine from term hashes of labelled documents that fit in memory, by
    the same steps as :func:`train`."""
    y, weight = np.asarray(y, dtype=float), np.asarray(weight, dtype=float)
    if len(set(y.tolist())) < 2:
        return Machine(constant=float(y.mean()) if len(y) else 0.0)
    size = np.array([len(r) for r in rows], dtype=np.int64)
    every = np.concatenate(rows) if size.sum() else np.zeros(0, np.int64)
    kinds, at = np.unique(every, return_inverse=True)
    toxic, n = np.bincount(at, np.repeat(y, size), len(kinds)), np.bincount(at, minlength=len(kinds))
    chosen = np.union1d(kinds[telling(toxic, n, y.sum(), (1 - y).sum())], interacting(*pair_rows(rows, y)))
    held = np.array([is_held(r) for r in rows])
    return fitted(chosen, [among(r, chosen) for r in rows], y, weight, held)


# ------------------------------------------------------------------ Spark side
def held_out(id_col: Column) -> Column:
    """The evaluation fold: CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "toxic", sample_toxic: int = SAMPLE_TOXIC,
          sample_clean: int = SAMPLE_CLEAN) -> Machine:
    """A machine from labelled rows outside the evaluation fold."""
    spark = df.sparkSession
    ship(spark)
    marked = (labels.select(F.col(quoted(label_id)).alias("id"), F.col(quoted(label_col)).cast("int").alias("y"))
              .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
              .groupBy("id").agg(F.max("y").alias("y")))
    size = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return Machine(constant=1.0 if 1 in size else 0.0)
    limit = {1: sample_toxic, 0: sample_clean}
    picked = [marked.filter((F.col("y") == y) & hash_share(F.xxhash64("id"), n, size[y]))
              .orderBy(F.xxhash64("id"), "id").limit(n) for y, n in limit.items()]
    sample = picked[0].unionByName(picked[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column(0))
            for a, b in slices(texts):
                own = [np.array(sorted(set(terms(t))), dtype=np.int32) for t in texts.slice(a, b - a).to_pylist()]
                wide = [r.astype(np.int64) for r in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.list_(pa.int32())), batch.column(1).slice(a, b - a),
                     pa.array([is_held(r) for r in wide], pa.bool_()),
                     pa.array([[len(r), int(r.sum()), int(r[len(r) // 2]) if len(r) else 0] for r in wide], pa.list_(pa.int64()))],
                    names=["terms", "y", "held", "key"])

    # the sample's ids are bounded by its two parameters, so they go to the texts
    docs = df.select(F.col(quoted(id_col)).alias("id"), text_or_empty(text_col).alias("text"))
    one = docs.join(F.broadcast(sample), "id").groupBy("id", "y").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))     # a text per id, chosen where the rows are
    found = written(one.select("t.text", "y").mapInArrow(run, "terms array<int>, y int, held boolean, key array<long>"),
                    "toxicity-sample")
    seen = {r["y"]: r["n"] for r in found.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen:
        return Machine(constant=0.0)
    n1, n0 = max(1, seen.get(1, 0)), max(1, seen.get(0, 0))
    weight = {1: size[1] / n1, 0: size[0] / n0}
    if len(seen) < 2:
        return Machine(constant=float(1 in seen))
    counts = (found.select(F.explode("terms").alias("term"), "y").groupBy("term")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).filter(F.col("n") >= MIN_ROWS).toArrow())
    kinds, n, toxic = (counts[c].to_numpy().astype(np.int64) for c in ("term", "n", "toxic"))
    alone = kinds[telling(toxic, n, n1, n0)]
    able = np.sort(kinds[n >= PAIR_MIN])
    near = [found.filter(F.col("y") == k).orderBy(F.xxhash64("key", "terms")).limit(PAIR_ROWS) for k in (1, 0)]
    pairs = sets_of(near[0].unionByName(near[1]), able, PAIR_TERMS)
    chosen = np.union1d(alone, able[interacting(*pair_rows(*pairs[:2]))])
    sets, y, held = sets_of(found, chosen)
    scale = np.where(y == 1, weight[1], weight[0])
    return fitted(chosen, sets, y, scale / scale.mean(), held)


def sets_of(found: DataFrame, chosen: np.ndarray, most: int | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of every sampled document the positions of its terms in the sorted
    ``chosen``, its label and whether it is held back; documents of more than
    ``most`` such terms are left out where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [among(np.array(t, dtype=np.int64), chosen).astype(np.int32) for t in batch.column(0).to_pylist()]
            keep = pa.array([most is None or len(r) <= most for r in own], pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), *batch.columns[1:]],
                                             names=["at", "y", "held", "key"]).filter(keep)

    got = found.mapInArrow(run, "at array<int>, y int, held boolean, key array<long>").toArrow()
    lists, keys = got["at"].combine_chunks(), got["key"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists, keys = (pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], x.type) for x in (lists, keys))
    flat, at = lists.values.to_numpy().astype(np.int64), lists.offsets.to_numpy()
    rows = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
    y, held = got["y"].to_numpy(), got["held"].to_numpy()
    key = keys.values.to_numpy()[keys.offsets.to_numpy()[0]:].reshape(-1, 3)
    order = np.lexsort((y, key[:, 2], key[:, 1], key[:, 0]))  # the same machine however Spark ordered the rows
    return [rows[i] for i in order], y[order].astype(float), held[order].astype(bool)


class Scorer:
    """Scores texts; the terms of each distinct piece are looked up once."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _piece(self, piece: str) -> tuple[int, ...]:
        own = self.pieces.get(piece)
        if own is None:
            index = self.machine.index
            own = self.pieces[piece] = tuple(index[t] for t in terms(piece) if t in index)
        return own

    def scores(self, texts: pa.Array) -> np.ndarray:
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
        cut = pc.split_pattern(texts, " ")  # words never hold a space
        at = cut.offsets.to_numpy()
        code = cut.values.dictionary_encode()
        codes = code.indices.to_numpy(zero_copy_only=False)
        own = [self._piece(p) for p in code.dictionary.to_pylist()]
        any_ = np.array([bool(x) for x in own] or [False])
        rows = []
        for k in range(len(texts)):
            mine = codes[at[k]:at[k + 1]]
            rows.append(np.array(sorted({i for c in set(mine[any_[mine]].tolist()) for i in own[c]}), dtype=np.int64))
        return self.machine.score(rows) if rows else np.zeros(0)


def score(text: Column, machine: Machine) -> Column:
    """The score of a text column, 0 to 1."""
    scorer: list[Scorer] = []

    @F.arrow_udf("double")
    def toxicity_score(texts: pa.Array) -> pa.Array:
        if not scorer:
            scorer.append(Scorer(machine))
        texts = strings(texts)
        parts = [scorer[0].scores(texts.slice(a, b - a)) for a, b in slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return toxicity_score(text)


def rate(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         label_id: str = "doc_id", label_col: str = "toxic", machine: Machine | None = None) -> DataFrame:
    """``id, held_out, score`` for every row."""
    ship(df.sparkSession)
    machine = train(df, labels, id_col, text_col, label_id, label_col) if machine is None else machine
    own = F.col(quoted(id_col))
    return df.select(own.alias("id"), held_out(own).alias("held_out"), score(text_or_empty(text_col), machine).alias("score"))
