"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard.

A document is its set of distinct word shingles. Two permutations make the
whole signature: the first scatters the shingles, the second ranks them, and
coordinate ``k`` uses the second one shifted circularly by ``k``:

    h_k(S) = min over s in S of  pi((sigma(s) + k) mod D),   D = 2^32

so no further hash functions are needed. ``BANDS`` bands of ``ROWS``
coordinates find the candidates: a pair at the least allowed similarity of 0.8
is missed with probability (1 - 0.8^5)^40, about 1e-7.

Documents with equal sets are one node from the start (a digest of the set),
so exact copies cost one row however many there are. Within a band's bucket
candidates are not expanded into pairs: first every node is compared with one
center only, the node of its buckets that meets the most others (the original
of a group of edited copies meets nearly all of them). Links are confirmed on
the full sets, and components are formed. Only buckets that still hold more
than one component need more: there, the nodes outside the bucket's largest
component are compared with the nodes of the other components, if the set
sizes allow the similarity at all. Small buckets do so by distinct pairs.

Nodes of large buckets are screened first, over all bands at once
(:func:`screened`): with shingles in one order, rare ones first, two similar
sets share a shingle of their prefixes, and what follows the first one they
share must be large enough for both. A node that no other component's sizes
fit at any of its prefix shingles can have no link and goes; families of one
template that are not similar enough go whole. What is left meets one more
center a round, of another component, as long as that links one node of
``STAR_GAIN``, at most ``STAR_ROUNDS`` times. The rest is dealt into
blocks, bounded by nodes and by shingles, and a task compares one block of the
outsiders with one block of the bucket, so no pair is ever written out and no
group is larger than two blocks. Pairs inside one component need no test, so
no link between different texts is lost.

Components come from alternating large-star and small-star steps on the
confirmed links, written to the shared scratch folder between the rounds.

Defined results: a null text has no words; a text without words has an empty
set, is linked with nothing and stays; fewer words than a shingle form one
shingle, the whole sequence; a null id never names a component unless all ids
of the component are null; rows that repeat an id are each judged by their own
text; an empty table gives no rows. Other columns are not read by
:func:`near_duplicates` and carried by :func:`drop_near_duplicates`, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import quoted, release, ship, slices, strings, text_or_empty

# --- production parameters ---
SHINGLE_WORDS = 5
LEAST_PERCENT = 80
BANDS, ROWS = 40, 5
PAIRED_BUCKET = 32    # nodes up to which a bucket's open pairs are listed one by one
BLOCK_NODES = 512     # nodes of a larger bucket that a task has on each side
BLOCK_SHINGLES = 1 << 20  # and their shingles, but for a single larger set
RANK_CELLS = 1 << 20  # counters that order the shingles; all that the driver sees of them
PART_ROWS = 4096      # prefix rows of one shingle that a task looks up together
STAR_ROUNDS = 3       # rounds of centers in large buckets before the blocks, which do the rest
STAR_GAIN = 10        # a round that links fewer than one node of these is the last
HOT_CELLS, HOT_PARTS = 1 << 14, 1024  # cells that keys are counted in; a key's part has about 1 / HOT_PARTS of all rows
# --- end of parameters ---

#: Signature cells that are worked on together.
CELLS = 1 << 20
_SEED, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sigma(x: np.ndarray) -> np.ndarray:
    """The first permutation of ``0 .. 2^32 - 1``."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def pi(x: np.ndarray) -> np.ndarray:
    """The second permutation; changes ``x`` in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z lower-cased, words
    between ASCII white space)."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    at = cut.offsets.to_numpy()
    code = cut.values.dictionary_encode()
    codes = code.indices.to_numpy(zero_copy_only=False)
    kinds = code.dictionary.cast(pa.binary()).to_pylist()
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in kinds] or [0], dtype=np.uint64)
    empty = np.array([not w for w in kinds] or [True])
    out = []
    for k in range(len(texts)):
        mine = codes[at[k]:at[k + 1]]
        h = own[mine[~empty[mine]]]
        if not len(h):
            out.append(h)
            continue
        size = min(words, len(h))
        acc = np.full(len(h) - size + 1, size, dtype=np.uint64)
        for j in range(size):
            acc = mix64(acc * _STEP + h[j:len(h) - size + 1 + j])
        out.append(np.unique(acc))
    return out


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """``size`` circulant MinHash coordinates of a nonempty set."""
    spread = sigma((shingles >> np.uint64(32)).astype(np.uint32))
    shift = np.arange(size, dtype=np.uint32)[:, None]
    low = np.full(size, np.uint32(0xFFFFFFFF))
    step = max(1, CELLS // size)
    for a in range(0, len(spread), step):
        np.minimum(low, pi(spread[None, a:a + step] + shift).min(axis=1), out=low)
    return low


def bands(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    parts = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * _SEED)
    for j in range(ROWS):
        key = mix64(key * _STEP + parts[:, j])
    return key.view(np.int64)


def signatures(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``id, text_hash, n, node, bands`` per row; ``node`` is a digest of the set."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column(2))
            for a, b in slices(texts):
                sets = shingle_sets(texts.slice(a, b - a), words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([bands(signature(s)) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                    names=["id", "text_hash", "n", "node", "bands"])
            release()

    return (_docs(df, id_col, text_col)
            .mapInArrow(run, f"id {kind}, text_hash long, n long, node binary, bands array<long>"))


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (df.select(F.col(quoted(id_col)).alias("id"), text_or_empty(text_col).alias("text"))
            .select("id", F.xxhash64("text").alias("text_hash"), "text"))


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, least_percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough; ``texts`` has the
    ``node, text`` of every node in them."""
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        for batch in batches:
            lefts, rights = strings(batch.column(2)), strings(batch.column(3))
            for i, j in slices(pc.binary_join_element_wise(lefts, rights, "")):
                names = batch.column(0).slice(i, j - i).to_pylist()
                if len(held) > 64:
                    held.clear()
                fresh = {n: k for k, n in enumerate(names) if n not in held}  # a center meets many members
                held.update(zip(fresh, shingle_sets(lefts.slice(i, j - i).take(pa.array(list(fresh.values()), pa.int64())), words)))
                good = []
                for n, right in zip(names, shingle_sets(rights.slice(i, j - i), words)):
                    left = held[n]
                    common = len(np.intersect1d(left, right, assume_unique=True))
                    good.append(100 * common >= least_percent * (len(left) + len(right) - common))
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).filter(keep), batch.column(1).slice(i, j - i).filter(keep)],
                    names=["a", "b"])
            release()

    return both.mapInArrow(run, "a binary, b binary")


def spread_join(rows: DataFrame, side: DataFrame, key: str, counted: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with the one row per ``key`` in ``side``, no key in one task.

    The rows (those of ``counted``, if it has the same keys and is cheaper to
    read) are counted by ``HOT_CELLS`` cells of the key; rows of a cell with
    more than its share are dealt over parts by node. The driver gets those
    cells only, ``HOT_PARTS`` at most, and puts them into the expression."""
    cell = F.pmod(F.xxhash64(key), F.lit(HOT_CELLS))
    met = (rows if counted is None else counted).groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("met"))
    all_ = F.sum("met").over(Window.partitionBy(F.lit(0)))
    hot = met.select("_cell", F.floor(F.col("met") * HOT_PARTS / all_).alias("_parts")).filter("_parts > 0").collect()
    parts = parts_of([(r["_cell"], r["_parts"]) for r in hot])
    left = rows.withColumn("_cell", cell).withColumn("_part", F.pmod(F.xxhash64("node"), parts))
    right = side.withColumn("_cell", cell).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    return left.drop("_cell").join(right.drop("_cell"), [key, "_part"]).drop("_part")


def parts_of(hot: list[tuple[int, int]]) -> Column:
    """Into how many parts the rows of ``_cell`` are dealt: a power of two above
    the shares that the cell has, one for the cells that are not in ``hot``."""
    classes: dict[int, list[str]] = {}
    for at, shares in sorted(hot):
        classes.setdefault(1 << int(shares).bit_length(), []).append(str(at))
    cases = " ".join(f"WHEN _cell IN ({', '.join(cells)}) THEN {n}L" for n, cells in sorted(classes.items()))
    return F.expr(f"CASE {cases} ELSE 1L END" if cases else "1L")


def labelled(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``band, node, n, component`` of the rows; a node without links is its own component."""
    return rows.select("band", "node", "n").join(joined, "node", "left").select(
        "band", "node", "n", F.coalesce("component", "node").alias("component"))


def opened(held: DataFrame, counted: DataFrame) -> DataFrame:
    """The rows ``band, node, n, component`` of buckets with several components,
    with ``size`` and ``weight`` (shingles) of the bucket and of the part
    ``outside`` its largest component, and whether the node is an ``outsider``."""
    sizes = held.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"))
    largest = sizes.groupBy("band").agg(
        F.count(F.lit(1)).alias("components"), F.sum("size").alias("size"), F.sum("weight").alias("weight"),
        F.max(F.struct("size", "component", "weight")).alias("main")).filter("components > 1")
    largest = largest.select("band", "size", "weight", (F.col("size") - F.col("main.size")).alias("outside"),
                             (F.col("weight") - F.col("main.weight")).alias("outside_weight"),
                             F.col("main.component").alias("main"))
    return spread_join(held, largest, "band", counted).withColumn("outsider", F.col("component") != F.col("main"))


def stars(open_: DataFrame) -> DataFrame:
    """``a, b``: each node and one center of its buckets, an outsider of another
    component. The same node is center wherever it is the first by its hash."""
    center = F.struct(F.xxhash64("node").alias("spot"), "node", "component")
    best = open_.filter("outsider").groupBy("band").agg(F.max(center).alias("center"))
    return (spread_join(open_, best, "band").filter("component <> center.component").groupBy("node")
            .agg(F.max("center").alias("center")).select(F.col("center.node").alias("a"), F.col("node").alias("b")))


def stored_sets(open_: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``node, component, n, shingles`` of the nodes in ``open_``, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = strings(batch.column(3))
            for a, b in slices(whole):
                sets = [s.view(np.int64) for s in shingle_sets(whole.slice(a, b - a), words)]
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in range(3)]
                    + [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))],
                    names=["node", "component", "n", "shingles"])
            release()

    asked = open_.select("node", "component", "n").distinct().join(texts, "node").select("node", "component", "n", "text")
    return written(asked.mapInArrow(run, "node binary, component binary, n long, shingles array<long>"), "sets")


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each of ``RANK_CELLS`` cells occur. Cells are
    shared, so a count is never too small for a shingle; the size is fixed."""
    met = (sets.select(F.explode("shingles").alias("shingle"))
           .groupBy(F.pmod("shingle", F.lit(RANK_CELLS)).alias("cell")).agg(F.count(F.lit(1)).alias("met")).toArrow())
    counts = np.zeros(RANK_CELLS, np.int32)
    counts[met["cell"].to_numpy()] = np.minimum(met["met"].to_numpy(), np.iinfo(np.int32).max)
    return counts


def prefix(own: np.ndarray, counts: np.ndarray, least_percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefix shingles of a set, rare cells first, and for each the largest
    partner that fits if it is the first shingle they share.

    A partner shares at least ``least_percent`` of the set, so one of these; of
    sets of ``n`` and ``m`` shingles that share ``c``, ``(100 + p) c >= p (n + m)``,
    and ``c`` is at most what is left of the order from the first shared one."""
    n = len(own)
    order = np.lexsort((own, counts[own % RANK_CELLS]))[:n + (-n * least_percent) // 100 + 1]
    largest = (100 + least_percent) * (n - np.arange(len(order))) // least_percent - n
    able = 100 * largest >= least_percent * n
    return own[order[able]], largest[able]


def prefixes(sets: DataFrame, counts: np.ndarray, least_percent: int) -> DataFrame:
    """``shingle, class, parts, node, c1, c2, n, largest`` per prefix shingle of
    each set: partners are in the next size class at most, ``parts`` says into
    how many parts the shingle's rows are dealt, ``c1, c2`` are the component."""
    span = np.log(1.01 * 100 / least_percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy().view(np.uint64)
            for k in range(batch.num_rows):
                own = flat[ends[k]:ends[k + 1]]
                heads, largest = prefix(own, counts, least_percent)
                half = np.frombuffer(batch.column(1)[k].as_py(), np.int64)
                for a in range(0, len(heads), CELLS // 8):
                    head = heads[a:a + CELLS // 8]
                    size = len(head)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(head.view(np.int64)), pa.array(np.full(size, int(np.log(len(own)) / span), np.int32)),
                         pa.array(counts[head % RANK_CELLS].astype(np.int64) // PART_ROWS + 1),
                         pa.repeat(batch.column(0)[k], size), pa.array(np.full(size, half[0])), pa.array(np.full(size, half[1])),
                         pa.array(np.full(size, len(own), np.int64)), pa.array(largest[a:a + CELLS // 8])],
                        names=["shingle", "class", "parts", "node", "c1", "c2", "n", "largest"])
            release()

    return sets.select("node", "component", "shingles").mapInArrow(
        run, "shingle long, class int, parts long, node binary, c1 long, c2 long, n long, largest long")


def screened(open_: DataFrame, sets: DataFrame, least_percent: int) -> DataFrame:
    """The rows of ``open_`` whose node may have a link to another component.

    Of every shingle and size class only bounds are kept (two components or
    not, least size, largest partner), so a shingle of very many nodes is
    aggregated before the shuffle; its rows are dealt over parts for the look-up."""
    rows = prefixes(sets, shingle_counts(sets), least_percent)
    near = F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class")
    bounds = rows.select("shingle", near, "parts", "c1", "c2", "n", "largest").groupBy("shingle", "class").agg(
        F.max("parts").alias("parts"), F.min("c1").alias("c1"), F.max("c1").alias("d1"), F.min("c2").alias("c2"),
        F.max("c2").alias("d2"), F.min("n").alias("least_n"), F.max("largest").alias("most"))
    bounds = bounds.filter("(c1 <> d1 or c2 <> d2) and most >= least_n").select(
        "shingle", "class", "least_n", "most", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    asks = rows.select("shingle", "class", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), "node", "n", "largest")
    able = (asks.join(bounds, ["shingle", "class", "part"]).filter("largest >= least_n and n <= most")
            .select("node").distinct())
    return open_.join(able, "node", "left_semi")


def blocks_of(nodes: str, shingles: str) -> Column:
    """Into how many blocks that many nodes with that many shingles are dealt."""
    return F.greatest(F.ceil(F.col(nodes) / BLOCK_NODES), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("long")


def between_blocks(open_: DataFrame, sets: DataFrame, least_percent: int) -> DataFrame:
    """Links ``a, b`` between different components of large buckets, enough to
    join all components that are linked. Outsiders are dealt into blocks and
    meet every block of their bucket."""
    lefts, rights = blocks_of("outside", "outside_weight"), blocks_of("size", "weight")
    spot = F.xxhash64("node")
    sides = open_.select("*", lefts.alias("lefts"), rights.alias("rights"), spot.alias("spot"))
    left = sides.filter("outsider").select(
        "band", "node", "component", F.pmod("spot", "lefts").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)).alias("j"), F.lit(True).alias("asks"))
    right = sides.select(
        "band", "node", "component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)).alias("i"),
        F.pmod("spot", "rights").alias("j"), F.lit(False).alias("asks"))
    rows = left.unionByName(right).join(sets.select("node", "shingles"), "node")

    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        nodes, comps = table["node"].to_pylist(), table["component"].to_pylist()
        sets = [own.values.to_numpy().view(np.uint64) for own in table["shingles"]]
        ask, has = np.flatnonzero(asks), np.flatnonzero(~asks)
        flat = np.concatenate([sets[k] for k in has]) if len(has) else np.zeros(0, np.uint64)
        size = np.array([len(sets[k]) for k in has], dtype=np.int64)
        owner = np.repeat(np.arange(len(has)), size)
        found = []
        for k in ask:
            own = sets[k]
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            common = np.bincount(owner[own[at] == flat], minlength=len(has))
            done = {comps[k]}  # one link to each other component is enough
            for m in np.flatnonzero(100 * common >= least_percent * (len(own) + size - common)):
                if comps[has[m]] not in done:
                    done.add(comps[has[m]])
                    found.append((nodes[k], nodes[has[m]]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})

    return rows.groupBy("band", "i", "j").applyInArrow(run, "a binary, b binary")


def written(df: DataFrame, name: str) -> DataFrame:
    """The table after a write to the shared scratch folder, without lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every linked node, by alternating star steps;
    the component is its least node."""
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(down.select("a", F.col("m").alias("b"))).distinct())
        edges = written(small, "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row."""
    classes = near_duplicate_classes(df, id_col, text_col, words, least_percent)
    return classes.select("id", F.col("n").alias("n_shingles"), "component_id",
                          F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicate_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           words: int = SHINGLE_WORDS, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """``id, text_hash, n, component, component_id`` for every row; ``component``
    is null for a text without words."""
    ship(df.sparkSession)
    rows = written(signatures(df, id_col, text_col, words), "signatures")
    nodes = written(rows.filter("n > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "nodes")
    listed = nodes.select("node", "n", F.explode("bands").alias("band"))
    shared = listed.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = written(listed.join(shared, "band"), "buckets")

    # texts of the nodes that share a bucket, found by the text's own set
    needed = buckets.select("node").distinct()
    keyed = rows.groupBy("node").agg(F.min("text_hash").alias("text_hash")).join(needed, "node", "left_semi")
    texts = written(_texts(df, id_col, text_col, words, keyed), "texts")

    met = F.struct("met", "node")
    ranked = buckets.join(buckets.groupBy("node").agg(F.sum("size").alias("met")), "node").select("band", "node", met.alias("own"))
    best = ranked.groupBy("band").agg(F.max("own").alias("center"))
    first = (spread_join(ranked, best, "band", buckets).filter("own < center").groupBy("node").agg(F.max("center").alias("center"))
             .select(F.col("center.node").alias("a"), F.col("node").alias("b")))
    first = written(first, "stars")
    links = written(confirmed(first, texts, words, least_percent), "confirmed")
    joined = components(links)

    # buckets that still hold several components
    open_, blocks, stale = written(opened(labelled(buckets, joined), buckets), "open"), None, False
    is_large = F.col("size") > PAIRED_BUCKET
    if not open_.filter(is_large).isEmpty():
        large = open_.filter(is_large)
        sets = stored_sets(large, texts, words)
        left = screened(large, sets, least_percent).select("band", "node", "n", "component")
        left = written(opened(left, large), "screened")
        for _ in range(STAR_ROUNDS):
            asked = written(stars(left.filter(is_large)), "stars")
            fresh = written(confirmed(asked, texts, words, least_percent), "confirmed")
            links, gained = links.unionByName(fresh), fresh.count()
            stale = gained > 0
            if STAR_GAIN * gained < asked.count() or not gained:
                break
            joined, stale = components(links), False
            left = written(opened(labelled(left, joined), left), "open")
        blocks = between_blocks(left.filter(is_large), sets, least_percent)
        open_ = open_.filter(~is_large).unionByName(left)

    few = open_.filter(F.col("size") <= PAIRED_BUCKET)
    others = few.filter("outsider").select(
        "band", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("component").alias("cx"))
    fits = ((100 * F.least("nx", "n") >= least_percent * F.greatest("nx", "n")) & (F.col("cx") != F.col("component"))
            & (~F.col("outsider") | (F.col("x") < F.col("node"))))
    rest = few.join(others, "band").filter(fits).select(
        F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = confirmed(rest.join(tested, ["a", "b"], "left_anti"), texts, words, least_percent)
    more = written(pairs.unionByName(blocks) if blocks is not None else pairs, "confirmed")
    if stale or not more.isEmpty():
        joined = components(links.unionByName(more))

    of_node = written(nodes.select("node", "id").join(joined, "node", "left").select(
        "node", "id", F.coalesce("component", "node").alias("component")), "named")
    least = of_node.groupBy("component").agg(F.min("id").alias("component_id"))
    named = spread_join(of_node, least, "component").select("node", "component", "component_id")
    return rows.join(named, "node", "left").select(
        "id", "text_hash", "n", "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _texts(df: DataFrame, id_col: str, text_col: str, words: int, keyed: DataFrame) -> DataFrame:
    """``node, text`` of the ``node, text_hash`` rows in ``keyed``."""

    @F.arrow_udf("binary")
    def node_of(texts: pa.Array) -> pa.Array:
        texts, out = strings(texts), []
        for a, b in slices(texts):
            out += [hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    for s in shingle_sets(texts.slice(a, b - a), words)]
        release()
        return pa.array(out, pa.binary())

    # the hash only finds the rows; the text's own node decides
    own = _docs(df, id_col, text_col).join(keyed, "text_hash").select("node", "text").withColumn("own", node_of(F.col("text")))
    return own.filter("own = node").groupBy("node").agg(F.min("text").alias("text"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = SHINGLE_WORDS, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """The documents of ``df`` that stay, with all columns: of every class the
    row whose id names the component (of repeated ids the least text hash), and
    each row without words. Rows that repeat id and text are one document."""
    classes = near_duplicate_classes(df, id_col, text_col, words, least_percent)
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("best")
    kept = (classes.filter("component is not null").groupBy("component").agg(best).select("best.id", "best.text_hash")
            .unionByName(classes.filter("component is null").select("id", "text_hash").distinct()))
    kept = kept.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
    match = F.col(quoted(id_col)).eqNullSafe(kept["_id"]) & (F.xxhash64(text_or_empty(text_col)) == kept["_hash"])
    return df.join(kept, match, "left_semi")
