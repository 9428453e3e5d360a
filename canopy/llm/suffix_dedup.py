"""Removal of repeated passages by difference-cover suffix buckets.

A byte is removed when a ``length``-byte string over it also starts in a row
with a smaller id. That asks, for every suffix, which suffixes agree with it in
their first ``length`` bytes. Suffixes are sorted to that depth, one bucket at
a time.

*Sorting a bucket* (:func:`least_owner`). Suffixes are ranked by their first 8
bytes; ties by the 8 bytes before the depth; long ties by the ranks of cover
samples. ``{0, 1, 3}`` is a difference cover of 7: for any two positions there
is an offset below 7 that takes both to sample positions. The samples of a
bucket are ranked once, to 44 bytes, so two suffixes that tie in head and tail
are equal exactly if at their common offset their samples have one rank.
Memory is a few integers per suffix, not its 50 bytes, and a bucket above
``BUCKET`` suffixes is cut by its first bytes and sorted in parts.

*Which suffixes are sorted.* The least hash among the 20-byte grams of a
suffix depends on its first 50 bytes only, so equal suffixes share it. Step one
sends each task's distinct (gram, id) pairs, packed, to the gram's bucket and
keeps the grams that several ids hold. Step two takes the suffixes of shared
grams, neighbours with one gram together as a fragment; of equal fragments in a
task all but the least id's are settled. The others travel, packed, to the
bucket of their gram. There equal fragments are again taken once, and the
suffixes of the distinct ones are sorted. Step three removes the covered bytes;
it reads the texts as step two dealt them out.

*Skew.* A gram that several ids of one task hold is known to be shared; it
sends one pair per task. Equal fragments of one task send one. So a passage that
a third of all rows hold costs its bucket one entry per task. Grams in at least
``HOT_SHARE`` of the rows (a bounded number, as rows have a bounded mean of
grams) come last in the choice of a fragment's bucket, so the unequal suffixes
around such a passage are dealt out by their own neighbourhood.

Defined results: a null text is empty; a text below ``length`` bytes loses
nothing; a null id has no order, so its row loses nothing and takes nothing
from others; rows that repeat an id are neither smaller nor larger than each
other; matches never cross rows; strings are judged on the input; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import gather
from .common import joined, quoted, release, ship, slices, strings, text_or_empty
from .minhash import mix64

# --- production parameters ---
LENGTH = 50
GRAM = 20
#: Text bytes whose grams share a bucket of step one (about a 16th as many pairs).
GRAM_BUCKET = 64 << 20
BUCKET = 1 << 19       # suffixes that are sorted at a time
TASK_BYTES = 3 << 20   # text that a task looks at together
HOT_SHARE = 1 / 256
# --- end of parameters ---

# --- fixed values: a difference cover ---
PERIOD, COVER = 7, (0, 1, 3)
# --- end of fixed values ---
EDGE = 8               # bytes compared directly at head and tail
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 15


# ------------------------------------------------------------------ one bucket
def dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct keys."""
    order = np.argsort(keys)
    own = keys[order]
    step = np.zeros(len(own), dtype=np.int64)
    np.cumsum(own[1:] != own[:-1], out=step[1:])
    rank = np.empty(len(own), dtype=np.int64)
    rank[order] = step
    return rank


def tied(rank: np.ndarray) -> np.ndarray:
    """Whether another suffix has the same rank."""
    return np.bincount(rank)[rank] > 1


def packed(ranks: list[np.ndarray]) -> np.ndarray:
    """One rank for several: equal where all are equal."""
    acc, used = ranks[0].astype(np.uint64), int(ranks[0].max()).bit_length()
    for r in ranks[1:]:
        bits = int(r.max()).bit_length()
        if used + bits > 64:
            acc = dense(acc).astype(np.uint64)
            used = int(acc.max()).bit_length()
        acc = (acc << np.uint64(bits)) | r.astype(np.uint64)
        used += bits
    return dense(acc)


def words_at(buf: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The big-endian 8-byte word at each position."""
    windows = np.lib.stride_tricks.sliding_window_view(buf, EDGE)
    return np.ascontiguousarray(windows[pos]).view(">u8").ravel().astype(np.uint64)


#: For two positions modulo the period, the offset that takes both to samples.
MEET = np.array([[min(o for o in range(PERIOD) if {(a + o) % PERIOD, (b + o) % PERIOD} <= set(COVER))
                  for b in range(PERIOD)] for a in range(PERIOD)])


def least_owner(buf: np.ndarray, pos: np.ndarray, owner: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each suffix start, the least owner of a suffix with the same first
    ``length`` bytes (itself included)."""
    least = owner.copy()
    if len(pos) < 2:
        return least
    head = words_at(buf, pos)
    if len(pos) > BUCKET:  # one part at a time, by the first bytes
        part = mix64(head) % np.uint64(len(pos) // BUCKET + 1)
        for k in range(len(pos) // BUCKET + 1):
            mine = np.flatnonzero(part == k)
            if len(mine) > 1:
                least[mine] = _sorted_bucket(buf, pos[mine], head[mine], owner[mine], length)
        return least
    return _sorted_bucket(buf, pos, head, owner, length)


def _sorted_bucket(buf: np.ndarray, pos: np.ndarray, head: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    least = owner.copy()
    rank = dense(head)
    live = np.flatnonzero(tied(rank))
    if not len(live):
        return least
    rank = packed([rank[live], dense(words_at(buf, pos[live] + (length - EDGE)))])
    keep = tied(rank)
    live, rank = live[keep], rank[keep]
    if not len(live):
        return least
    # cover samples at or after every suffix, ranked to the depth they vouch for
    start, depth = pos[live], length - (PERIOD - 1)
    is_sample = np.zeros(len(buf), dtype=bool)
    for d in COVER:
        is_sample[start + (d - start) % PERIOD] = True
    sample = np.flatnonzero(is_sample)
    steps = [*range(0, depth - EDGE, EDGE), depth - EDGE]
    needed = np.zeros(len(buf), dtype=bool)
    for k in steps:
        needed[sample + k] = True
    every = np.flatnonzero(needed)
    at = np.empty(len(buf), dtype=np.int64)
    at[every] = dense(words_at(buf, every))
    at[sample] = packed([at[sample + k] for k in steps])
    # ties against the first of their group, by the samples at the common offset
    order = np.argsort(rank, kind="stable")
    start, rank, own = start[order], rank[order], owner[live][order]
    first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
    size = np.diff(np.append(first, len(rank)))
    lead = np.repeat(start[first], size)
    offset = MEET[start % PERIOD, lead % PERIOD]
    same = at[start + offset] == at[lead + offset]
    whole = np.logical_and.reduceat(same, first)
    found = own.copy()
    if whole.any():
        pick = np.repeat(whole, size)
        low = np.minimum.reduceat(own, first)
        found[pick] = np.repeat(low, size)[pick]
    if not whole.all():  # several strings share head and tail
        pick = np.flatnonzero(np.repeat(~whole, size))
        s, r, o = start[pick], rank[pick], own[pick]
        # equal suffixes agree at some common offset, whichever sample that is for each of them
        offsets = [(d - s) % PERIOD for d in COVER]
        group = packed([np.tile(r, len(COVER)), np.concatenate([at[s + k] for k in offsets]), np.concatenate(offsets)])
        by = np.argsort(group, kind="stable")
        g = group[by]
        cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        low = np.empty(len(g), own.dtype)
        low[by] = np.repeat(np.minimum.reduceat(np.tile(o, len(COVER))[by], cut), np.diff(np.append(cut, len(g))))
        found[pick] = low.reshape(len(COVER), -1).min(axis=0)
    least[live[order]] = found
    return least


# ------------------------------------------------------------------ grams
def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hashes of the 20 bytes at each position."""
    h, size, power = mix64(buf.astype(np.uint64) + np.uint64(_BASE)), 1, _BASE
    kept = {1: h}
    while size * 2 <= GRAM:
        h = h[:-size] * np.uint64(pow(power, size, 1 << 64)) + h[size:]
        size *= 2
        kept[size] = h
    left = GRAM - size
    for s in sorted(kept, reverse=True):
        if left >= s:
            tail = kept[s]
            n = min(len(h), len(tail) - size)
            h = h[:n] * np.uint64(pow(power, s, 1 << 64)) + tail[size:size + n]
            size, left = size + s, left - s
    return mix64(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    m, size = x, 1
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return m if size == width else np.minimum(m[:len(m) - (width - size)], m[width - size:])


def least_grams(buf: np.ndarray, hot: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix of ``buf`` with ``length`` bytes left: its least gram
    hash, and the same with hot grams placed last."""
    n, width = len(buf) - length + 1, length - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    plain, cold = np.empty(n, np.uint64), None
    if len(hot):
        cold = np.empty(n, np.uint64)
    for a in range(0, n, _BLOCK):
        b = min(n, a + _BLOCK)
        h = gram_hashes(buf[a:b + length - 1])
        low = plain[a:b] = sliding_min(h, width)
        if cold is None:
            continue
        new = np.concatenate([[True], low[1:] != low[:-1]])
        first, last = runs_of(new)
        held = np.repeat(_among(low[first], hot), last - first)
        late = h >> np.uint64(1)
        if held.any():  # only under a hot least gram does it matter which others are hot
            near = np.zeros(len(h) + 1, np.int32)
            np.add.at(near, np.flatnonzero(held), 1)
            np.add.at(near, np.flatnonzero(held) + width, -1)
            ask = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            late[ask[_among(h[ask], hot)]] |= np.uint64(1 << 63)
        cold[a:b] = sliding_min(late, width)
    return plain, plain if cold is None else cold


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted, nonempty array."""
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


class Chunk:
    """Rows that a task looks at together, as one buffer."""

    def __init__(self, ids: np.ndarray, raws: list[bytes], length: int):
        self.ids, self.size = ids, np.array([len(r) for r in raws], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.buf = np.frombuffer(b"".join(raws), dtype=np.uint8)
        n = max(0, len(self.buf) - length + 1)
        self.row = np.repeat(np.arange(len(raws), dtype=np.int32), self.size)[:n]  # the row of each suffix
        self.valid = (np.arange(n) + length <= (self.start + self.size)[self.row]) if n else np.zeros(0, bool)


def runs_of(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last index of the runs that begin where ``breaks`` is true."""
    first = np.flatnonzero(breaks)
    return first, np.append(first[1:], len(breaks))


def chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of at most ``TASK_BYTES`` of text, as large as they get, across batches."""
    held, size = [], 0
    for batch in batches:
        texts = strings(batch.column(column))
        for a, b in slices(texts, TASK_BYTES):
            n = pc.sum(pc.binary_length(texts.slice(a, b - a))).as_py() or 0
            if held and size + n > TASK_BYTES:
                yield _as_one(held, column)
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size += n
    if held:
        yield _as_one(held, column)


def _as_one(held: list[pa.RecordBatch], column: int) -> tuple[pa.RecordBatch, pa.Array]:
    one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return one, strings(one.column(column))


# ------------------------------------------------------------------ step one
def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


_SENT = "bucket int, known boolean, hashes binary, ids binary, counts binary"


def _send_grams(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for one, texts in chunks(batches, 1):
            own = Chunk(one.column(0).to_numpy(), texts.cast(pa.binary()).to_pylist(), length)
            gram, _ = least_grams(own.buf, np.zeros(0, np.uint64), length)
            at = np.flatnonzero(own.valid)
            gram, ids = gram[at], own.ids[own.row[at]]
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (ids[1:] != ids[:-1])
            gram, ids = gram[new], ids[new]
            order = np.lexsort((ids, gram))
            gram, ids = gram[order], ids[order]
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (ids[1:] != ids[:-1])
            gram, ids = gram[new], ids[new]
            if not len(gram):
                continue
            new = np.ones(len(gram), bool)
            new[1:] = gram[1:] != gram[:-1]
            first, last = runs_of(new)
            count = last - first
            out = []
            bucket = (gram[first] >> np.uint64(40)).astype(np.int64) % buckets
            order = np.lexsort((ids[first], bucket))  # ids in order pack well
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in range(buckets):
                mine = order[edges[k]:edges[k + 1]]
                if len(mine):
                    out.append((k, False, _pack(gram[first[mine]]), _pack(np.diff(ids[first[mine]], prepend=0)),
                                _pack(count[mine].astype(np.int32))))
            shared = np.repeat(count > 1, count)  # settled here: every id of the gram is told directly
            if shared.any():
                order = np.argsort(ids[shared], kind="stable")
                g, i = gram[shared][order], ids[shared][order]
                turn += 1
                out.append((turn % buckets, True, _pack(g), _pack(np.diff(i, prepend=0)), b""))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.bool_()), *(pa.array(c, pa.binary()) for c in cols[2:])],
                names=["bucket", "known", "hashes", "ids", "counts"])
            release()
    return run


def _told(ids: np.ndarray, gram: np.ndarray) -> pa.RecordBatch:
    """One row per id with its grams."""
    order = np.lexsort((gram, ids))
    ids, gram = ids[order], gram[order]
    new = np.ones(len(ids), bool)
    new[1:] = ids[1:] != ids[:-1]
    first, last = runs_of(new)
    raw, offsets = gram.astype("<u8").tobytes(), np.append(first, len(ids)) * 8
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[first]), pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)]),
         pa.array(np.zeros(len(first), bool))], names=["id", "grams", "hot"])


def _shared_grams(least_hot: float):
    def bucket(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        gram = np.concatenate([_unpack(r["hashes"], "<u8") for r in rows])
        ids = np.concatenate([np.cumsum(_unpack(r["ids"], "<i8")) for r in rows])
        count = np.concatenate([_unpack(r["counts"], "<i4") for r in rows])
        order = np.argsort(gram)
        gram, ids, count = gram[order], ids[order], count[order]
        new = np.ones(len(gram), bool)
        new[1:] = gram[1:] != gram[:-1]
        first, last = runs_of(new)
        held = np.add.reduceat(count, first) if len(first) else count
        # a gram from two tasks is shared (or lies in two rows of one id, which does no harm)
        tell = (np.repeat(last - first, last - first) > 1) & (count == 1)
        if tell.any():
            yield _told(ids[tell], gram[tell])
        hot = gram[first][held >= least_hot]
        if len(hot):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(hot), pa.int64()), pa.array([h.tobytes() for h in hot.astype("<u8")], pa.binary()),
                 pa.array(np.ones(len(hot), bool))], names=["id", "grams", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["known"]:
                    yield _told(np.cumsum(_unpack(row["ids"], "<i8")), _unpack(row["hashes"], "<u8"))
                    continue
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from bucket(held)
                    held = []
                held.append(row)
        if held:
            yield from bucket(held)
    return run


# ------------------------------------------------------------------ step two
_FOUND = "bucket int, settled boolean, bodies binary, sizes binary, places binary, ids binary, text_hashes binary"


def same_bodies(raw: bytes, start: np.ndarray, size: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each fragment among equal ones, in order of appearance,
    and the least id of each class."""
    seen: dict[bytes, int] = {}
    same = np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), (start + size).tolist())),
                       dtype=np.int64, count=len(start))
    least = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(least, same, ids)
    return same, least


def packed_columns(body, size: np.ndarray, at: np.ndarray, ids: np.ndarray, text_hash: np.ndarray, pick) -> tuple:
    return (_pack(np.frombuffer(body, np.uint8) if isinstance(body, bytes) else body), _pack(size[pick].astype("<i4")),
            _pack(at[pick].astype("<i4")), _pack(ids[pick]), _pack(text_hash[pick]))


def covered_runs(pos: np.ndarray, row: np.ndarray, start: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per row, the byte ranges under sorted suffix starts, as a flat array."""
    if not len(pos):
        return
    new = np.ones(len(pos), bool)
    new[1:] = (row[1:] != row[:-1]) | (pos[1:] > pos[:-1] + length)
    first, last = runs_of(new)
    a, b, r = pos[first] - start[row[first]], pos[last - 1] + length - start[row[first]], row[first]
    cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    for i, j in zip(cut, np.append(cut[1:], len(r))):
        yield int(r[i]), np.stack([a[i:j], b[i:j]], axis=1).ravel()


def _fragments(length: int, hot: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for one, texts in chunks(batches, 2):
            own = Chunk(one.column(0).to_numpy(), texts.cast(pa.binary()).to_pylist(), length)
            text_hash = one.column(1).to_numpy()
            plain, cold = least_grams(own.buf, hot, length)
            told = [np.frombuffer(b"".join(x), dtype="<u8") for x in one.column(3).to_pylist()]
            salt = mix64(np.arange(1, len(told) + 1, dtype=np.uint64))
            known = np.unique(np.concatenate([t ^ s for t, s in zip(told, salt)]))
            pos = np.flatnonzero(own.valid)
            if not len(pos) or not len(known):
                continue
            asked = plain[pos] ^ salt[own.row[pos]]
            new = np.ones(len(asked), bool)
            new[1:] = asked[1:] != asked[:-1]
            first, last = runs_of(new)
            pos = pos[np.repeat(_among(asked[first], known), last - first)]
            if not len(pos):
                continue
            row, key = own.row[pos], cold[pos]
            new = np.ones(len(pos), bool)
            new[1:] = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + 1) | (key[1:] != key[:-1])
            first, last = runs_of(new)
            row, at, size, key = row[first], pos[first], pos[last - 1] + length - pos[first], key[first]
            same, least = same_bodies(own.buf.tobytes(), at, size, own.ids[row])
            settled, at = own.ids[row] > least[same], at - own.start[row]
            out: list[tuple] = []
            if settled.any():
                turn += 1
                out.append((turn % buckets, True, *packed_columns(b"", size, at, own.ids[row], text_hash[row], settled)))
            bucket = (mix64(key) % np.uint64(buckets)).astype(np.int64)
            order = np.flatnonzero(~settled)
            order = order[np.argsort(bucket[order], kind="stable")]
            kinds, edges = np.unique(bucket[order], return_index=True)
            for k, i, j in zip(kinds.tolist(), edges, np.append(edges[1:], len(order))):
                mine = order[i:j]
                body = gather(own.buf, at[mine] + own.start[row[mine]], size[mine])
                out.append((k, False, *packed_columns(body, size, at, own.ids[row], text_hash[row], mine)))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.bool_()), *(pa.array(c, pa.binary()) for c in cols[2:])],
                    names=["bucket", "settled", "bodies", "sizes", "places", "ids", "text_hashes"])
            del own, plain, cold, pos
            release()
    return run


def _bucket_runs(length: int):
    """Sorts one bucket's fragments at a time."""

    def ranges(ids: np.ndarray, text_hash: np.ndarray, pairs: list[np.ndarray]) -> pa.RecordBatch:
        """One row per id and text."""
        order = np.lexsort((text_hash, ids))
        ids, text_hash = ids[order], text_hash[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (text_hash[1:] != text_hash[:-1])
        first, last = runs_of(new)
        raw = [pairs[k].astype("<i4").tobytes() for k in order.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[first]), pa.array(text_hash[first]),
             pa.array([b"".join(raw[i:j]) for i, j in zip(first.tolist(), last.tolist())], pa.binary())],
            names=["id", "text_hash", "pairs"])

    def columns(rows: list[dict]) -> list[np.ndarray]:
        return [np.concatenate([_unpack(r[c], kind) for r in rows]).astype(np.int64) for c, kind in (
            ("sizes", "<i4"), ("places", "<i4"), ("ids", "<i8"), ("text_hashes", "<i8"))]

    def solve(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        raw = b"".join(zstandard.ZstdDecompressor().decompress(r["bodies"]) for r in rows)
        size, at, ids, text_hash = columns(rows)
        start = np.cumsum(size) - size
        same, least = same_bodies(raw, start, size, ids)
        # the distinct fragments, each with the least id that holds it
        one = np.unique(same, return_index=True)[1]
        buf = gather(np.frombuffer(raw, dtype=np.uint8), start[one], size[one])
        begin, count = np.cumsum(size[one]) - size[one], size[one] - length + 1
        row = np.repeat(np.arange(len(one)), count)
        pos = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + begin[row]
        own = least[row]
        hit = least_owner(buf, pos, own, length) < own
        covered = dict(covered_runs(pos[hit], row[hit], begin, length))
        found, pairs = [], []
        for k, (c, a, n, later) in enumerate(zip(same.tolist(), at.tolist(), size.tolist(), (ids > least[same]).tolist())):
            if later:
                found.append(k)
                pairs.append(np.array([a, a + n]))
            elif c in covered:
                found.append(k)
                pairs.append(covered[c] + a)
        if found:
            yield ranges(ids[found], text_hash[found], pairs)
        release()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["settled"]:
                    size, at, ids, text_hash = columns([row])
                    yield ranges(ids, text_hash, list(np.stack([at, at + size], axis=1)))
                    continue
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from solve(held)
                    held = []
                held.append(row)
        if held:
            yield from solve(held)
    return run


# ------------------------------------------------------------------ the operator
def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, text_hash, pairs``: byte ranges that go, as binary of little-endian
    32-bit start and end; a row's ranges may overlap and be in several rows."""
    if length < GRAM + EDGE:
        raise ValueError(f"length must be at least {GRAM + EDGE}")
    spark = df.sparkSession
    ship(spark)
    docs = long_rows(df, id_col, text_col, length)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    buckets = 1 << max(4, (2 * parts - 1).bit_length(), ((size or 0) // GRAM_BUCKET).bit_length())
    sent = docs.select("id", "text").mapInArrow(_send_grams(length, buckets), _SENT)
    told = (sent.repartition(parts, "bucket").sortWithinPartitions("bucket", "known")
            .mapInArrow(_shared_grams(max(3.0, HOT_SHARE * rows)), "id long, grams binary, hot boolean"))
    path = scratch_path(spark, "grams")
    told.write.parquet(path)
    told = spark.read.schema("id long, grams binary, hot boolean").parquet(path)
    # at most (grams of a row on average) / HOT_SHARE of them, whatever the size of the table
    hot = told.filter("hot").select("grams").toArrow()["grams"].to_pylist()
    hot = np.unique(np.frombuffer(b"".join(hot), dtype="<u8").astype(np.uint64))
    by_id = told.filter("not hot").groupBy("id").agg(F.collect_list("grams").alias("grams"))
    asked = docs.join(by_id, "id").select("id", "text_hash", "text", "grams")
    buckets = 1 << max(4, ((size or 0) // (4 * BUCKET)).bit_length())
    found = asked.mapInArrow(_fragments(length, hot, buckets), _FOUND)
    return (found.repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_bucket_runs(length), "id long, text_hash long, pairs binary"))


def long_rows(df: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """The rows that take part."""
    return _docs(df, id_col, text_col).filter(F.col("id").isNotNull() & (F.octet_length("text") >= length))


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (df.select(F.col(quoted(id_col)).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
            .select("id", F.xxhash64("text").alias("text_hash"), "text"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` per row; ``kept`` is the bytes
    that stay (binary, as a cut may fall inside a character)."""
    ranges = (repeated_ranges(df, id_col, text_col, length)
              .groupBy("id").agg(F.collect_list(F.struct("text_hash", "pairs")).alias("ranges")))

    @F.arrow_udf("struct<n_removed:long,n_spans:long,kept:binary>")
    def without(texts: pa.Array, pairs: pa.Array) -> pa.Array:
        texts, removed, spans, kept = strings(texts), [], [], []
        for a, b in slices(texts):
            own = [cut_out(raw, mine or []) for raw, mine in zip(texts.slice(a, b - a).cast(pa.binary()).to_pylist(),
                                                                 pairs.slice(a, b - a).to_pylist())]
            removed += [n for n, _, _ in own]
            spans += [k for _, k, _ in own]
            kept.append(pa.array([rest for _, _, rest in own], pa.binary()))
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                           joined(kept, pa.binary())], names=["n_removed", "n_spans", "kept"])

    size = F.octet_length("text").cast("long").alias("n_bytes")
    own = F.transform(F.filter("ranges", lambda r: r["text_hash"] == F.col("text_hash")), lambda r: r["pairs"])
    # dealt out by id alone, as the join with the grams is, so that exchange is used again
    long = (long_rows(df, id_col, text_col, length).join(ranges, "id", "left")
            .select("id", size, without(F.col("text"), own).alias("r"))
            .select("id", "n_bytes", "r.n_removed", "r.n_spans", "r.kept"))
    none = F.lit(0).cast("long")
    rest = (_docs(df, id_col, text_col).filter(F.col("id").isNull() | (F.octet_length("text") < length))
            .select("id", size, none.alias("n_removed"), none.alias("n_spans"), F.col("text").cast("binary").alias("kept")))
    return long.unionByName(rest)


def cut_out(raw: bytes, pairs: list[bytes]) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs, and what is left."""
    if not pairs:
        return 0, 0, raw
    own = np.frombuffer(b"".join(pairs), dtype="<i4").reshape(-1, 2)
    depth = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(depth, own[:, 0], 1)
    np.add.at(depth, own[:, 1], -1)
    gone = np.cumsum(depth[:-1]) > 0
    return int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes()
