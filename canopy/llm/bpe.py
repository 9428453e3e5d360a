"""Byte-level BPE by a segment tree over adjacent pair ranks.

A word's symbols are the leaves of a segment tree. Leaf ``i`` holds the key
``rank(symbol i, next symbol) * width + i``, or "no merge". The root is the
smallest key, which is the lowest-ranked pair and, among equal ranks, the
leftmost one. A merge changes three leaves (the pair, its right half, and the
pair before it), so it costs three leaf-to-root paths: a word of ``n`` bytes
is encoded in ``O(n log n)``, also a "word" of 100,000 letters.

The trees of many words are laid side by side in one array and advance
together, one merge a round, until no root holds a mergeable pair. Words are
cut from a text as the vocabulary's own splitting rule says; each distinct
word is encoded once per task.

Defined results: a null text counts as empty and has no tokens; special-token
strings inside a text become their special id, as the tokenizers library does;
decoding replaces invalid UTF-8 as that library does.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import joined, release, slices, strings

VOCABULARY = "byte_bpe_50k.json"

# --- fixed values: the splitting rule of the byte-level vocabulary ---
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end of fixed values ---

#: A space that does not simply start the next word: the text is then split whole.
_ODD_SPACE = re.compile(r" (?=\s|\Z)")
NO_MERGE = np.int64(1) << 62
#: Words kept per worker; the store is emptied when it is full.
CACHE_WORDS = 500_000
#: Text that is cut into words at a time; a larger slice repeats fewer words.
SLICE = 8 << 20
#: Tree cells that advance together.
BATCH_CELLS = 1 << 20


def vocabulary_path(name: str) -> str:
    """The file of a public tokenizer; an absolute path stands for itself."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class ByteBPE:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        import regex
        spec = json.load(open(path, encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.byte_id = np.array([vocab[c] for c in byte_letters()], dtype=np.int64)
        left, right, made = [], [], []
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        keys = (np.array(left, dtype=np.int64) << 32) | np.array(right, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array(made, dtype=np.int64)
        # ranks of the pairs of single bytes, with which every word begins
        self.first_rank = self._rank(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for token, i in vocab.items():
            pieces[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.piece_len = np.array([len(p) for p in pieces], dtype=np.int64)
        self.piece_at = np.concatenate([[0], np.cumsum(self.piece_len)[:-1]])
        self.piece_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.word = regex.compile(SPLIT)
        self.special_split = (re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
                              if self.special else None)
        self.words: dict[str, bytes] = {}

    # ------------------------------------------------------------ one word
    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def _merge(self, raw: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``raw`` (words x width, width a power of two) with ``n`` bytes in
        each row: the ids left after all merges, row after row, and their counts."""
        rows, width = raw.shape
        sym = self.byte_id[raw]
        col = np.arange(width)
        nxt = np.tile(col + 1, (rows, 1))
        prv = np.tile(col - 1, (rows, 1))
        alive = col[None, :] < n[:, None]
        tree = np.full((rows, 2 * width), NO_MERGE, dtype=np.int64)
        rank = self.first_rank[raw[:, :-1].astype(np.int64) * 256 + raw[:, 1:]]
        leaf = np.where((rank >= 0) & alive[:, 1:], rank * width + col[:-1], NO_MERGE)
        tree[:, width:2 * width - 1] = leaf
        k = width // 2
        while k >= 1:
            below = tree[:, 2 * k:4 * k]
            tree[:, k:2 * k] = np.minimum(below[:, 0::2], below[:, 1::2])
            k //= 2
        live = np.flatnonzero(tree[:, 1] < NO_MERGE)
        while len(live):
            root = tree[live, 1]
            i, r = root % width, root // width
            j = nxt[live, i]
            k = nxt[live, j]
            merged = self.made[r]
            sym[live, i] = merged
            alive[live, j] = False
            nxt[live, i] = k
            has_next = k < n[live]
            after = np.where(has_next, k, 0)
            prv[live[has_next], k[has_next]] = i[has_next]
            before = prv[live, i]
            has_before = before >= 0
            before = np.where(has_before, before, i)
            rank = np.where(has_next, self._rank(merged, sym[live, after]), -1)
            tree[live, width + j] = NO_MERGE
            tree[live, width + i] = np.where(rank >= 0, rank * width + i, NO_MERGE)
            at = live[has_before]
            p = before[has_before]
            rank = self._rank(sym[at, p], merged[has_before])
            tree[at, width + p] = np.where(rank >= 0, rank * width + p, NO_MERGE)
            a, b, c = width + j, width + i, width + before
            while a[0] > 1:
                a, b, c = a >> 1, b >> 1, c >> 1
                for x in (a, b, c):
                    tree[live, x] = np.minimum(tree[live, 2 * x], tree[live, 2 * x + 1])
            live = live[tree[live, 1] < NO_MERGE]
        return sym[alive], alive.sum(axis=1)

    def learn(self, words: list[str]) -> None:
        """Encode the given distinct words and keep their ids."""
        raws = [w.encode() for w in words]
        size = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(raws), dtype=np.uint8)
        level = np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64)
        for k in np.unique(level).tolist():
            width, group = 1 << k, np.flatnonzero(level == k)
            step = max(1, BATCH_CELLS // width)
            col = np.arange(width)
            for at in range(0, len(group), step):
                part = group[at:at + step]
                n = size[part]
                cells = np.where(col < n[:, None], flat[np.minimum(start[part, None] + col, len(flat) - 1)], 0)
                ids, counts = self._merge(cells.astype(np.uint8), n)
                own, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                self.words.update(zip([words[i] for i in part.tolist()],
                                      [own[i:j] for i, j in zip([0, *ends], ends)]))

    def _ids_of(self, cut: list[list[str]]) -> list[bytes]:
        """The ids of word lists, each as little-endian unsigned 32-bit integers."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        new = {w for words in cut for w in words if w not in known}
        if new:
            self.learn(list(new))
        return [b"".join(map(known.__getitem__, words)) for words in cut]

    # ------------------------------------------------------------ whole texts
    def _whole(self, text: str) -> bytes:
        """One text of any kind, split as a whole."""
        if not self.special_split or not any(s in text for s in self.special):
            return self._ids_of([self.word.findall(text)])[0]
        out = []
        for part in self.special_split.split(text):
            if part in self.special:
                out.append(np.uint32(self.special[part]).tobytes())
            elif part:
                out.append(self._ids_of([self.word.findall(part)])[0])
        return b"".join(out)

    def encode_arrow(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as binary (little-endian unsigned 32-bit).

        A text whose spaces each start a word can be cut before every space
        without changing its words, so the distinct cuts of a slice are
        encoded once. Other texts are split whole.
        """
        return joined((self._encode_slice(texts.slice(a, b - a)) for a, b in slices(texts, SLICE)), pa.binary())

    def _words_of(self, piece: str) -> tuple[str, ...] | list[str]:
        """The words of a space and a piece without spaces."""
        if piece.isalpha():
            return (" " + piece,)
        if piece[-1:] in (".", ",") and piece[:-1].isalpha():
            return (" " + piece[:-1], piece[-1])
        return self.word.findall(" " + piece) if piece else ()

    def _encode_slice(self, texts: pa.Array) -> pa.Array:
        plain = texts.to_pylist()
        odd = {k: self._whole(t) for k, t in enumerate(plain)
               if _ODD_SPACE.search(t) or any(s in t for s in self.special)}
        cut = pc.split_pattern(texts, " ")
        at = cut.offsets.to_numpy()
        code = cut.values.dictionary_encode()
        codes, pieces = code.indices.to_numpy(zero_copy_only=False), code.dictionary.to_pylist()
        # the first piece of a text has no space before it
        first = self._ids_of([() if k in odd else self.word.findall(pieces[c])
                              for k, c in enumerate(codes[at[:-1]].tolist())])
        ids = self._ids_of([self._words_of(p) for p in pieces])
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        own = size[codes]
        own[at[:-1]] = 0
        tokens = gather(flat, (np.cumsum(size) - size)[codes], own).tobytes()
        ends = (4 * np.concatenate([[0], np.cumsum(own)])[at]).tolist()
        return pa.array([odd[k] if k in odd else first[k] + tokens[ends[k]:ends[k + 1]] for k in range(len(plain))],
                        pa.binary())

    def decode_bytes(self, ids: bytes) -> bytes:
        own = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        return gather(self.piece_bytes, self.piece_at[own], self.piece_len[own]).tobytes()

    def decode_arrow(self, ids: pa.Array) -> pa.Array:
        """The text of each id sequence."""
        return pa.array([None if x is None else self.decode_bytes(x).decode("utf-8", "replace")
                         for x in ids.to_pylist()], pa.string())


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[start : start + size]`` for each range (of
    fewer than 2^31 items)."""
    total = int(size.sum())
    if not total:
        return flat[:0]
    at = np.repeat((start - (np.cumsum(size) - size)).astype(np.int32), size)
    at += np.arange(total, dtype=np.int32)
    return flat[at]


@lru_cache(maxsize=4)
def byte_bpe(vocabulary: str = VOCABULARY) -> ByteBPE:
    """The encoder of a vocabulary, one per worker process."""
    return ByteBPE(vocabulary_path(vocabulary))


def encode(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Token ids of a text column, as binary of little-endian unsigned 32-bit ids."""

    @F.arrow_udf("binary")
    def bpe_encode(texts: pa.Array) -> pa.Array:
        ids = byte_bpe(vocabulary).encode_arrow(strings(texts))
        release()
        return ids

    return bpe_encode(text)


def decode(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The text of an id column that :func:`encode` made."""

    @F.arrow_udf("string")
    def bpe_decode(ids: pa.Array) -> pa.Array:
        return byte_bpe(vocabulary).decode_arrow(ids.cast(pa.binary()))

    return bpe_decode(ids)


def round_trip(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """``struct<ids, text>``: the ids of a text and the text decoded from them.
    (A column of :func:`decode` over :func:`encode` beside the ids themselves
    would be planned as two encodings.)"""

    @F.arrow_udf("struct<ids:binary,text:string>")
    def bpe_round_trip(texts: pa.Array) -> pa.Array:
        own = byte_bpe(vocabulary)
        ids = own.encode_arrow(strings(texts))
        back = own.decode_arrow(ids)
        release()
        return pa.StructArray.from_arrays([ids, back], names=["ids", "text"])

    return bpe_round_trip(text)
