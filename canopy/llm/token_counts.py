"""Token counts by field or section, attributed through character offsets.

A document is encoded once as a whole, so its total is the total that a model
sees; encoding the sections on their own would give other counts. The tokens'
character spans are then interval-joined with the spans of the sections. Both
lists are sorted and cover the text without gaps, so the join is one merge per
document (a binary search of every token's span in the section starts).

A token that crosses a boundary is allocated by a stated rule:
``"first"`` gives it to the section of its first character, ``"last"`` to that
of its last, ``"most"`` to the section that holds most of its characters (the
earlier one on a tie). Each token is counted exactly once, so the counts of
the sections add up to the document's.

Sections are either the lines of one text column (a line owns its end-of-line
mark) or several columns, joined by a separator that belongs to the field
before it.

Defined results: a null field counts as empty and a section without tokens
is returned with 0; an empty text is one empty section; a character that is
split over several tokens belongs to all of them; repeated rows give repeated
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import VOCABULARY, byte_bpe
from .common import joined, quoted, release, ship, slices, strings, text_or_empty

RULES = ("first", "last", "most")
#: Text whose tokens are attributed together.
TEXT_SLICE = 4 << 20
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.int64()), ("all", pa.int64())]))
_DDL = "array<struct<start:long,end:long,tokens:long,all:long>>"


def token_spans(raw: bytes, ids: np.ndarray, piece_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of every token. Tokens are runs of bytes; a
    token's span covers each character of which it holds a byte."""
    size = piece_len[ids]
    stop = np.cumsum(size)
    data = np.frombuffer(raw, dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[stop - size], character[stop - 1] + 1


def attribute(start: np.ndarray, end: np.ndarray, edges: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section; section ``k`` is ``[edges[k], edges[k + 1])``."""
    sections = len(edges) - 1
    first = np.clip(np.searchsorted(edges, start, side="right") - 1, 0, sections - 1)
    if rule == "first":
        return np.bincount(first, minlength=sections)
    last = np.clip(np.searchsorted(edges, end - 1, side="right") - 1, 0, sections - 1)
    if rule == "last":
        return np.bincount(last, minlength=sections)
    best, most = first.copy(), np.zeros(len(first), dtype=np.int64)
    at = first.copy()
    open_ = np.arange(len(first))
    while len(open_):  # one step per section that the longest token touches
        k = at[open_]
        held = np.minimum(end[open_], edges[k + 1]) - np.maximum(start[open_], edges[k])
        more = held > most[open_]
        best[open_[more]], most[open_[more]] = k[more], held[more]
        at[open_] += 1
        open_ = open_[at[open_] <= last[open_]]
    return np.bincount(best, minlength=sections)


def line_edges(text: str) -> np.ndarray:
    """Section edges of the lines of a text; a line owns its end-of-line mark."""
    edges, at = [0], text.find("\n")
    while at >= 0:
        edges.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array([*edges, len(text)], dtype=np.int64)


def _counted(texts: pa.Array, edges: list[np.ndarray], vocabulary: str, rule: str) -> pa.Array:
    bpe = byte_bpe(vocabulary)
    starts, ends, counts, totals, sizes = [], [], [], [], []
    for raw, ids, edge in zip(texts.cast(pa.binary()).to_pylist(), bpe.encode_arrow(texts).to_pylist(), edges):
        own = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        sizes.append(len(edge) - 1)
        if not len(own):
            counts.append(np.zeros(len(edge) - 1, np.int64))
        else:
            first, end = token_spans(raw, own, bpe.piece_len)
            counts.append(attribute(first, end, edge, rule))
        totals.append(np.full(len(edge) - 1, len(own)))
        starts.append(edge[:-1])
        ends.append(edge[1:])
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    flat = [pa.array(np.concatenate(x).astype(np.int64)) if x else pa.array([], pa.int64())
            for x in (starts, ends, counts, totals)]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(flat, fields=list(_SPANS.value_type))).cast(_SPANS)


def sections(columns: Sequence[Column], vocabulary: str = VOCABULARY, rule: str = "first",
             separator: str = "\n") -> Column:
    """``array<struct<start, end, tokens, all>>``: the lines of one column, or the
    fields when several are given; ``all`` is the document's total."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    @F.arrow_udf(_DDL)
    def count_lines(texts: pa.Array) -> pa.Array:
        texts = strings(texts)
        parts = (texts.slice(a, b - a) for a, b in slices(texts, TEXT_SLICE))
        out = joined((_counted(p, [line_edges(t) for t in p.to_pylist()], vocabulary, rule) for p in parts), _SPANS)
        release()
        return out

    @F.arrow_udf(_DDL)
    def count_fields(text: pa.Array, lengths: pa.Array) -> pa.Array:
        text, parts = strings(text), []
        for a, b in slices(text):
            own = [np.concatenate([[0], np.cumsum(x)]).astype(np.int64) for x in lengths.slice(a, b - a).to_pylist()]
            parts.append(_counted(text.slice(a, b - a), own, vocabulary, rule))
        return joined(parts, _SPANS)

    if len(columns) == 1:
        return count_lines(columns[0])
    held = [F.concat(c, F.lit(separator)) for c in columns[:-1]] + [columns[-1]]
    return count_fields(F.concat(*held), F.array(*[F.length(c) for c in held]))


def token_counts(df: DataFrame, id_col: str = "doc_id", fields: Sequence[str] = ("text",),
                 vocabulary: str = VOCABULARY, rule: str = "first", separator: str = "\n") -> DataFrame:
    """``id, section, start, end, n_tokens, doc_tokens``: one row per section."""
    ship(df.sparkSession)
    own = sections([text_or_empty(f) for f in fields], vocabulary, rule, separator)
    return (df.select(F.col(quoted(id_col)).alias("id"), F.posexplode(own).alias("section", "x"))
            .select("id", F.col("section").cast("long").alias("section"), F.col("x.start").alias("start"),
                    F.col("x.end").alias("end"), F.col("x.tokens").alias("n_tokens"), F.col("x.all").alias("doc_tokens")))
