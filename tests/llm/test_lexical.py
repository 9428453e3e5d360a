import math
import re
from collections import Counter

import pytest
from canopy.llm import lexical
from canopy.llm.queries import QUERIES

from .conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, places=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    held = Counter(t for _, b in bags for t in b)
    count = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        found = []
        for doc, bag in bags:
            m = 25 + 75 * sum(bag.values()) * count // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * held[t] + 1)))
                    * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms(text) if t in bag)
            if s > 0:
                found.append((-s, doc is None, doc))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[:2], x[2] or 0))[:places])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["item"], r["rank"], r["doc"], r["score"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op11_lexical_search"](spark, SF).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == brute(documents, items)


@pytest.mark.parametrize("bytes_", [1 << 20, 60])
def test_odd_rows(spark, odd, odd_rows, monkeypatch, bytes_):
    """Nulls, ties, repeated rows and items, items in one and in many blocks."""
    monkeypatch.setattr(lexical, "ITEM_BLOCK_BYTES", bytes_)
    monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", 2)
    queries = [(1, "one other"), (1, "one other"), (1, "WORD thing"), (2, None), (3, ""), (None, "é 日本 x one ONE"),
               (4, " ".join(f"t{k}" for k in range(80)) + " g end under")]
    items = spark.createDataFrame(queries, "item_id long, text string")
    got = rows(lexical.search(odd, items, places=3))
    assert got == brute([(r[0], r[1]) for r in odd_rows], queries, 3)


def test_empty_tables(spark, odd, none):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.search(none, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0
    assert lexical.search(odd, spark.createDataFrame([(1, "zzz")], "item_id long, text string")).count() == 0


def test_masks_end_the_search_early(documents):
    """Most documents of a mask that cannot win are never scored, and none that can is lost."""
    import numpy as np
    import pyarrow as pa
    texts = [f"common {'rare' if k % 50 == 0 else 'x'} {'word ' * (k % 7)}" for k in range(4000)]
    items = lexical.item_block([(0, "common rare word")])
    n, count, term, tf = lexical.find_postings(pa.array(texts), pa.array(items.vocabulary, pa.binary()))
    best = lexical.Ranking(items, np.array([1, 4000, 300]), 10)
    best.block(list(range(4000)), 25 + n, term, np.repeat(np.arange(4000), count), tf)
    assert len(best.best[0]) == 10 and all(d % 50 == 0 for _, _, d in best.best[0])
    assert best.scored < 1000 and best.masks == 4
