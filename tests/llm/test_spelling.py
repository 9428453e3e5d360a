import random
import re
import zlib
from collections import Counter

import pytest
from canopy.llm import spelling
from canopy.llm.queries import QUERIES

from .conftest import SF


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def words_of(docs, one_in):
    for doc, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            yield run


def brute(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, count = {}, {}
    keyed = {}
    for w in words:  # words that may be near share a cut
        for i in range(len(w)):
            keyed.setdefault(w[:i] + w[i + 1:], set()).add(w)
        keyed.setdefault(w, set()).add(w)
    mates = {w: set() for w in words}
    for group in keyed.values():
        for a in group:
            mates[a] |= {b for b in group if near(a, b)}
    for w in words:
        best = min(mates[w], key=lambda b: (-words[b], b), default=None)
        count[w] = len(mates[w])
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], count[w], words.get(form[w])))
    return sorted(out)


def rows(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_query_equals_brute_force(spark, documents):
    assert rows(QUERIES["op13_spelling"](spark, SF)) == brute(Counter(words_of(documents, 97)))


@pytest.mark.parametrize("letters", ["ab", "aé", "abcdé"])
def test_dense_words(spark, letters):
    """Runs of one letter, many neighbours, long paths and equal counts."""
    draw = random.Random(letters)
    texts = [(k, " ".join("".join(draw.choices(letters, k=draw.randint(4, 8))) for _ in range(300))) for k in range(6)]
    texts += [(90 + k, " ".join(["a" * (5 + k)] * 3 * 2 ** k)) for k in range(6)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows(spelling.variants(df, slip_one_in=5))
    assert got == brute(Counter(words_of(texts, 5)))
    assert any(r[2] not in (r[0], r[1]) for r in got)


def test_odd_rows(spark, odd, odd_rows):
    docs = [(r[0], r[1]) for r in odd_rows]
    assert rows(spelling.variants(odd, slip_one_in=3)) == brute(Counter(words_of(docs, 3)))
    assert rows(spelling.variants(odd)) == brute(Counter(words_of(docs, None)))


def test_empty_table(spark, none):
    assert spelling.variants(none).count() == 0


def test_groups_are_bounded_by_the_alphabet(spark):
    """A prefix and the code point behind it name one word: a frequent word adds no row."""
    df = spark.createDataFrame([(1, "house " * 5000 + "mouse " * 5000)], "doc_id long, text string")
    turned = spelling.rotations(spelling.counted(spelling.words(df)))
    assert turned.count() == 2 * (6 + 5)
    assert turned.groupBy("prefix", "last").count().filter("count > 1").isEmpty()
