import hashlib
import random

import numpy as np
import pytest
from canopy.llm import suffix_dedup
from canopy.llm.queries import QUERIES


def brute(docs, length=50):
    """``(n_bytes, n_removed, n_spans, kept)`` per row, by a dictionary of all strings."""
    first, out = {}, []
    raws = [(i, (t or "").encode()) for i, t in docs]
    for i, raw in raws:
        for k in range(len(raw) - length + 1 if i is not None else 0):
            s = raw[k:k + length]
            first[s] = min(i, first.get(s, i))
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1 if i is not None else 0):
            if first[raw[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((str(i), len(raw), sum(gone), spans, bytes(c for c, g in zip(raw, gone) if not g)))
    return sorted(out)


def rows_of(df):
    return sorted((str(r["id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.collect())


def test_query_against_all_strings(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                 for r in QUERIES["op10_suffix_dedup"](spark, sf).collect())
    assert got == [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(docs)]


@pytest.mark.parametrize("bucket, task", [(1 << 19, 3 << 20), (200, 3000)])
def test_passages_copies_and_periods(spark, monkeypatch, bucket, task):
    """Shared passages at every offset, copies, periodic texts; small buckets and tasks too."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", task)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(8, 60))) for _ in range(12)]
    docs = []
    for k in range(150):
        parts = [" ".join(word() for _ in range(rng.randrange(1, 40))), rng.choice(passages)]
        if k % 3 == 0:
            p = rng.choice(passages)
            parts.append(p[rng.randrange(len(p)):])
        if k % 10 == 0:
            parts.append("ab" * rng.randrange(5, 200))
        rng.shuffle(parts)
        docs.append((rng.randrange(120), " ".join(parts)))
    docs += docs[:5] + [(i + 1000, t) for i, t in docs[5:9]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert rows_of(suffix_dedup.remove_repeats(df)) == brute(docs)


def test_hot_passage(spark):
    """One passage in most rows, with different neighbours: the hot grams are set back."""
    rng = random.Random(2)
    line = "the very same line of text that most of the documents here happen to hold somewhere in them"
    noise = lambda: "".join(rng.choice("abcdefghij ") for _ in range(rng.randrange(80)))
    docs = [(k, noise() + (line if k % 4 else "") + noise()) for k in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(11)
    assert rows_of(suffix_dedup.remove_repeats(df)) == brute(docs)


def test_few_partitions_have_buckets_by_size(spark, monkeypatch):
    """One shuffle partition, buckets of a few kilobytes of text: the same result."""
    monkeypatch.setattr(suffix_dedup, "GRAM_BUCKET", 1 << 10)
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdé") for _ in range(6)) for _ in range(40)]
    lines = [" ".join(rng.choices(words, k=14)) for _ in range(30)]
    docs = [(k, " ".join([rng.choice(lines), *rng.choices(words, k=20), rng.choice(lines)])) for k in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows_of(suffix_dedup.remove_repeats(df)) == brute(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_odd_rows(spark, odd, odd_rows, none):
    assert rows_of(suffix_dedup.remove_repeats(odd)) == brute([(r[0], r[1]) for r in odd_rows])
    assert suffix_dedup.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(odd, length=20)


def test_cover():
    for a in range(suffix_dedup.PERIOD):
        for b in range(suffix_dedup.PERIOD):
            assert any((a + o) % suffix_dedup.PERIOD in suffix_dedup.COVER and (b + o) % suffix_dedup.PERIOD in
                       suffix_dedup.COVER for o in range(suffix_dedup.PERIOD))


def test_one_bucket():
    rng = np.random.default_rng(0)
    for trial in range(30):
        buf = rng.integers(97, 97 + int(rng.integers(1, 3)), int(rng.integers(60, 900))).astype(np.uint8)
        if trial % 3 == 0:
            buf = np.tile(buf[:int(rng.integers(3, 70))], 60)[:900]
        pos = np.flatnonzero(rng.random(len(buf) - 49) < 0.8)
        owner, raw, least = rng.integers(0, 9, len(pos)), buf.tobytes(), {}
        for p, o in zip(pos, owner):
            least[raw[p:p + 50]] = min(o, least.get(raw[p:p + 50], o))
        got = suffix_dedup.least_owner(buf, pos, owner)
        assert got.tolist() == [least[raw[p:p + 50]] for p in pos]
