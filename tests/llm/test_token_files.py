import os
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from canopy.llm import token_files
from canopy.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .conftest import SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def new_path():
    return tempfile.mkdtemp(prefix="canopy-tokens-", dir="/tmp") + "/tokens"


def parts(path):
    return sorted(f"{path}/data/{f}" for f in os.listdir(f"{path}/data") if f.endswith(".parquet"))


def test_query_equals_tokenizer(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op12_token_files"](spark, SF).collect()}
    assert len(got) == len(documents)
    before = 0
    for doc, text in sorted(documents):
        ids = ids_of(text)
        r = got[doc]
        assert (r["start"], r["n_tokens"]) == (before, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        before += len(ids)


def test_odd_rows(spark, odd, odd_rows):
    path = new_path()
    token_files.write(odd, path, shard_bytes=20_000)   # repeated ids spread over shards
    rows = token_files.read(spark, path).orderBy("start").collect()
    assert sorted((r["doc"] is not None, r["doc"] or 0, r["ids"]) for r in rows) == sorted(
        (i is not None, i or 0, ids_of(t)) for i, t, *_ in odd_rows)
    assert [r["doc"] for r in rows] == sorted((i for i, *_ in odd_rows), key=lambda i: (i is not None, i))
    at = 0
    for r in rows:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += r["n_tokens"]
    assert len(parts(path)) > 2


def test_empty_table(spark, none):
    path = new_path()
    token_files.write(none, path)
    assert token_files.read(spark, path).count() == 0
    assert token_files.read_span(spark, path, 0, 10).count() == 0
    assert token_files.read_shards(spark, path).count() == 0


def test_span_equals_the_slice_of_all_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = new_path()
    token_files.write(docs, path, shard_bytes=60_000)
    every = [i for r in token_files.read(spark, path).orderBy("start").collect() for i in r["ids"]]
    for first, last in [(0, 1), (4095, 8200), (len(every) - 5, len(every) + 100), (77, 77), (0, len(every))]:
        rows = token_files.read_span(spark, path, first, last).orderBy("start").collect()
        assert [i for r in rows for i in r["ids"]] == every[first:last]
        assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_layout(spark, monkeypatch):
    """Encodings, row groups of bounded size, and indexes in every column chunk."""
    monkeypatch.setattr(token_files, "ROW_GROUP_BYTES", 64 << 10)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = new_path()
    token_files.write(docs, path, shard_bytes=2 << 20)
    seen = 0
    for f in parts(path):
        meta = pq.ParquetFile(f).metadata
        seen = max(seen, meta.num_row_groups)
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                col = meta.row_group(g).column(c)
                assert col.has_offset_index
                if col.path_in_schema.startswith("ids"):
                    assert any("DICTIONARY" in e for e in col.encodings)
                else:
                    assert col.has_column_index and "DELTA_BINARY_PACKED" in col.encodings
    assert seen > 1


def test_reads_only_what_is_asked(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = new_path()
    token_files.write(docs, path)
    from canopy.plans.inspect import plan_summary
    metadata = plan_summary(token_files.read(spark, path).select("doc", "start", "n_tokens"))
    assert not any("ids" in s for s in metadata["read_schemas"])
    one = plan_summary(token_files.read(spark, path).filter(F.col("doc") == 7))
    assert any("EqualTo(doc,7)" in s for s in one["pushed_filters"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB'sSt 1é́ΣİK\n\t <|>!日ßÀ\x01\x0b")), max_size=30), max_size=4))
def test_slices_equal_tokenizer(texts):
    flat, n = token_files.slice_tokens().encode_slice(pa.array(texts, pa.string()))
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == list(map(len, want)) and flat.tolist() == [i for w in want for i in w]


def test_known_words_are_looked_up_by_arrow(monkeypatch):
    """A slice leaves its distinct words, bare, in one Arrow array; a later one
    adds new words only, and forgetting them changes no id."""
    texts = ["The cat\n\n sat, the\tCAT's hat\r\n \n  ", " \n", "", "naïve café\n42 naïve\n", "don't\nstop \t日本 cat"]
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    tokens = token_files.SliceTokens(public_tokenizers.path("word_bpe_49k.json"))
    for most in (token_files.KEPT_WORDS, 0):
        monkeypatch.setattr(token_files, "KEPT_WORDS", most)
        for _ in range(2):
            flat, n = tokens.encode_slice(pa.array(texts, pa.string()))
            assert n.tolist() == list(map(len, want)) and flat.tolist() == [i for w in want for i in w]
            known = tokens.known.to_pylist()
            assert sorted(known) == sorted({"", "the", "cat", "sat", ",", "'s", "hat", "naïve", "café", "4", "2", "don", "'t", "stop"})
