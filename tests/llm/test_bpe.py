import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from canopy.llm import bpe
from canopy.llm.common import text_or_empty
from canopy.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .conftest import SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PARTS = [*"abE'sT 12é́Σ日😀\n\t\r.,!<|>", "  ", " the", "<|endoftext|>", "\u00a0", "\x1c", "\x85", "ing"]


def test_query_equals_library(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op3_bpe"](spark, SF).collect()}
    assert len(got) == len(documents)
    for i, text in documents:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
        back = TOKENIZER.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_any_text_equals_library(text):
    ids = np.frombuffer(bpe.byte_bpe().encode_arrow(pa.array([text])).to_pylist()[0], "<u4").tolist()
    assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_cut_characters_decode_as_library():
    own = bpe.byte_bpe()
    ids = TOKENIZER.encode("日本😀é", add_special_tokens=False).ids
    for k in range(len(ids)):
        part = np.array(ids[k:k + 2], "<u4").tobytes()
        assert own.decode_bytes(part).decode("utf-8", "replace") == TOKENIZER.decode(ids[k:k + 2], skip_special_tokens=False)


def test_odd_rows_round_trip(spark, odd):
    ids = odd.select(text_or_empty("text").alias("t"), bpe.encode(text_or_empty("text")).alias("ids"))
    for r in ids.select("t", bpe.decode(ids["ids"]).alias("back")).collect():
        assert r["t"] == r["back"]


def test_empty_table(spark, none):
    assert none.select(bpe.encode(text_or_empty("text"))).count() == 0


def test_tree_merges_leftmost_lowest_rank():
    """Against merging by a plain scan of the pairs."""
    own, rng = bpe.byte_bpe(), np.random.default_rng(3)
    for _ in range(200):
        raw = bytes(rng.choice(list(b"aethin r"), int(rng.integers(2, 40))).tolist())
        word = own.byte_id[np.frombuffer(raw, np.uint8)].tolist()
        while len(word) > 1:
            rank = own._rank(np.array(word[:-1]), np.array(word[1:]))
            if (rank < 0).all():
                break
            k = int(np.argmin(np.where(rank < 0, 1 << 40, rank)))
            word[k:k + 2] = [int(own.made[rank[k]])]
        own.words.clear()
        own.learn([raw.decode()])
        assert np.frombuffer(own.words[raw.decode()], "<u4").tolist() == word
