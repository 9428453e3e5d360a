import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from canopy.llm import packing
from canopy.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .conftest import SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, docs, window=4096):
    """Pieces of one id may stem from several rows; compares id sequences by checksum."""
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(ids_of(t))
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
        assert any(len(own) == p["doc_tokens"] and zlib.crc32(
            np.array(own[p["start"]:p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"]
            for own in want[p["doc_id"]])
    total = sum(len(x) for own in want.values() for x in own)
    assert sum(p["length"] for p in pieces) == total
    for k, own in by_sequence.items():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at == own[0]["sequence_length"] == (window if (k + 1) * window <= total else total % window)
    assert sorted(by_sequence) == list(range(-(-total // window)))


def test_query_equals_tokenizer(spark, documents):
    check([r.asDict() for r in QUERIES["op1_packing"](spark, SF).collect()], documents)


def test_odd_rows(spark, odd, odd_rows):
    pieces = packing.digests(packing.pack(odd, window=64)).collect()
    check([p.asDict() for p in pieces], [(r[0], r[1]) for r in odd_rows], window=64)


def test_empty_table(spark, none):
    assert packing.pack(none).count() == 0


def test_sequences_hold_the_pieces(spark, odd):
    pieces = packing.pack(odd, window=64)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(pieces).collect()}
    for p in pieces.collect():
        a = 4 * p["offset"]
        assert whole[p["sequence_id"]][a:a + 4 * p["length"]] == bytes(p["ids"])


def test_padding(spark):
    got = spark.createDataFrame([(4096,), (100,), (512,), (1,)], "n long").select(
        packing.padding(packing.F.col("n")).alias("p")).collect()
    assert [r["p"] for r in got] == [0, 3996, 0, 0]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB'sSt 1é́ΣİK\n\t\u00a0<|>!日ß")) , max_size=40))
def test_words_equal_tokenizer(text):
    import pyarrow as pa
    got = next(iter(packing.word_tokens().encode_arrow(pa.array([text]))))
    assert np.frombuffer(got, "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
