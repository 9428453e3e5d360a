import public_tokenizers
import pytest
from canopy.llm import token_counts
from canopy.llm.queries import QUERIES
from tokenizers import Tokenizer

from .conftest import SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(sections, rule):
    """Counts by walking the library's own offsets, character by character."""
    text = "".join(sections)
    owner = [k for k, s in enumerate(sections) for _ in s]
    counts = [0] * len(sections)
    for a, b in TOKENIZER.encode(text, add_special_tokens=False).offsets:
        own = owner[a:b]
        best = own[0] if rule == "first" else own[-1] if rule == "last" else max(sorted(set(own)), key=own.count)
        counts[best] += 1
    return counts


def lines(text):
    parts = text.split("\n")
    return [p + "\n" for p in parts[:-1]] + parts[-1:]


def test_query(spark, documents):
    got = {}
    for r in QUERIES["op8_token_counts"](spark, SF).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got) == len(documents)
    for i, text in documents:
        own = sorted(got[i], key=lambda r: r["section"])
        assert [r["n_tokens"] for r in own] == plain(lines(text or ""), "first")
        assert sum(r["n_tokens"] for r in own) == own[0]["doc_tokens"]
        assert [(text or "")[r["start"]:r["end"]] for r in own] == lines(text or "")


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_crossing_tokens(spark, rule):
    texts = ["a\n\nb\n\n\n", "\n" * 50, "é日\n本😀\n\n x", "one\n two\n", "", "x\r\n\r\n\ry"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in token_counts.token_counts(df, rule=rule).collect():
        got.setdefault(r["id"], {})[r["section"]] = r["n_tokens"]
    for k, text in enumerate(texts):
        assert [got[k][i] for i in sorted(got[k])] == plain(lines(text), rule)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_fields(spark, rule):
    rows = [(1, "a title", "and a body\n", None), (2, None, None, None), (3, "é", "", "日本")]
    df = spark.createDataFrame(rows, "doc_id long, title string, body string, n_tokens string")
    got = {}
    for r in token_counts.token_counts(df, fields=("title", "body", "n_tokens"), rule=rule, separator="\n\n").collect():
        got.setdefault(r["id"], {})[r["section"]] = r["n_tokens"]
    for i, *fields in rows:
        own = [f or "" for f in fields]
        assert [got[i][k] for k in range(3)] == plain([own[0] + "\n\n", own[1] + "\n\n", own[2]], rule)


def test_odd_rows(spark, odd, odd_rows, none):
    assert token_counts.token_counts(odd).count() == sum((r[1] or "").count("\n") + 1 for r in odd_rows)
    assert token_counts.token_counts(none).count() == 0
    with pytest.raises(ValueError):
        token_counts.token_counts(odd, rule="middle")
