import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The small generated documents as plain rows, for brute-force versions."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


#: Nulls, empty and white-space texts, repeated rows and ids, columns whose
#: names clash with those that the operators use inside.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, id string, text_hash string, n string, spans string"


@pytest.fixture(scope="session")
def odd_rows():
    long = "word other thing " * 4000 + "end"
    texts = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (4, "one"), (None, "one"), (5, long), (6, long),
             (None, None), (7, "a b c d e f g"), (7, "other text under the same id"), (8, "é ß 日本 \x00 😀"),
             (9, "x" * 20000)]
    return [(i, t, None if k % 2 else "en", None, "clash", "clash", None, "clash") for k, (i, t) in enumerate(texts)]


@pytest.fixture()
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, ODD_SCHEMA)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
