import hashlib
import re
import time

import numpy as np
import pytest
from canopy.llm import pii
from canopy.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st

from .conftest import SF

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def sum_of_card(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (2 if k % 2 else 1)
        total += v // 10 + v % 10
    return total


def plain(text):
    out = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for pattern, kind in ((r"[0-9]([\x20-]?[0-9])+", "card"), (r"\+[0-9][\x20().0-9-]+[0-9]", "phone")):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (12 <= len(d) <= 19 and sum_of_card(d) % 10 == 0) if kind == "card" else 9 <= len(d) <= 15:
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2]), s[1]))


PARTS = [*"ab@.+- ()1204789é%_\n", ".com", "@x.y", "1.2.3.4", "255.", "+1 (78) 555-294", "4111 1111 1111 1111"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_query_equals_patterns(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op7_pii"](spark, SF).collect()}
    assert len(got) == len(documents)
    for i, text in documents:
        spans = plain(text or "")
        base = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in spans) for k in pii.KINDS]
        assert set(base.split(",")) <= set(got[i]["spans"].split(","))


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


@pytest.mark.parametrize("text, kinds", [
    ("write to joe.x at mail dot example dot com please", ["email"]), ("from 10[.]1[.]22[.]7 today", ["ip"]),
    ("pay 4111.1111.1111.1111 now", ["card"]), ("call 555-234-9876 now", ["phone"]),
    ("version 4.0 of 2024-01-15", []), ("on 2021-03-04 12:30:11 it was", []), ("he was at the place of 300", []),
    ("the number 4111111111111112 is", []), ("", [])])
def test_added_spans(model, text, kinds):
    assert [s["kind"] for s in pii.all_spans(text, model)] == kinds


@pytest.mark.parametrize("rows", [[], [(1, "no such thing here, 7 of 9")], [(k, f"write to j{k}@x.de") for k in range(9)]])
def test_every_kind_is_found_whatever_the_table_holds(spark, rows):
    """A table with few or no base spans of a kind finds its spelled forms all the same."""
    own = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    for text, kinds in [("write to joe.x at mail dot example dot com please", ["email"]), ("on 2021-03-04 12:30:11 it was", []),
                        ("from 10[.]1[.]22[.]7 today", ["ip"]), ("pay 4111.1111.1111.1111 now", ["card"]),
                        ("call 555-234-9876 now", ["phone"]), ("version 4.0 of 2024-01-15", [])]:
        assert [s["kind"] for s in pii.all_spans(text, own)] == kinds


def test_sample_holds_rare_kinds(spark):
    """Texts of a rare kind are drawn from all texts, however many others have digits."""
    rows = [(k, f"page {k} of 9") for k in range(3000)] + [(k, f"from 10.1.2.{k} it") for k in range(40)] * 2
    drawn = [r["text"] for r in pii.sample(spark.createDataFrame(rows, "doc_id long, text string"), "text", 200).collect()]
    assert sum("from" in t for t in drawn) == 40 and sum("page" in t for t in drawn) == 40


def test_few_additions_on_generated_text(spark, model):
    """Additions are near-misses of the base, not ordinary text."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["text"], s) for r in pii.find(df, model=model).join(df, pii.F.col("id") == df["doc_id"]).collect()
            for s in r["spans"]]
    added = [(t[s["start"]:s["end"]], s["kind"]) for t, s in rows if not s["base"]]
    assert len(added) <= 0.05 * len(rows)


def test_odd_rows(spark, odd, odd_rows, none, model):
    assert len(pii.find(odd).collect()) == len(odd_rows)  # nothing to learn from: base only
    clean = pii.redact(odd, model=model)
    assert clean.columns == odd.columns and clean.filter("text is null").count() == 2
    assert pii.find(none).count() == 0 and pii.redact(none).count() == 0
    some = spark.createDataFrame([(1, "a b@c.de, +1 (222) 555-1234, 4111111111111111."), (2, "x" * 50000 + "@")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(some, model=model).collect()}
    assert got[1] == "a [EMAIL], [PHONE], [CARD]." and got[2].endswith("x@")


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a." * 100_000 + "@", "+1" * 100_000, "1 " * 100_000):
        pii.base_spans(text)


SPELLED = [" at ", "@", " [ at ] ", "(at)", "[at] ", "at", "joe", "example", ".com", "[dot]com", " (dot) com", " dot ", "7", "write to "]


@pytest.mark.parametrize("text", ["write to joe at example[dot]com", "joe at example (dot) com", "joe at example.com",
                                  "joe [ at ] example.com", "write 7 to joe at example.com"])
def test_spelled_addresses_are_proposed(text):
    assert pii._may_hold(text) and any(k == "email" and text[a:].startswith("joe") for a, _, k in pii.proposals(text))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(SPELLED), max_size=8).map("".join))
def test_gates_drop_no_proposal(text):
    """The same proposals as beside an ``@``, which opens every gate."""
    beside = [s for s in pii.proposals(text + " \n @") if s[1] <= len(text)]
    assert pii.proposals(text) == beside and (pii._may_hold(text) or not beside)


def test_found_whatever_else_the_text_holds(spark, model):
    rows = [(1, "write to joe at example[dot]com"), (2, "write to joe at example[dot]com @ . dot 7")]
    got = {r["id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    assert got[1] == got[2] and [s["kind"] for s in got[1]] == ["email"]


def test_sampled_proposals_are_bounded(spark):
    """A long numeric text sends the driver no more than the bound of each kind and label."""
    long = " ".join(f"{k % 9000 + 1000}" for k in range(20_000))
    texts = spark.createDataFrame([(long, 1), ("from 10.1.2.3 it, a@b.de", 2)], "text string, h long")
    rows = pii.labelled(texts, most=500).collect()
    count = {}
    for r in rows:
        count[r["kind"], r["y"]] = count.get((r["kind"], r["y"]), 0) + 1
    assert max(count.values()) == 500 and {("email", 1), ("ip", 1)} <= set(count)


def chosen_pair_by_pair(model, text, base):
    """The choice by its definition: every proposal against all base spans and all better choices."""
    free = [s for s in pii.proposals(text) if s[2] in model.threshold and not any(a < s[1] and s[0] < b for a, b, _ in base)]
    p = model.probability(np.array([pii.features(text, s) for s in free])) if free else []
    chosen = []
    for prob, s in sorted(zip(p, free), key=lambda x: (-x[0], x[1][0] - x[1][1], x[1])):
        if prob >= model.threshold[s[2]] and not any(a < s[1] and s[0] < b for (a, b, _), _ in chosen):
            chosen.append((s, prob))
    return sorted(chosen)


def test_choice_equals_its_definition(spark, model):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = [r["text"] for r in rows] + [" 555-234-9876 ".join(f"10[.]{k}[.]2[.]3 4111.1111.1111.1111/{k} a at b dot com" for k in range(40)),
                                         " ".join(f"{k % 900 + 100}" for k in range(400))]
    added = 0
    for text in texts:
        base = pii.base_spans(text)
        got = model.added(text, base)
        assert sorted((s, round(p, 9)) for s, p in got) == [(s, round(p, 9)) for s, p in chosen_pair_by_pair(model, text, base)]
        added += len(got)
    assert added > 50


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=12), st.integers(0, 60), st.integers(1, 9))
def test_taken_places(spans, a, n):
    own = [(x, x + k, "ip") for x, k in spans]
    assert pii.Taken(own).meets((a, a + n, "ip")) == any(x < a + n and a < y for x, y, _ in own)


@pytest.mark.parametrize("line", ["10.{0}.2.3 -> 10.1.{0}.9\n", "10[.]{0}[.]22[.]7 to 555-234-98{0:02d}\n"])
def test_many_spans_take_time_in_proportion(model, line):
    """Ten times the addresses take about ten times as long, not a hundred times."""
    def seconds(n):
        text = "".join(line.format(k % 100) for k in range(n))
        began = time.perf_counter()
        found = pii.all_spans(text, model)
        return time.perf_counter() - began, len(found)

    seconds(100)
    few, some = seconds(2_000)
    many, all_ = seconds(20_000)
    assert all_ == 10 * some and many < 25 * few
