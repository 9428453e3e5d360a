import zlib

import numpy as np
from canopy.llm import toxicity
from canopy.llm.queries import QUERIES


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):  # ties share their mean rank
        rank[score == v] = rank[score == v].mean()
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    y, s = np.array([r["toxic"] for r in held]), np.array([r["score"] for r in held])
    assert auc(s, y) > 0.93
    assert y[s >= 0.7].mean() > 0.9 and (s[y == 1] >= 0.7).mean() > 0.75


def test_pairs_beyond_additive_weights():
    """Toxic only if both terms meet: each alone says nothing."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for k in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.array([1] * a + [2] * b + sorted(set(rng.integers(10, 40, 5).tolist()))))
        y.append(int(a == b))
    y = np.array(y, float)
    m = toxicity.Machine(index={k: k for k in range(40)}).fit(rows[:2000], y[:2000], np.ones(2000))
    z = m.margin(rows[2000:])
    assert ((z > 0) == (y[2000:] == 1)).mean() > 0.95
    own = toxicity.learn(rows[:2000], y[:2000], np.ones(2000))       # it chooses the terms itself
    assert {1, 2} <= set(own.index) and len(own.index) < 8
    p = own.score([np.array(sorted(own.index[t] for t in set(r.tolist()) & set(own.index)), dtype=np.int64) for r in rows[2000:]])
    assert ((p > 0.5) == (y[2000:] == 1)).mean() > 0.95


def test_no_terms_are_chosen_by_chance():
    """Labels that no term and no pair explains: hardly any term is taken."""
    rng = np.random.default_rng(3)
    rows = [np.array(sorted(set(rng.integers(0, 300, 25).tolist()))) for _ in range(3000)]
    y = rng.integers(0, 2, 3000).astype(float)
    assert len(toxicity.interacting(*toxicity.pair_rows(rows, y))) <= 4


def test_planted_pairs_beat_additive_weights(spark):
    """An insult with the mention of a group is toxic, either alone is not, and
    neither says anything about the class by itself."""
    rng = np.random.default_rng(5)
    filler = [a + b + c for a in "bdfg" for b in "aeiou" for c in "lmn"]
    docs, labels = [], []
    for k in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = list(rng.choice(filler, 12)) + ["grobian"] * insult + ["martians"] * group
        docs.append((k, " ".join(rng.permutation(words))))
        labels.append((k, int(insult == group)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.train(df, marks)
    assert toxicity.terms("grobian")[0] in machine.index and toxicity.terms("martians")[0] in machine.index
    rated = {r["id"]: r for r in toxicity.rate(df, marks, machine=machine).collect()}
    held = [k for k, _ in labels if rated[k]["held_out"]]
    right = np.mean([(rated[k]["score"] >= 0.5) == bool(labels[k][1]) for k in held])
    additive = toxicity.Machine(machine.index, machine.bias, machine.w, np.zeros_like(machine.v))
    plain = {r["id"]: r["score"] for r in toxicity.rate(df, marks, machine=additive).collect()}
    guess = np.array([plain[k] for k in held])
    best = max(np.mean((guess >= t) == np.array([bool(labels[k][1]) for k in held])) for t in np.unique(guess))
    assert right > 0.95 and best < 0.8


def test_score_equals_its_definition(spark, documents):
    """Every query score from the machine's own numbers, pair by pair."""
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    m = toxicity.train(docs, marks)
    got = {r["id"]: r["score"] for r in toxicity.rate(docs, marks, machine=m).collect()}
    for i, text in documents:
        own = sorted({m.index[t] for t in toxicity.terms(text or "") if t in m.index})
        z = m.bias + sum(m.w[own]) + sum(m.v[a] @ m.v[b] for k, a in enumerate(own) for b in own[k + 1:])
        assert abs(got[i] - 1 / (1 + np.exp(-(m.scale * z + m.shift)))) < 1e-9


def test_one_text_of_an_id_that_repeats(spark):
    """A labelled id that a third of all rows share gives the sample one row."""
    docs = spark.createDataFrame([(0, f"bad text {k}") for k in range(3000)] + [(k, f"good text {k}") for k in range(1, 90)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(90)], "doc_id long, toxic int")
    seen = []
    real = toxicity.sets_of
    toxicity.sets_of = lambda found, *a: seen.append(found.count()) or real(found, *a)
    try:
        toxicity.train(docs, labels)
    finally:
        toxicity.sets_of = real
    assert seen and max(seen) <= 60


def test_margin_equals_pair_sum():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(bias=0.3, w=rng.normal(size=9), v=rng.normal(size=(9, toxicity.FACTORS)))
    for own in (np.array([], int), np.array([2]), np.array([0, 3, 8])):
        want = 0.3 + sum(m.w[own]) + sum(m.v[i] @ m.v[j] for k, i in enumerate(own) for j in own[k + 1:])
        assert abs(m.margin([own])[0] - want) < 1e-9


def test_learning_does_not_see_the_held_out_fold(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(60)], "doc_id long, text string")
    out = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 == 1]
    labels = spark.createDataFrame([(k, 1) for k in out], "doc_id long, toxic int")
    got = toxicity.rate(docs, labels).collect()
    assert {r["score"] for r in got} == {0.0}
    assert {r["id"] for r in got if r["held_out"]} == set(out)


def test_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (7, 0), (8, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    got = toxicity.rate(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert toxicity.rate(none, labels).count() == 0
    assert toxicity.rate(odd, labels.limit(0)).count() == len(odd_rows)
