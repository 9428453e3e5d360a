import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from canopy.llm import minhash
from canopy.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(docs, words, percent=80):
    """``(n_shingles, component)`` per row position, by comparing all pairs that share a shingle."""
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").encode().lower())
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words
                    else {tuple(w)} if w else set())
    top = list(range(len(docs)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    by = defaultdict(list)
    for k, own in enumerate(sets):
        common = Counter(j for s in own for j in by[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                top[find(k)] = find(j)
        for s in own:
            by[s].append(k)
    least = {}
    for k, (i, _) in enumerate(docs):
        r = find(k)
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    return [(len(sets[k]), least[find(k)]) for k in range(len(docs))]


def compare(got, docs, words):
    want = brute(docs, words)
    a = sorted((str(r["id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got)
    b = sorted((str(i), n, str(c), i == c) for (i, _), (n, c) in zip(docs, want))
    assert a == b


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    compare(QUERIES["op6_minhash"](spark, sf).withColumnRenamed("doc_id", "id").collect(), docs, 2)


@pytest.mark.parametrize("words, listed, block", [(2, 32, 512), (5, 32, 512), (2, 1, 4)])
def test_near_copies_around_the_threshold(spark, monkeypatch, words, listed, block):
    """Chains and groups of edited copies, many close to 0.8; by pairs and by blocks."""
    monkeypatch.setattr(minhash, "PAIRED_BUCKET", listed)
    monkeypatch.setattr(minhash, "BLOCK_NODES", block)
    rng = random.Random(words)
    docs = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([12, 60, 200]))]
        last = base
        for k in range(14):
            own = list(last if k % 2 else base)
            for _ in range(rng.randrange(1 + len(own) // 12)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            last = own
            docs.append((len(docs), " ".join(own)))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    compare(minhash.near_duplicates(df, words=words).collect(), docs, words)


def test_families_that_never_link_are_screened(spark, monkeypatch):
    """Two families of one template, similar inside (0.9) and less than 0.8 across:
    many share buckets, the screen leaves none that is not to be linked, and no
    block is compared; a bridge between two others is."""
    monkeypatch.setattr(minhash, "PAIRED_BUCKET", 1)
    monkeypatch.setattr(minhash, "BLOCK_NODES", 4)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(minhash, "PART_ROWS", 8)
    seen, compared = [], []
    plain, blocks = minhash.screened, minhash.between_blocks
    monkeypatch.setattr(minhash, "screened", lambda open_, *rest: seen.append(
        (open_, plain(open_, *rest))) or seen[-1][1])
    monkeypatch.setattr(minhash, "between_blocks", lambda open_, *rest: compared.append(open_) or blocks(open_, *rest))

    def family(name, size, template, own):
        base = [f"{template}{k}" for k in range(100)] + [f"{name}{k}" for k in range(own)]
        return [" ".join(base + [f"{name}x{k}y{j}" for j in range(3)]) for k in range(size)]

    apart = family("a", 30, "t", 14) + family("b", 30, "t", 14)
    docs = list(enumerate(apart))
    compare(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=2).collect(), docs, 2)
    assert seen[0][0].select("node").distinct().count() > 40
    assert seen[0][1].select("node").distinct().count() <= 30  # the family without the center
    assert compared[0].isEmpty()

    bridge = family("c", 12, "u", 14) + family("d", 12, "u", 14)
    bridge.append(" ".join([f"u{k}" for k in range(100)]))  # 0.85 to both
    docs = list(enumerate(apart + bridge))
    compare(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=2).collect(), docs, 2)
    assert any(not kept.isEmpty() for _, kept in seen[1:])


def test_spread_join_of_a_hot_key(spark):
    rows = spark.createDataFrame([(k % 7 if k % 3 else 99, b"%05d" % k) for k in range(3000)], "key long, node binary")
    side = spark.createDataFrame([(k, f"s{k}") for k in (0, 1, 2, 3, 99, 100)], "key long, name string")
    got = sorted(map(tuple, minhash.spread_join(rows, side, "key").select("key", "node", "name").collect()))
    assert got == sorted(map(tuple, rows.join(side, "key").select("key", "node", "name").collect()))
    assert minhash.spread_join(rows.limit(0), side, "key").count() == 0


def test_prefix_holds_a_first_common_shingle_that_fits():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 95, 100):
        for _ in range(300):
            pool = np.unique(rng.integers(0, 2**63, 60).astype(np.uint64))
            counts = rng.integers(0, 4, minhash.RANK_CELLS)
            a = np.sort(rng.choice(pool, rng.integers(1, len(pool)), replace=False))
            b = np.union1d(np.delete(a, rng.integers(0, len(a), len(a) // 5)), pool[:rng.integers(0, 5)])
            common = len(np.intersect1d(a, b))
            if 100 * common < percent * (len(a) + len(b) - common):
                continue
            (x, fits_x), (y, fits_y) = (minhash.prefix(s, counts, percent) for s in (a, b))
            _, i, j = np.intersect1d(x, y, return_indices=True)
            assert ((fits_x[i] >= len(b)) & (fits_y[j] >= len(a))).any()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[400:])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (minhash.signature(a, 2000) == minhash.signature(b, 2000)).mean()
    assert abs(same - true) < 0.06
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash.sigma(x))) == len(np.unique(minhash.pi(x.copy()))) == len(x)


def test_odd_rows(spark, odd, odd_rows, none):
    docs = [(r[0], r[1]) for r in odd_rows]
    compare(minhash.near_duplicates(odd, words=2).collect(), docs, 2)
    left = minhash.drop_near_duplicates(odd, words=2)
    assert left.columns == odd.columns
    texts = [(r["text"] or "").split() for r in left.collect()]
    assert len([t for t in texts if t]) == len({tuple(t) for t in texts if t}) + 1  # the row that repeats id and text
    assert len([t for t in texts if not t]) == 4
    assert minhash.near_duplicates(none).count() == 0 and minhash.drop_near_duplicates(none).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(k, k + 1) for k in range(400, 460)]
    top = {}

    def find(k):
        while top.setdefault(k, k) != k:
            k = top[k]
        return k

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(b"%06d" % a, b"%06d" % b) for a, b in links], "a binary, b binary")
    got = {int(r["node"]): int(r["component"]) for r in minhash.components(df).collect()}
    loops = {a for a, b in links if a == b}
    assert got == {k: find(k) for k in top if k in got} and set(top) - set(got) <= loops


def test_spread_join_looks_up_no_parts_by_join(spark):
    """Rows of hot keys are dealt by an expression: the one join is that with the side."""
    rows = spark.range(5000).selectExpr("if(id % 10 = 0, id, 7) as key", "cast(cast(id as string) as binary) as node")
    side = rows.select("key").distinct().withColumn("name", F.col("key") * 2)
    got = minhash.spread_join(rows, side, "key")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert got.count() == 5000 and got.filter("name <> 2 * key").isEmpty()
    cells = spark.createDataFrame([(3,), (5,), (9,)], "_cell long")
    parts = [r[0] for r in cells.orderBy("_cell").select(minhash.parts_of([(3, 1), (9, 700)])).collect()]
    assert parts == [2, 1, 1024]
