"""Distinct ids by bitmaps: exact, mergeable, buckets in the shuffle."""
import random

import pytest
from pyspark.sql import functions as F

from canopy.operators import bitmaps as B


@pytest.fixture(scope="module")
def ids(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), draw.choice([draw.randint(-70000, 70000), draw.randint(1, 300), 32768, 32769, 0, 10**12]))
            for _ in range(5000)] + [("a", None)]
    return spark.createDataFrame(rows, "point string, unique_id long")


def test_counts_are_exact(ids):
    got = {r.point: r.unique_ids_count for r in B.distinct_ids(B.id_bitmaps(ids, "point"), "point").collect()}
    want = {r.point: r.n for r in ids.groupBy("point").agg(F.countDistinct("unique_id").alias("n")).collect()}
    assert got == want
    whole = B.distinct_ids(B.id_bitmaps(ids, "point")).first().unique_ids_count
    assert whole == ids.select("unique_id").filter("unique_id IS NOT NULL").distinct().count()


def test_parts_merge(ids):
    a, b = (B.id_bitmaps(ids.filter(F.pmod(F.xxhash64("unique_id"), F.lit(2)) == k)) for k in (0, 1))
    parts = a.unionByName(b).unionByName(a)
    assert B.distinct_ids(parts).first() == B.distinct_ids(B.id_bitmaps(ids)).first()


@pytest.mark.parametrize("limit", [1, 7, 400, 10**6])
def test_first_ids(ids, limit):
    got = [r.unique_id for r in B.first_ids(B.id_bitmaps(ids), limit).collect()]
    assert got == sorted({r.unique_id for r in ids.collect() if r.unique_id is not None})[:limit]


def test_no_ids(ids):
    none = B.id_bitmaps(ids.limit(0))
    assert B.distinct_ids(none).first().unique_ids_count == 0 and B.first_ids(none, 5).count() == 0


def test_only_buckets_are_shuffled(spark):
    df = spark.range(1, 200_001, numPartitions=4).withColumnRenamed("id", "unique_id")
    assert B.id_bitmaps(df).count() == 7
