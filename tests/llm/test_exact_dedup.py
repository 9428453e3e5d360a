import hashlib
from collections import defaultdict

import pytest
from canopy.llm import exact_dedup


def test_odd_rows(spark, odd, odd_rows):
    groups = defaultdict(list)
    for r in odd_rows:
        groups[r[1] or ""].append(r[0])
    want = sorted((str(i), str(max((x for x in own if x is not None), default=None)), len(own),
                   i == max((x for x in own if x is not None), default=None), hashlib.sha256(t.encode()).hexdigest())
                  for t, own in groups.items() for i in own)
    got = sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["digest"])
                 for r in exact_dedup.exact_duplicates(odd).collect())
    assert got == want


@pytest.mark.parametrize("keep", ["min", "max"])
def test_one_row_per_text_with_its_columns(spark, odd, odd_rows, keep):
    left = exact_dedup.drop_exact_duplicates(odd, keep=keep)
    assert left.columns == odd.columns
    rows = [tuple(r) for r in left.collect()]
    assert all(r in odd_rows for r in rows)
    texts = [r[1] or "" for r in rows]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in odd_rows})
    pick = min if keep == "min" else max
    for r in rows:
        assert r[0] == pick((x[0] for x in odd_rows if (x[1] or "") == (r[1] or "") and x[0] is not None), default=None)


def test_empty_table(spark, none):
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0


def test_columns_of_any_type_are_carried(spark):
    schema = "doc_id long, text string, tags map<string,int>, more array<struct<m:map<string,string>>>"
    rows = [(1, "a", {"x": 1}, [({"p": "q"},)]), (1, "a", {"x": 2}, None), (2, "a", None, []), (3, None, {}, None)]
    for order in (rows, rows[::-1]):
        left = exact_dedup.drop_exact_duplicates(spark.createDataFrame(order, schema), keep="min")
        got = sorted(left.collect(), key=lambda r: r["doc_id"])
        assert left.columns == ["doc_id", "text", "tags", "more"] and [r["doc_id"] for r in got] == [1, 3]
        tags = got[0]["tags"]
    assert tags in ({"x": 1}, {"x": 2})
