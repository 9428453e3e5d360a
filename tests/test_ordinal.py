"""Stored tables in page order: the same pages, and only their parts read."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from canopy.operators.query import page, page_total
from canopy.sources.ordinal import OrdinalTable, write_ordinal

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def wide(spark):
    """Times in a ragged table: some missing, a third of them equal."""
    rows = [(i, None if i % 11 == 0 else T0 + dt.timedelta(hours=5 * 24 if i % 3 == 0 else i), float(i)) for i in range(900)]
    return spark.createDataFrame(rows, "unique_id long, timestamp_a timestamp_ntz, a double").repartition(7)


@pytest.fixture(scope="module")
def table(spark, wide, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ordinal")) + "/t"
    write_ordinal(wide, "other", path, rows_per_part=100)
    return OrdinalTable(spark, path, "other")


@pytest.mark.parametrize("limit, offset, start, end", [
    (20, 0, None, None), (20, 777, None, None), (50, 880, None, None), (10, 5000, None, None), (300, 250, None, None),
    (20, 30, "2024-01-05", None), (20, 30, None, "2024-01-06"), (25, 290, "2024-01-03", dt.date(2024, 1, 20)),
    (10, 0, "2030-01-01", None), (10, 0, "2024-01-06", "2024-01-06")])
def test_pages_equal_the_ranked_table(wide, table, limit, offset, start, end):
    got = table.page(limit, offset, start, end)
    want = page(wide, "other", limit, offset, start, end).collect()
    assert got.rows.collect() == want
    total = page_total(wide, "other", limit, offset, start, end).first()
    assert table.page_total(limit, offset, start, end).first() == total and got.total == total.total_count
    assert len(got.parts) <= limit // 50 + 2


def test_only_the_parts_of_the_page_are_read(table):
    got = table.page(20, 777)
    read = {f.split("part=")[1].split("/")[0] for f in got.rows.inputFiles()}
    assert len(got.parts) <= 2
    every = table.index.count()
    assert every >= 8 and {f.split("part=")[1].split("/")[0] for f in table.data.inputFiles()} >= read
    from canopy.plans.inspect import explain_text
    assert "PartitionFilters" in explain_text(got.rows) and "part" in explain_text(got.rows).split("PartitionFilters")[1][:80]


def test_equal_times_are_spread(table):
    assert table.index.agg(F.max("rows")).first()[0] <= 200


def test_no_rows(wide, tmp_root):
    with pytest.raises(ValueError):
        write_ordinal(wide.limit(0), "other", tmp_root + "/x")


@pytest.mark.parametrize("folder_rows, folders", [(200_000, 1), (250, 4)])
def test_small_parts_make_no_more_folders(spark, wide, tmp_root, monkeypatch, folder_rows, folders):
    """Files and tasks follow the size of the table; parts are stretches of a file."""
    monkeypatch.setattr("canopy.sources.ordinal.FOLDER_ROWS", folder_rows)
    write_ordinal(wide, "other", tmp_root + "/small", rows_per_part=10)
    table = OrdinalTable(spark, tmp_root + "/small", "other")
    index = table.index.orderBy("part").collect()
    assert len(index) >= 90 and max(r.rows for r in index) <= 10
    assert [r.before for r in index] == [sum(x.rows for x in index[:k]) for k in range(len(index))]
    assert len(table.data.inputFiles()) <= folders
    for limit, offset, start, end in [(20, 777, None, None), (300, 250, None, None), (25, 290, "2024-01-03", "2024-01-20"),
                                      (20, 30, None, "2024-01-06"), (10, 5000, None, None)]:
        got = table.page(limit, offset, start, end)
        assert got.rows.collect() == page(wide, "other", limit, offset, start, end).collect()
        assert got.total == page_total(wide, "other", limit, offset, start, end).first().total_count
        assert len(got.parts) <= limit // 10 + 1 + folders
    from canopy.plans.inspect import explain_text
    assert "In(part, [" in explain_text(table.page(20, 777).rows).split("PushedFilters")[1]   # the pages of the parts
    assert table.read().columns == wide.columns
