"""Wide tables by id blocks: only touched blocks are read and rebuilt."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from canopy import registry_stored as S
from canopy.operators.wide import build_wide
from canopy.plans.inspect import explain_text
from canopy.plans.runner import open_stores, run_extract
from canopy.sources import testdata as td
from canopy.sources.wide_blocks import changed_rows, spans

from conftest import SF001

BLOCK = 16
DAYS = [dt.date(2024, 1, 12), dt.date(2024, 1, 22), dt.date(2024, 1, 30)]


def rows(df):
    return sorted(df.collect(), key=lambda r: r.unique_id)


def files(root, table):
    """Part files by block, of the one generation."""
    data = [d for d in os.listdir(f"{root}/wide_blocks/{table}") if d.startswith("data-")]
    assert len(data) == 1
    top = f"{root}/wide_blocks/{table}/{data[0]}"
    return {int(d[6:]): sorted(f for f in os.listdir(f"{top}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(top) if d.startswith("block=")}, top


def extract(spark, st, k, window=14):
    src = td.events_five(spark, SF001)
    run_extract(spark, src, src.select("point").distinct(), st, DAYS[k], k + 1, tiebreak=["event_id"], window_days=window)


def manifest(spark, cats=("type1", "other")):
    return td.ordered_manifest(td.events_five(spark, SF001), list(cats))


@pytest.mark.parametrize("category", ["type1", "other"])
def test_refreshed_equals_built_anew(spark, tmp_root, category):
    st, man = open_stores(spark, tmp_root), manifest(spark)
    table = f"wide_{category}"
    hows = []
    for k in range(3):
        extract(spark, st, k)
        hows.append(st.blocks.refresh(st, man, category, BLOCK).how)
        want = build_wide(st.staged.read(), man, category).df
        assert rows(st.blocks.read(table)) == rows(want.select(*st.blocks.read(table).columns))
        assert st.blocks.refresh(st, man, category, BLOCK).how == "none"
    assert hows == ["full", "blocks", "blocks"]


def test_untouched_blocks_and_days_are_not_read(spark, tmp_root):
    """The pages of untouched blocks and of the days without touched ids are
    overwritten before the refresh (footers stay, for the schema); it does not
    notice, and the blocks keep their files."""
    st, man = open_stores(spark, tmp_root), manifest(spark, ["other"])
    extract(spark, st, 0, window=30)
    st.blocks.refresh(st, man, "other", BLOCK)
    before, top = files(tmp_root, "wide_other")
    extract(spark, st, 1, window=30)                       # nothing is purged
    log = st.changes.logs().filter("run = 2").agg(F.min("first_id")).first()[0]
    quiet = [b for b in before if b < log // BLOCK]
    partials, _ = st.partials.latest()
    touched_days = {str(r.day) for r in partials.filter(F.col("last_id") >= log // BLOCK * BLOCK).select("day").distinct().collect()}
    broken = [f"{top}/block={b}/{f}" for b in quiet for f in before[b]]
    for run, day in st.staged.days():
        if day not in touched_days:
            d = f"{tmp_root}/staged/run={run}/day={day}"
            broken += [f"{d}/{f}" for f in os.listdir(d) if f.endswith(".parquet")]
    kept = {f: open(f, "rb").read() for f in broken}
    assert len(quiet) >= 2 and any("/staged/" in f for f in broken)
    for f, data in kept.items():
        footer = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
        open(f, "wb").write(data[:4] + b"\xff" * (footer - 4) + data[footer:])
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    with pytest.raises(Exception):
        st.staged.read().agg(F.sum("value"), F.max("point")).collect()
    out = st.blocks.refresh(st, man, "other", BLOCK)
    for f, data in kept.items():
        open(f, "wb").write(data)
    after, _ = files(tmp_root, "wide_other")
    assert out.how == "blocks" and out.blocks == len(after) - len(quiet)
    assert all(after[b] == before[b] for b in quiet)
    want = build_wide(st.staged.read(), man, "other").df
    assert rows(st.blocks.read("wide_other")) == rows(want.select(*st.blocks.read("wide_other").columns))


def test_touched_ids_are_pushed_to_the_scan(spark, tmp_root):
    st = open_stores(spark, tmp_root)
    extract(spark, st, 0)
    touched = spark.createDataFrame([(2,), (3,)], "block long")
    plan = explain_text(changed_rows(st, touched, BLOCK, ["click", "view"]))
    assert "GreaterThanOrEqual(unique_id,32)" in plan and "LessThanOrEqual(unique_id,63)" in plan
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:200]


def test_one_id_opens_one_block(spark):
    st = S.kept_runs(spark, SF001, ("other",))
    some = st.blocks.read("wide_other").agg(F.max("unique_id")).first()[0]
    df = st.blocks.read("wide_other", some)
    assert df.count() == 1 and len(df.inputFiles()) > 0
    plan = explain_text(df)
    assert "block#" in plan and f"= {some // S.ID_BLOCK}" in plan
    assert st.blocks.read("wide_other", 10**9).count() == 0


def test_emptied_blocks_go_and_an_empty_result_leaves_the_table(spark, tmp_root):
    st, man = open_stores(spark, tmp_root), manifest(spark, ["other"])
    src = td.events_five(spark, SF001)
    pts = src.select("point").distinct()
    extract(spark, st, 0)
    st.blocks.refresh(st, man, "other", BLOCK)
    first = st.blocks.blocks("wide_other")
    extract(spark, st, 2)                                   # purges what the first run staged
    out = st.blocks.refresh(st, man, "other", BLOCK)
    assert out.removed > 0 and min(st.blocks.blocks("wide_other")) > min(first)
    now = rows(st.blocks.read("wide_other"))
    run_extract(spark, src, pts, st, dt.date(2025, 1, 1), 9, tiebreak=["event_id"])   # purges all
    assert st.staged.read() is None
    assert st.blocks.refresh(st, man, "other", BLOCK).how == "none"
    assert rows(st.blocks.read("wide_other")) == now        # skip on empty
    late = src.select("point", (F.col("ts") + F.expr("INTERVAL 366 DAYS")).alias("ts"), "value", "event_id")
    run_extract(spark, late, pts, st, dt.date(2025, 1, 30), 10, tiebreak=["event_id"])
    st.blocks.refresh(st, man, "other", BLOCK)              # the changes were still due
    want = build_wide(st.staged.read(), man, "other").df
    assert rows(st.blocks.read("wide_other")) == rows(want.select(*st.blocks.read("wide_other").columns))


def test_other_points_or_block_size_build_anew(spark, tmp_root):
    st = open_stores(spark, tmp_root)
    extract(spark, st, 0)
    man = manifest(spark, ["other"])
    assert st.blocks.refresh(st, man, "other", BLOCK).how == "full"
    fewer = man.filter("point <> 'view'")
    assert st.blocks.refresh(st, fewer, "other", BLOCK).how == "full"
    assert "view" not in st.blocks.read("wide_other").columns
    assert st.blocks.refresh(st, fewer, "other", 2 * BLOCK).how == "full"
    assert st.blocks.refresh(st, fewer, "other", 2 * BLOCK).how == "none"
    assert len([d for d in os.listdir(f"{tmp_root}/wide_blocks/wide_other") if d.startswith("data-")]) == 2


def test_spans():
    assert spans([3, 1, 2, 7], 10) == [(10, 39), (70, 79)]
    assert spans([], 10) == []


def test_folders_do_not_grow_with_the_ids(spark, tmp_root, monkeypatch):
    """Folders hold several blocks where there would be too many; a table that
    has outgrown them is built anew."""
    st, man = open_stores(spark, tmp_root), manifest(spark, ["other"])
    for k, most, how in ((0, 4, "full"), (1, 4, "blocks"), (2, 1, "full")):
        monkeypatch.setattr("canopy.config.MAX_BLOCK_FOLDERS", most)
        extract(spark, st, k)
        assert st.blocks.refresh(st, man, "other", 4).how == how
        found = st.blocks.blocks("wide_other")
        want = rows(build_wide(st.staged.read(), man, "other").df.select(*st.blocks.read("wide_other").columns))
        assert len(want) // 4 > 16 and 1 <= len(found) <= 2 * most + 1
        assert rows(st.blocks.read("wide_other")) == want
        for r in (want[0], want[-1]):
            assert st.blocks.read("wide_other", r.unique_id).collect() == [r]
