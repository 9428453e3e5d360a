"""Reconciliation tree: the same result, and only differing hours read again."""
import datetime as dt

from pyspark.sql import functions as F

from canopy import registry as R
from canopy.operators.extract import late_rows
from canopy.operators.reconcile import audit_late_rows, differing, leaves

from conftest import SF001

T0 = dt.datetime(2024, 1, 10)


def frame(spark, rows, kind="timestamp_ntz"):
    return spark.createDataFrame(rows, f"point string, ts {kind}")


def both(spark, source, staged, kind="timestamp_ntz"):
    src, own = frame(spark, source, kind), frame(spark, staged, kind)
    pts = frame(spark, source + staged, kind).select("point").distinct()
    args = (src, own, pts, dt.date(2024, 1, 12), dt.date(2024, 1, 20))
    tree = audit_late_rows(*args)
    plain = sorted(map(tuple, late_rows(*args).collect()))
    assert sorted(map(tuple, tree.late.collect())) == plain
    return tree, plain


def test_only_differing_hours_are_read_again(spark):
    rows = [(p, T0 + dt.timedelta(minutes=7 * k)) for p in "abc" for k in range(1000)]
    gone = [rows[10], rows[11], rows[2500]]
    tree, plain = both(spark, rows, [r for r in rows if r not in gone])
    assert [(p, n) for p, n, *_ in plain] == [("a", 2), ("c", 1)]
    hours = {(p, t.replace(minute=0)) for p, t in gone}
    assert tree.hours.count() == len(hours)
    again = sum((p, t.replace(minute=0)) in hours for p, t in rows)
    assert tree.source.count() == again < 40 and tree.staged.count() == again - 3


def test_equal_sides_read_nothing_again(spark):
    rows = [("a", T0 + dt.timedelta(minutes=k)) for k in range(100)]
    tree, plain = both(spark, rows, rows)
    assert plain == [] and tree.hours.count() == tree.source.count() == 0


def test_repeated_times_and_rows_only_in_staging(spark):
    """A repeat that staging lacks is late; what only staging has is not, though its hour differs."""
    both(spark, [("a", T0)] * 3 + [("b", T0)], [("a", T0)] + [("b", T0 + dt.timedelta(hours=5))])
    both(spark, [("a", T0)], [("a", T0 + dt.timedelta(seconds=1))], "timestamp")


def test_levels_open_only_what_differs(spark):
    a = leaves(frame(spark, [(p, T0 + dt.timedelta(hours=h)) for p in "ab" for h in range(48)]))
    b = leaves(frame(spark, [(p, T0 + dt.timedelta(hours=h)) for p in "ab" for h in range(48) if (p, h) != ("b", 30)]))
    got = differing(a, b).collect()
    assert [(r.point, r.hour - r.day * 24) for r in got] == [("b", 6)]


def test_equals_the_plain_audit_over_two_runs(spark):
    src, pts, _, r2 = R._events_runs(spark, SF001, R.AUDIT_BUFFER_SECONDS)
    tree = audit_late_rows(src, r2.staged, pts, R.FIRST_AS_OF, R.SECOND_AS_OF)
    plain = late_rows(src, r2.staged, pts, R.FIRST_AS_OF, R.SECOND_AS_OF)
    assert sorted(map(tuple, tree.late.collect())) == sorted(map(tuple, plain.collect()))
    assert tree.source.count() < src.filter(F.col("ts") < "2024-01-31").count() / 2
