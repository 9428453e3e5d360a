"""Align the points of a category into one wide table.

Semantics (ordinal alignment on ``unique_id``, not time alignment):

* aligned kind (type1, type2): inner alignment -- a ``unique_id`` is kept only
  if every resolved point has a row for it; columns
  ``unique_id, timestamp (of the base point), v1 .. vn``.
* ragged kind (others): full outer alignment -- every ``unique_id`` of any
  point; columns ``unique_id, timestamp_v1, v1, ..., timestamp_vn, vn``.

The base point is the first *resolvable* point in manifest order.  A resolved
point without rows still counts (the inner result is then empty); a manifest
point that exists nowhere is skipped.  Value-column names come from the name
rule; colliding names (or names equal to a reserved column) become
``<name>__<point>`` so that nothing is lost.

Plan: instead of n-1 joins (n scans, 5..8 exchanges for five points) the rows
of all points are hash-partitioned once on ``unique_id`` and pivoted with an
explicit value list, so Spark uses its pivot-first aggregate (one hash lookup
per row, whatever n is).  Timestamps travel as microseconds because the
pivot-first aggregate supports only numeric buffers.  A per-point row count
checks that ``(point, unique_id)`` is unique (a join would multiply duplicates,
an aggregate would hide them) and decides completeness for the inner kind --
``count(*)``, so a null reading still aligns.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.names import normalise_point, value_column_name
from ..functions.temporal import from_micros, from_micros_sql, to_micros


def q(name: str) -> str:
    """Back-quote an identifier for column references."""
    return "`" + name.replace("`", "``") + "`"


@dataclass
class WideTable:
    category: str
    kind: str
    df: DataFrame
    base_point: str
    points: list[str]
    names: list[str]
    skipped: list[str] = field(default_factory=list)


def resolve_names(points: list[str], derived: list[str], kind: str) -> list[str]:
    """Unique column names in manifest order (driver side, manifest-sized).

    A name shared by several points, or equal to a reserved column, becomes
    ``<name>__<sanitised point>``; a remaining clash gets ``_<position>``.
    """
    reserved = {"unique_id", "timestamp"}
    if kind == "ragged":
        reserved |= {f"timestamp_{d}" for d in derived}
    counts = Counter(derived)
    out, seen = [], set()
    for i, (p, d) in enumerate(zip(points, derived)):
        name = d
        if counts[d] > 1 or d in reserved:
            name = f"{d}__{_py_sanitise(p).lower()}"
        while name in seen or name in {"unique_id", "timestamp"}:
            name = f"{name}_{i + 1}"
        seen.add(name)
        out.append(name)
    return out


def _py_sanitise(s: str) -> str:
    return "".join(ch if (ch.isascii() and (ch.isalnum() or ch == "_")) else "_" for ch in s)


def resolve_points(telemetry: DataFrame, manifest: DataFrame, category: str,
                   known_points: DataFrame | None = None):
    """Manifest rows of ``category`` in order, split into resolvable / skipped.

    Returns ``[(point, derived_name)]`` and ``[skipped points]``.  Only
    manifest-sized lists reach the driver: the category's manifest rows and
    the subset of them that exist (in ``known_points`` -- e.g. the run
    metadata -- or, without it, in the telemetry itself).
    """
    m = (manifest.filter(F.col("category") == F.lit(category))
         .select(normalise_point("point").alias("point"), "ord"))
    src = known_points if known_points is not None else telemetry
    existing = (src.select("point").join(m.select("point"), "point", "left_semi")
                .distinct().select("point", value_column_name("point").alias("name")))
    # one job: the category's manifest rows (manifest-sized) with the derived
    # name of each point that exists
    rows = m.join(existing, "point", "left").orderBy("ord", "point").collect()
    listed = [(r["point"], r["ord"]) for r in rows]
    if not listed:
        return [], []
    found = {r["point"]: r["name"] for r in rows if r["name"] is not None}
    order, seen = [], set()
    for p, _ in listed:
        if p not in seen:
            seen.add(p)
            order.append(p)
    resolved = [(p, found[p]) for p in order if p in found]
    skipped = [p for p in order if p not in found]
    return resolved, skipped


def build_wide(telemetry: DataFrame, manifest: DataFrame, category: str,
               kind: str | None = None, known_points: DataFrame | None = None,
               check_unique: bool = True) -> WideTable | None:
    """The wide table of ``category`` from long ``telemetry(point, unique_id,
    ts, value)`` and ``manifest(category, point, ord)``; ``None`` when no
    manifest point of the category resolves."""
    kind = kind or config.join_kind(category)
    resolved, skipped = resolve_points(telemetry, manifest, category, known_points)
    if not resolved:
        return None
    points = [p for p, _ in resolved]
    names = resolve_names(points, [d for _, d in resolved], kind)
    df = pivot_points(telemetry, points, names, kind, check_unique)
    return WideTable(category, kind, df, points[0], points, names, skipped)


def pivot_points(telemetry: DataFrame, points: list[str], names: list[str], kind: str,
                 check_unique: bool = True,
                 block_points: int = config.WIDE_BLOCK_POINTS) -> DataFrame:
    """W-AGG: rows hash-partitioned on ``unique_id`` and pivoted over the given
    points.  Up to ``block_points`` points the checks ride in the same
    aggregate (per-point counts); beyond that they run on the rows of one id
    before the pivot (see ``_pivot_many``) so that generated code stays small."""
    if len(points) > block_points:
        return _pivot_many(telemetry, points, names, kind, check_unique)
    ts_type = telemetry.schema["ts"].dataType
    # staged points are normalised on ingest, so the filter reaches the scan
    long = (telemetry.filter(F.col("point").isin(points))
            .select("point", "unique_id", "value", to_micros("ts", ts_type).alias("_t")))
    g = (long.repartition("unique_id")
         .groupBy("unique_id").pivot("point", points)
         .agg(F.first("value").alias("v"), F.first("_t").alias("t"),
              F.count(F.lit(1)).alias("c")))
    vcol = {p: F.col(q(f"{p}_v")) for p in points}
    tcol = {p: F.col(q(f"{p}_t")) for p in points}
    ccol = {p: F.col(q(f"{p}_c")) for p in points}

    conds: list[Column] = []
    if check_unique:
        most = ccol[points[0]] if len(points) == 1 else F.greatest(*ccol.values())
        conds.append(F.when(most > 1, F.raise_error(F.lit(_DUP))).otherwise(F.lit(True)))
    if kind == "aligned":
        conds.extend(c.isNotNull() for c in ccol.values())
    if conds:
        g = g.filter(reduce(lambda a, b: a & b, conds))
    return g.select(*_wide_columns(points, names, kind, vcol, tcol, ts_type))


_DUP = "wide alignment: (point, unique_id) is not unique"


def _wide_columns(points, names, kind, vcol, tcol, ts_type) -> list[Column]:
    if kind == "aligned":
        cols = [F.col("unique_id"), from_micros(tcol[points[0]], ts_type).alias("timestamp")]
        return cols + [vcol[p].alias(n) for p, n in zip(points, names)]
    cols = [F.col("unique_id")]
    for p, n in zip(points, names):
        cols += [from_micros(tcol[p], ts_type).alias(f"timestamp_{n}"), vcol[p].alias(n)]
    return cols


def _pivot_many(telemetry, points, names, kind, check_unique) -> DataFrame:
    """Many points: the rows are first reduced to one per ``(unique_id,
    point)``; the uniqueness guard and the inner-kind completeness are windows
    over those of one ``unique_id`` (at most one per point), so no per-row
    expression spans all points. Reduction, windows and pivot all keep the one
    partitioning by ``unique_id``: one exchange, one scan."""
    ts_type = telemetry.schema["ts"].dataType
    long = (telemetry.filter(F.col("point").isin(points))
            .select("point", "unique_id", "value", to_micros("ts", ts_type).alias("_t"))
            .repartition("unique_id"))
    per = long.groupBy("unique_id", "point").agg(F.first("value").alias("value"), F.first("_t").alias("_t"),
                                                 F.count(F.lit(1)).alias("_c"))
    of_id = Window.partitionBy("unique_id")
    conds: list[Column] = []
    if check_unique:
        per = per.withColumn("_m", F.max("_c").over(of_id))
        conds.append(F.when(F.col("_m") > 1, F.raise_error(F.lit(_DUP))).otherwise(F.lit(True)))
    if kind == "aligned":
        per = per.withColumn("_n", F.count(F.lit(1)).over(of_id))
        conds.append(F.col("_n") == F.lit(len(points)))
    if conds:
        per = per.filter(reduce(lambda a, b: a & b, conds))
    g = (per.groupBy("unique_id").pivot("point", points)
         .agg(F.first("value").alias("v"), F.first("_t").alias("t")))
    # thousands of columns: one selectExpr call (parsed JVM-side) instead of
    # several py4j round trips per Column object
    if kind == "aligned":
        exprs = ["unique_id",
                 f"{from_micros_sql(q(points[0] + '_t'), ts_type)} AS `timestamp`"]
        exprs += [f"{q(p + '_v')} AS {q(n)}" for p, n in zip(points, names)]
    else:
        exprs = ["unique_id"]
        for p, n in zip(points, names):
            exprs += [f"{from_micros_sql(q(p + '_t'), ts_type)} AS {q('timestamp_' + n)}",
                      f"{q(p + '_v')} AS {q(n)}"]
    return g.selectExpr(*exprs)


def build_wide_join_chain(telemetry: DataFrame, points: list[str], names: list[str],
                          kind: str) -> DataFrame:
    """The n-1 join form (left-deep, manifest order), kept for comparison and
    as an executable statement of the semantics; ``pivot_points`` is the
    production form."""
    how = "inner" if kind == "aligned" else "full_outer"
    t = telemetry.select("point", "unique_id", "ts", "value")
    acc = None
    for i, (p, n) in enumerate(zip(points, names)):
        one = t.filter(F.col("point") == F.lit(p))
        if kind == "aligned":
            one = (one.select("unique_id", F.col("ts").alias("timestamp"), F.col("value").alias(n))
                   if i == 0 else one.select("unique_id", F.col("value").alias(n)))
        else:
            one = one.select("unique_id", F.col("ts").alias(f"timestamp_{n}"),
                             F.col("value").alias(n))
        acc = one if acc is None else acc.join(one, "unique_id", how)
    return acc
