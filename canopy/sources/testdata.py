"""Telemetry views over the driver's generated tables (``TESTDATA.md``).

* five-point telemetry: ``events`` with ``point = event_type`` (tie-break
  ``event_id``; ``ts`` is TIMESTAMP_NTZ there);
* many-point telemetry: ``events`` with ``point = user_id`` (rows per point
  stay alike, the number of points grows with the data);
* slot telemetry: ``events`` with ``point = <event type>_<event id mod 14>``
  (70 points at every size, so wide tables keep their columns);
* bench telemetry: ``lineitem`` with ``point = l_suppkey``,
  ``ts = l_shipdate``, ``value = l_extendedprice`` (ties broken by all other
  columns -- ``(l_orderkey, l_linenumber)`` is not unique);
* point manifest: ``supplier`` x ``nation``, the nation name is the biome.

Manifests are derived from the data (its distinct points),
so every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import assign_sequence

LINEITEM_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
                     "l_tax", "l_returnflag", "l_linestatus"]

# --- fixed values: points of the many-column wide tables ---
SLOTS = 14            # each event type is dealt to this many points by event id
LESS50_SLOTS = 7      # the first of them form less50, the rest between50and100
# --- end of fixed values ---


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``point, ts, value, event_id`` with ``point = event_type``."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("point"), "ts", "value", "event_id")


def events_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``point, ts, value, event_id`` with ``point = user_id``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("point"), "ts", "value", "event_id")


def bench_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``point, ts, value`` + tie-break columns from ``lineitem``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("point"), F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("value"), *LINEITEM_TIEBREAK)


def staged(source: DataFrame, tiebreak=("event_id",),
           max_rows_per_task: int | None = None) -> DataFrame:
    """Numbered long telemetry ``point, unique_id, ts, value`` (one run, base 0)."""
    return assign_sequence(source, "point", "ts", list(tiebreak),
                           max_rows_per_task=max_rows_per_task).select(
        "point", "unique_id", "ts", "value")


def ordered_manifest(points: DataFrame, categories: list[str]) -> DataFrame:
    """``category, point, ord``: the distinct points listed under each of
    ``categories``; all share ``ord = 1``, and ties in ``ord`` resolve by point
    name, so the order is the name order (no global ranking pass)."""
    dist = points.select("point").distinct()
    cats = F.array(*[F.lit(c) for c in categories])
    return dist.select(F.explode(cats).alias("category"), "point", F.lit(1).alias("ord"))


def events_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``point, ts, value, event_id`` with a fixed number of points per event type."""
    slot = F.pmod("event_id", F.lit(SLOTS)).cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat_ws("_", "event_type", slot).alias("point"), "ts", "value", "event_id")


def slot_manifest(staged_slots: DataFrame) -> DataFrame:
    """``category, point, ord``: the lower slots form ``less50``, the others
    ``between50and100``; ordered by slot, then name."""
    slot = F.substring_index("point", "_", -1).cast("int")
    return staged_slots.select("point").distinct().select(
        F.when(slot < LESS50_SLOTS, "less50").otherwise("between50and100").alias("category"),
        "point", slot.alias("ord"))


def nation_points(spark: SparkSession, sf_dir: str, nation: str | None = None) -> DataFrame:
    """Point manifest ``point, biome``: suppliers with their nation name."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    m = (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
         .select(F.col("s_suppkey").cast("string").alias("point"), F.col("n_name").alias("biome")))
    return m if nation is None else m.filter(F.col("biome") == F.lit(nation))
