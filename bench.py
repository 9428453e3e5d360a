"""Bench: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; one warm-up, then the median of three runs of each query
(building the plan, its eager preparation jobs and a full execution into the
``noop`` sink).  Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from canopy import registry as R  # noqa: E402
from canopy.operators.wide import build_wide, build_wide_join_chain  # noqa: E402
from canopy.plans.inspect import plan_summary  # noqa: E402
from canopy.session import local_session, scratch_path  # noqa: E402
from canopy.sources import testdata as td  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
REPS = int(os.environ.get("BENCH_REPS", "3"))


def _chain(category):
    def q(spark, sf):
        w = R.five_wide(spark, sf, category)
        return build_wide_join_chain(R.five_staged(spark, sf), w.points, w.names, w.kind)
    return q


HEADLINE = {
    "wide_aligned": R.q_wide_aligned,
    "wide_ragged": R.q_wide_ragged,
    "extract_incremental": R.q_extract_incremental,
    "page_aligned": R.q_page_aligned,
    "table_stats": R.q_table_stats,
    "column_stats": R.q_column_stats,
    "assign_sequence": R.q_assign_sequence,
    "staged_append": R.q_staged_append,
    "wide_many_points": R.q_wide_many_points,
}
# the n-1 join form of the wide tables, for comparison (not in the total)
COMPARE = {"wide_aligned_join_chain": _chain("type1"), "wide_ragged_join_chain": _chain("other")}


def run_once(spark, fn) -> float:
    t0 = time.perf_counter()
    fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def plan_counts(spark) -> dict:
    """Exchanges and scans of the wide tables, pivot vs join chain, over the
    five-point staging stored as Parquet (broadcast off, so every join shows
    its shuffle as it would at scale)."""
    path = scratch_path(spark, "bench-staged")
    R.five_staged(spark, SF_DIR).write.parquet(path)
    st = spark.read.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = {}
    try:
        for cat in ("type1", "other"):
            w = build_wide(st, td.ordered_manifest(st, [cat]), cat)
            for form, df in (("pivot", w.df),
                             ("join_chain", build_wide_join_chain(st, w.points, w.names, w.kind))):
                s = plan_summary(df)
                out[f"{w.kind}_{form}"] = {"hash_exchanges": s["hash_exchanges"],
                                           "scans": s["scans"]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return out


def main():
    # local mode: one shuffle partition per core (AQE coalesces further)
    spark = local_session(CPUS, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", CPUS)),
                          app="canopy-bench")
    out, extra = {}, {}
    for table, fns in ((out, HEADLINE), (extra, COMPARE)):
        for name, fn in fns.items():
            run_once(spark, fn)                                  # warm-up
            table[name] = round(statistics.median(run_once(spark, fn) for _ in range(REPS)), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "compare": extra,
                      "plans": plan_counts(spark), "sf": sf, "cpus": CPUS,
                      "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}))


if __name__ == "__main__":
    main()
