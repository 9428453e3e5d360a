"""Plan shape of every registered query (pre-AQE physical plan), as Markdown.

    python tools/plan_report.py [sf_dir [key ...]] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from canopy import registry, registry_stored  # noqa: E402
from canopy.plans.inspect import plan_summary  # noqa: E402
from canopy.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print(f"# Plan shapes ({os.path.basename(sf.rstrip('/'))}, before AQE)\n")
    print("Generated by `python tools/plan_report.py`. Counts are of the physical plan Spark "
          "builds before adaptive re-planning; broadcasts of size-checked sides included.\n")
    print("| query | hash exchanges | reused | broadcasts | scans | window | top-k | pushed filters |")
    print("|---|---|---|---|---|---|---|---|")
    every = {**registry.QUERIES, **registry_stored.QUERIES}
    for k, fn in ((k, every[k]) for k in sys.argv[2:] or every):
        s = plan_summary(fn(spark, sf))
        pushed = "; ".join(sorted({p.strip() for p in s["pushed_filters"] if p.strip()}))
        pushed = (pushed[:90] + "…") if len(pushed) > 90 else pushed
        print(f"| {k} | {s['hash_exchanges']} | {s['reused_exchanges']} | {s['broadcasts']} | "
              f"{s['scans']} | "
              f"{'yes' if s['window'] else ''} | {'yes' if s['top_k'] else ''} | {pushed} |")


if __name__ == "__main__":
    main()
