"""Summarize the final (post-AQE) physical plan of every registered data query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
Model and streaming queries are skipped (their work is many jobs, not one plan).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gapwise.plans import catalog  # noqa: E402
from gapwise.runtime import get_spark  # noqa: E402


def _final_only(plan: str) -> str:
    """Drop every "== Initial Plan ==" subtree (adaptive plans print final and initial plans)."""
    keep, skip_at = [], None
    for line in plan.splitlines():
        m = re.search(r"[A-Za-z=*(]", line)
        indent = m.start() if m else 0
        if skip_at is not None:
            if indent >= skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = indent
            continue
        keep.append(line)
    return "\n".join(keep)


def summarize(plan: str) -> dict:
    plan = _final_only(plan)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]+)\]", plan) if p.strip()})
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"
                                   r"|Exchange RoundRobinPartitioning", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                                                  r"BroadcastNestedLoopJoin|CartesianProduct)", plan)))) or "—",
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans": "; ".join(sorted({str(len(s.split(","))) for s in scans})) or "—",
        "pushed": "; ".join(pushed) or "—",
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.sql.maxMetadataStringLength": "100000"})
    lines = ["# PLANS", "",
             f"Final adaptive plans of the registered data queries at `{sf}` (generated by `tools/plan_report.py`).",
             "Counts include scalar-subquery plans. `shuffles` = hash/range/single-partition exchanges, "
             "`scan cols` = columns read per parquet scan, `pushed` = filters handed to the parquet reader.", "",
             "Reading it: joins appear as `BroadcastHashJoin` here because AQE measured one side under the broadcast",
             "threshold at this scale; on large inputs the same plans run as sort-merge joins (with AQE skew",
             "splitting) — the broadcast decision is made on measured sizes, never assumed. In session queries",
             "the 1-row minimum and the pre-aggregated chunk table are always shuffled, raw clicks once with large inputs;",
             "per-key reports never join back to clicks.",
             "Eager helper jobs (radix passes of `describe`, histograms of the ordered cut, encoder fitting) run",
             "before the final plan and are not counted.", "",
             "| query | shuffles | broadcasts | joins | windows | scan cols | pushed |",
             "|---|---|---|---|---|---|---|"]
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        lines.append(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['windows']} | "
                     f"{s['scans']} | {s['pushed']} |")
        print(lines[-1])
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
