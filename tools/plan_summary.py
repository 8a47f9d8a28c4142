"""Run every registered query and summarise its final (adaptive) physical plan into PLANS.md:
scans, shuffles, join strategies, partial aggregation and whether any fact table was broadcast.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from planscore.registry import QUERIES  # noqa: E402
from planscore.session import build_session  # noqa: E402

# Names in a scan's location that mark a fact table.
FACT_TABLES = ("lineitem.parquet", "orders.parquet", "events.parquet")


def final_section(plan: str) -> str:
    """A finalised adaptive plan prints its final and initial plans; keep the final one."""
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


def depth(line: str) -> int:
    """Column of a node's name in the printed tree."""
    return len(line) - len(line.lstrip(" :+-*"))


def subtrees(lines: list[str], node: str):
    """The printed lines below each ``node`` of the tree."""
    for i, line in enumerate(lines):
        if node in line:
            below = []
            for other in lines[i + 1:]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            yield "\n".join(below)


def summarise(plan: str) -> dict:
    plan = final_section(plan)
    lines = plan.splitlines()
    fact_bcast = sum(any(t in below for t in FACT_TABLES)
                     for below in subtrees(lines, "BroadcastExchange"))
    return {
        "scans": len(re.findall(r"Scan parquet", plan)),
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange SinglePartition|Exchange RoundRobin", plan)),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "shj": plan.count("ShuffledHashJoin"),
        "products": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
        "partial_agg": "yes" if "partial_" in plan else "",
        "window": plan.count("Window [") + plan.count("WindowGroupLimit"),
        "fact_broadcast": fact_bcast,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Final physical plans of the registered queries ({os.path.basename(sf)}, AQE on)\n")
    print("Generated by `python tools/plan_summary.py`. Counts are plan nodes after adaptive "
          "re-planning of the returned DataFrame; jobs that a query runs while it is built (gates, the "
          "stream, the sink's report) come on top. `fact bcast` counts broadcasts with a lineitem, "
          "orders or events scan anywhere below.\n")
    print("| query | sec | scans | shuffles | BHJ | SMJ | SHJ | products | partial agg | windows "
          "| fact bcast |")
    print("|---|---|---|---|---|---|---|---|---|---|---|")
    for k, fn in QUERIES.items():
        t0 = time.perf_counter()
        df = fn(spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()          # runs this DataFrame's own plan, so AQE finalises it
        sec = time.perf_counter() - t0
        s = summarise(qe.executedPlan().toString())
        print(f"| {k} | {sec:.1f} | {s['scans']} | {s['shuffles']} | {s['bhj']} | {s['smj']} "
              f"| {s['shj']} | {s['products']} | {s['partial_agg']} | {s['window']} "
              f"| {s['fact_broadcast']} |")


if __name__ == "__main__":
    main()
