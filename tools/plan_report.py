"""Summarise the physical plan of every registered query.

    python tools/plan_report.py [sf_dir] [name ...]

Per query: shuffles (hash / round-robin / range), broadcasts, join kinds,
windows, generators, scans and whether the scans carry pushed filters.  The
plan is the initial adaptive plan (before runtime re-planning).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(plan: str) -> dict:
    return {
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "rr_shuffles": len(re.findall(r"Exchange RoundRobinPartitioning", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "generates": len(re.findall(r"Generate ", plan)),
        "scans": len(re.findall(r"FileScan|LocalTableScan", plan)),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
    }


def main(argv):
    from ratesmith.session import build_session
    from ratesmith.plans.queries import QUERIES

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(QUERIES)
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"{name:24s} " + " ".join(f"{k}={v}" for k, v in s.items()), flush=True)


if __name__ == "__main__":
    main(sys.argv)
