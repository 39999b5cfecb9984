"""Summarise the physical plans of the driver queries.

usage: python tools/explain.py [sf_dir] [key ...]  > docs/PLANS.md

For each query: the operator chain of the physical plan (root first), the
number of shuffles, broadcasts and scans, and whether windows carry a partial
WindowGroupLimit below their shuffle.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    ops = [o for o in re.findall(r"^[\s:+\-*()0-9]*([A-Z]\w+)", plan, re.M) if o != "AdaptiveSparkPlan"]
    return {
        "ops": ops,
        "shuffles": sum(o == "Exchange" for o in ops),
        "broadcasts": sum(o == "BroadcastExchange" for o in ops),
        "scans": sum(o in ("FileScan", "Scan", "LocalTableScan") for o in ops),
        "partial_limits": plan.count("WindowGroupLimit"),
    }


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    from gridlake.plans.queries import QUERIES
    from gridlake.session import build_session
    spark = build_session()
    print("# Physical plans of the driver queries\n")
    print(f"Generated by `tools/explain.py` at `{sf}` (initial adaptive plans, root first).\n")
    for k in keys or list(QUERIES):
        df = QUERIES[k](spark, sf)
        s = summary(df._jdf.queryExecution().executedPlan().toString())
        print(f"## {k}\n")
        print(f"shuffles {s['shuffles']}, broadcasts {s['broadcasts']}, scans {s['scans']}, "
              f"WindowGroupLimit nodes {s['partial_limits']}\n")
        print("```\n" + " > ".join(s["ops"]) + "\n```\n")


if __name__ == "__main__":
    main()
