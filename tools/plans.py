"""Summarise the final (adaptive) physical plan of every registered query.

usage: python tools/plans.py [table_dir] > PLANS.md
Counts shuffle exchanges, join strategies, aggregate kinds and windows in
the executed plan, and whether every scan carries pushed filters and a
pruned read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockline.registry import QUERIES  # noqa: E402
from stockline.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan (?:parquet|json|csv|text)", plan)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|"
                                   r"Exchange RoundRobin", plan)),
        "reused": len(re.findall(r"ReusedExchange", plan)),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "shj": plan.count("ShuffledHashJoin"),
        "nlj": plan.count("NestedLoopJoin"),
        "hash_agg": len(re.findall(r"\bHashAggregate", plan)),
        "sort_agg": plan.count("SortAggregate"),
        "obj_agg": plan.count("ObjectHashAggregate"),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "scans": len(scans),
        "scans_with_filters": sum(1 for p in pushed if p.strip()),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
    }


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    cols = ["shuffles", "reused", "bhj", "smj", "shj", "nlj", "hash_agg", "sort_agg", "obj_agg", "window",
            "scans", "scans_with_filters", "python"]
    print(f"# Physical plans\n\nFinal adaptive plans of every registered query on `{d}` (local[8], AQE on),")
    print("generated by `python tools/plans.py`. Joins: bhj broadcast hash, smj sort-merge, shj shuffled hash,")
    print("nlj nested loop (none expected). `python` counts Python/Arrow operators (none expected).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, d)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # the final adaptive plan only
        s = summarise(plan)
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
