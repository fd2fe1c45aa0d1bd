"""Summarize the executed (final adaptive) physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts shuffles, broadcasts, join kinds, windows and aggregates per key, and lists the
Parquet read schemas, so shuffle structure and column pruning can be reviewed at a glance.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candleframe.plans.queries import queries as candle_queries  # noqa: E402
from candleframe.session import local_session  # noqa: E402

COUNTED = {
    "shuffle (hash)": r"Exchange hashpartitioning",
    "shuffle (range)": r"Exchange rangepartitioning",
    "shuffle (single)": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "reused exchange": r"ReusedExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "SHJ": r"ShuffledHashJoin",
    "window": r"\bWindow \[",
    "group limit (partial)": r"WindowGroupLimit .*Partial",
    "hash agg": r"HashAggregate\(",
    "sort agg": r"SortAggregate\(",
    "top-k": r"TakeOrderedAndProject",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    qs = candle_queries()
    cols = list(COUNTED)
    print(f"# Physical plans of the registered queries ({sf_dir}, local[*], AQE on)\n")
    print("Counts from each query's executed plan after one run (AQE final plan where it applies).\n")
    print("| key | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    schemas = {}
    for key in sorted(qs):
        df = qs[key](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "Final Plan" in plan:
            plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        counts = [len(re.findall(pat, plan)) for pat in COUNTED.values()]
        print(f"| `{key}` | " + " | ".join(str(c) if c else "" for c in counts) + " |")
        schemas[key] = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    print("\n## Parquet read schemas (column pruning)\n")
    for key, ss in schemas.items():
        print(f"* `{key}`: " + "; ".join(f"`{s}`" for s in ss))


if __name__ == "__main__":
    main(sys.argv)
