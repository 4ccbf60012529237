"""Summarise the physical plan of every registered query.

    python tools/plan_report.py [sf_dir]

Counts shuffles (hash / range / round-robin), broadcasts, join strategies,
windows and aggregates in the final adaptive plan, and lists what each
parquet scan pushes down.  Used for the scale review in README.md.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from credlake.queries import queries  # noqa: E402
from credlake.session import get_spark  # noqa: E402

PATTERNS = {
    "hash_shuffle": r"Exchange hashpartitioning",
    "range_shuffle": r"Exchange rangepartitioning",
    "round_robin": r"Exchange RoundRobinPartitioning",
    "broadcast": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "shj": r"ShuffledHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "window": r"\bWindow \[",
    "group_limit": r"WindowGroupLimit",
    "hash_agg": r"HashAggregate",
    "sort_agg": r"SortAggregate",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        df.collect()  # runs this DataFrame's own execution, so AQE's final plan is what we read
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        counts = {k: v for k, v in counts.items() if v}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
        print(f"{name:24s} {counts}")
        for p in pushed:
            print(f"{'':24s}   pushed: {p[:110]}")
    spark.stop()


if __name__ == "__main__":
    main()
