"""Physical-plan summary of registered queries (what ``explain("formatted")`` shows).

usage: python -m tools.plan_summary [sf_dir] > docs/PLAN_SUMMARY.md
Counts shuffles (Exchange), broadcasts, join strategies, windows, generators and
aggregates in each query's final adaptive plan (after running that very execution).
"""

from __future__ import annotations

import re
import sys

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
       "Exchange SinglePartition", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Generate", "HashAggregate",
       "SortAggregate", "ObjectHashAggregate", "TakeOrderedAndProject", "Expand", "BatchEvalPython",
       "ArrowEvalPython"]


def summarize(plan: str) -> dict:
    out = {}
    for op in OPS:
        n = len(re.findall(re.escape(op) + r"\b", plan))
        if n:
            out[op] = n
    return out


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from ledgerloom.plans.registry import QUERIES
    from ledgerloom.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=16)
    import os as _os
    if _os.environ.get("PLAN_MATERIALIZED"):
        import tempfile
        from ledgerloom.plans.build import STAR_TOLERATED, build
        from ledgerloom.plans.registry import use_materialized
        b = build(spark, sf_dir, tempfile.mkdtemp(prefix="ll-plans-", dir="/tmp"), STAR_TOLERATED)
        use_materialized(sf_dir, b["root"])
        print("\n## Materialized mode\n")
        print("After `build` (raw tables landed, marts and consumer tables published): queries read the")
        print("written tables, so lineage and shuffles stop at the published table.\n")
        print("| query | shuffles | broadcasts | operators |")
        print("|---|---|---|---|")
        _table(spark, sf_dir, keys)
        return
    print("# Physical plan summary\n")
    print(f"Final adaptive plans at `{sf_dir}` (local[8], 16 shuffle partitions), from scratch (raw tables")
    print("derived from the star tables in the same plan).  Counts of physical operators; no query has a")
    print("Python UDF, cartesian product or nested-loop join.\n")
    print("| query | shuffles | broadcasts | operators |")
    print("|---|---|---|---|")
    _table(spark, sf_dir, keys)


def _table(spark, sf_dir, keys):
    from ledgerloom.plans.registry import QUERIES
    for k in keys:
        df = QUERIES[k](spark, sf_dir)
        execution = df._jdf.queryExecution()
        execution.toRdd().count()  # runs this very execution, so its adaptive plan is final
        plan = execution.executedPlan().toString()
        if "isFinalPlan=true" in plan:
            plan = plan.split("== Initial Plan ==")[0]
        s = summarize(plan)
        shuffles = sum(v for op, v in s.items() if op.startswith("Exchange"))
        ops = ", ".join(f"{op} x{v}" for op, v in s.items() if not op.startswith("Exchange") and op != "BroadcastExchange")
        print(f"| {k} | {shuffles} | {s.get('BroadcastExchange', 0)} | {ops} |", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
