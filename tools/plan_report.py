"""Physical-plan profile of registered queries: exchanges, broadcasts, join
kinds, windows, aggregates, Python evaluation, and scan schemas/filters.

usage: python tools/plan_report.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "Window", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "ArrowEvalPython", "BatchEvalPython",
         "FileScan")


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def profile(plan: str) -> dict:
    out = {n: len(re.findall(re.escape(n), plan)) for n in NODES}
    out["read_schemas"] = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    return out


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    pats = [a for a in args if a != sf]
    from keepsake.registry import queries
    from keepsake.session import get_session
    spark = get_session("local[4]", 4)
    for name, fn in sorted(queries().items()):
        if pats and not any(p in name for p in pats):
            continue
        p = profile(physical_plan(fn(spark, sf)))
        counts = " ".join(f"{k.split()[-1] if k.startswith('Exchange') else k}={v}" for k, v in p.items()
                          if k != "read_schemas" and v)
        print(f"{name}: {counts}")


if __name__ == "__main__":
    main()
