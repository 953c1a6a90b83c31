"""Print, per registered query, the join strategies and risky operators of
its initial physical plan (no query is run)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from covspark.registry import QUERIES
    from covspark.session import local_session
    spark = local_session(8)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    for name in names:
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                           r"CartesianProduct)[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|Cross|ExistenceJoin)?", plan)
        kinds = {}
        for j, t in joins:
            kinds[f"{j}:{t}"] = kinds.get(f"{j}:{t}", 0) + 1
        lines = plan.split("\n")
        risky = []
        for i, line in enumerate(lines):
            if "BroadcastExchange" in line:
                child = "\n".join(lines[i + 1:i + 4])
                if "Generate" in child:
                    risky.append("broadcast-of-exploded")
        if "BroadcastNestedLoopJoin" in plan or "CartesianProduct" in plan:
            risky.append("nested-loop/cartesian")
        print(f"{name:30s} exchanges={plan.count('Exchange hashpartitioning')} {kinds} {risky}")


if __name__ == "__main__":
    main()
