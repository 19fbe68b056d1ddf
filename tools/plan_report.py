"""Summarise the physical plan of every registered query (before AQE re-planning).

For each query: scans (columns read, pushed filters), exchanges with their partitioning,
join strategies, aggregate operators, generators/windows/Python stages.  The plan before
AQE is the one the optimizer commits to without run-time statistics, i.e. what a large
input gets (AQE may later turn a join whose side turns out small into a broadcast).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, ".")
from orderflow.plans.queries import REGISTRY  # noqa: E402
from orderflow.session import local_session  # noqa: E402

OPS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
       "Generate", "Expand", "MapInPandas", "BatchEvalPython", "ArrowEvalPython"]


def summarise(tree: str, formatted: str) -> dict:
    ops = Counter()
    for line in tree.splitlines():
        head = line.strip(" :+-*()0123456789")
        for op in OPS:
            if head.startswith(op):
                ops[op] += 1
    pat = r"(?<!Reused)Exchange (\w+partitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))"
    own = "\n".join(line for line in tree.splitlines() if "ReusedExchange" not in line)
    exchanges = [re.sub(r"#\d+L?", "", m.group(1)) for m in re.finditer(pat, own)]
    reused = len(re.findall(r"ReusedExchange", tree))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", formatted)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", formatted)))
    return {"ops": dict(ops), "exchanges": exchanges, "reused": reused, "schemas": schemas,
            "pushed": pushed}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # show the committed, stats-free plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for inputs of any size
    print("# Physical plans (no run-time re-planning, no size-based broadcast)\n")
    print("Generated by `python tools/plan_report.py`. Exchanges list the shuffles; joins are "
          "sort-merge on (key, time bucket) when no side is known to be small.\n")
    for name, fn in REGISTRY.items():  # the streaming queries read written tables
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarise(plan, formatted)
        print(f"## {name}\n")
        print(f"- operators: {', '.join(f'{k}×{v}' for k, v in sorted(s['ops'].items())) or 'scan/project/filter only'}")
        print(f"- shuffles ({len(s['exchanges'])}): {'; '.join(s['exchanges']) or 'none'}"
              + (f" (+{s['reused']} reused)" if s["reused"] else ""))
        for schema in s["schemas"]:
            print(f"- ReadSchema: `{schema}`")
        for p in s["pushed"]:
            if p != "[]":
                print(f"- PushedFilters: `{p}`")
        print()


if __name__ == "__main__":
    main()
