"""Run headline queries and summarise their final (adaptive) physical plans:
exchanges by kind, join strategies, aggregates, windows and the columns each
parquet scan reads. Writes markdown to stdout.

    python tools/plan_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KINDS = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window",
         "TakeOrderedAndProject", "Generate", "BroadcastExchange", "ReusedExchange")


def summarise(plan: str) -> tuple[Counter, list[str]]:
    counts = Counter()
    scans = []
    for line in plan.splitlines():
        for k in KINDS:
            if re.search(rf"\b{k}\b", line):
                counts[k] += 1
        m = re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", line)
        if m and "BroadcastExchange" not in line:
            counts[f"Exchange {m.group(1)}"] += 1
        s = re.search(r"FileScan parquet \[([^\]]*)\].*Location: [^\[]*\[file:[^\]]*/([a-z]+)\.parquet", line)
        if s:
            cols = re.sub(r"#\d+L?", "", s.group(1))
            scans.append(f"{s.group(2)}({cols})")
    return counts, scans


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from quill.plans.catalogue import QUERIES
    from quill.session import local_session
    names = argv[2:] or list(HEADLINE)
    spark = local_session(8, 32, app="quill-plans")
    print(f"| query | exchanges (shuffles) | joins | aggregates / windows | parquet columns read |")
    print("| --- | --- | --- | --- | --- |")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        c, scans = summarise(plan)
        ex = ", ".join(f"{c[k]} {k.split()[1]}" for k in sorted(c) if k.startswith("Exchange ")) or "none"
        if c["BroadcastExchange"]:
            ex += f"; {c['BroadcastExchange']} broadcast"
        if c["ReusedExchange"]:
            ex += f"; {c['ReusedExchange']} reused"
        joins = ", ".join(f"{c[k]} {k}" for k in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                                                  "BroadcastNestedLoopJoin", "CartesianProduct") if c[k]) or "none"
        aggs = ", ".join(f"{c[k]} {k}" for k in ("HashAggregate", "ObjectHashAggregate", "SortAggregate",
                                                 "Window", "TakeOrderedAndProject") if c[k]) or "none"
        cols = "; ".join(sorted(set(scans)))
        print(f"| `{name}` | {ex} | {joins} | {aggs} | {cols} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
