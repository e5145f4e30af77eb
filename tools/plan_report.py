"""Plan-shape report: run each registered query and count the operators of
its executed (AQE-final) physical plan.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from terracube.session import get_spark
    spark = get_spark(os.environ.get("TC_MASTER", "local[8]"), 8)
    print("# Executed plan shapes\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (AQE on). Counts are "
          "operators in the final adaptive plan, subqueries included. *Shuffles* are hash or "
          "range exchanges; *reused* are exchanges AQE served from an identical stage. "
          "Model queries (fit eagerly) and file round trips show only their returned frame.\n")
    print("| query | shuffles | reused | broadcasts | SMJ | BHJ | BNLJ | windows | aggregates | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    from terracube.queries import QUERIES
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()  # runs through this frame's own execution -> final AQE plan
        p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p))
        row = [
            shuffles,
            p.count("ReusedExchange"),
            p.count("BroadcastExchange"),
            p.count("SortMergeJoin"),
            p.count("BroadcastHashJoin"),
            p.count("BroadcastNestedLoopJoin"),
            len(re.findall(r"(?<![A-Za-z])Window \[", p)),
            len(re.findall(r"(?<![A-Za-z])(HashAggregate|ObjectHashAggregate|SortAggregate)\(", p)),
            len(re.findall(r"(FileScan|Scan parquet|Scan ExistingRDD|Scan \w+)", p)),
        ]
        print(f"| {name} | " + " | ".join(str(x) for x in row) + " |")


if __name__ == "__main__":
    main()
