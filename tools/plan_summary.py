"""Summarise the physical plan of every driver query: shuffles, broadcasts, join kinds, scans,
Python stages. Writes a markdown table (static plan before AQE re-optimisation).

usage: python tools/plan_summary.py [sf_dir]  (its two tables go below the text of PLANS.md)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "nlj": plan.count("NestedLoopJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans": plan.count("FileScan"),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDTF", plan)),
    }


def table(spark, sf: str, queries: dict) -> None:
    print("| Query | Key shuffles | Broadcasts | SortMerge joins | Broadcast hash joins | Nested-loop joins | Windows | "
          "Scans | Python stages |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in queries.items():
        s = summarise(fn(spark, sf)._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | " + " | ".join(str(s[k]) for k in ("shuffles", "broadcasts", "smj", "bhj", "nlj", "windows",
                                                              "scans", "python")) + " |", flush=True)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tidemart.plans import QUERIES
    from tidemart.session import build_session

    spark = build_session("local[8]", 16, app="tidemart-plans")
    print("## Without broadcasts: the plans for tables far above any threshold\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    table(spark, sf, QUERIES)
    print("\n## At sf0.1, with Spark's default threshold\n")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    table(spark, sf, QUERIES)


if __name__ == "__main__":
    main()
