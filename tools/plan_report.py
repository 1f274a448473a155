"""Write PLANS.md: the physical plan shape of every SQL-checked query.

    python tools/plan_report.py [sf_dir] > PLANS.md

Automatic broadcasts are switched off, so the plans are those the queries get
when every table is large: only the operators' own, size-checked broadcasts
remain.  For each query: shuffles, joins, aggregations, windows, scans with
their read schema and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans import shop  # noqa: E402
from kestrel.plans.registry import SQL_CHECKED  # noqa: E402
from kestrel.session import local_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "BroadcastNestedLoopJoin", "SortMergeJoin", "ShuffledHashJoin",
         "CartesianProduct")


def shape(plan: str) -> dict:
    exchanges = re.findall(r"Exchange (\w+partitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))",
                           plan)
    joins = [j for j in JOINS for _ in range(plan.count(j + " "))]
    aggs = len(re.findall(r"HashAggregate\(keys=|SortAggregate\(key=|ObjectHashAggregate\(keys=", plan))
    scans = []
    for part in plan.split("FileScan ")[1:]:
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", part)
        rs = re.search(r"ReadSchema: (struct<\S*>)", part)
        scans.append((pf.group(1) if pf else "", rs.group(1) if rs else "?"))
    return {"exchanges": exchanges, "joins": joins, "aggs": aggs,
            "windows": plan.count("Window ") + plan.count("WindowGroupLimit"),
            "python": "EvalPython" in plan, "scans": scans}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    print("# Query plans\n")
    print("Generated by `tools/plan_report.py` (automatic broadcasts off, so only the operators'")
    print("size-checked broadcasts appear).  Shuffles are the `Exchange` nodes; aggregations count")
    print("partial and final steps separately.\n")
    print("| query | shuffles | joins | aggregation steps | window steps | Python | scans (pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in SQL_CHECKED:
        df = getattr(shop, name)(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        ex = "<br>".join(s["exchanges"]) or "none"
        joins = ", ".join(s["joins"]) or "none"
        scans = "<br>".join(f"{schema.replace('struct<', '').rstrip('>')}"
                            + (f" [{pf}]" if pf else "") for pf, schema in s["scans"])
        print(f"| `{name}` | {ex} | {joins} | {s['aggs']} | {s['windows']} | "
              f"{'yes' if s['python'] else 'no'} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()
