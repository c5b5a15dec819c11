"""Write PLANS.md: the condensed physical plan of every registered clickstream query.

Usage: python explain_plans.py [sf_dir]   (default /root/testdata/sf0.01)

Each plan is the physical plan Spark submits (adaptive execution may still
coalesce shuffle reads or turn a join into a broadcast at run time), with
expression details cut to the operator, its keys and the scan's pushed
filters and read schema. Streaming and round-trip queries return a read of
what their stream or job wrote, so their plan is that read; their jobs'
plans are described in the README.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import SparkSession

from clickpanes.plans.catalog import QUERIES
from clickpanes.scratch import clear_scratch

KEEP = re.compile(
    r"(Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|HashAggregate|"
    r"ObjectHashAggregate|SortAggregate|Expand|Generate|Window|WindowGroupLimit|TakeOrderedAndProject|"
    r"Scan|FileScan|Filter|Sort |AQEShuffleRead|Union|CartesianProduct|BroadcastNestedLoopJoin|"
    r"InMemoryTableScan|ReusedExchange|Coalesce)"
)


def condense(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        if "FileScan" in line or "Scan parquet" in line:
            keep = [m.group(0) for m in re.finditer(r"(FileScan \w+ \[[^\]]*\]|PushedFilters: \[[^\]]*\]|PartitionFilters: \[[^\]]*\]|ReadSchema: \S+|Location: \w+\([^)]*\)\[[^\]]*\])", line)]
            indent = line[: len(line) - len(line.lstrip(" :+-|"))]
            line = indent + " ".join(keep)
        elif len(line) > 220:
            line = line[:220] + " …"
        out.append(line)
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    parts = [
        "# PLANS\n",
        f"Physical plans of the registered queries on `{sf_dir}`, local[8], 8 shuffle",
        "partitions, AQE on; generated by `explain_plans.py` (plans as submitted, before",
        "adaptive re-planning; expression ids removed, long expressions cut).\n",
    ]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        qe = df._jdf.queryExecution()
        text = qe.executedPlan().toString()
        parts.append(f"## {name}\n\n```\n{condense(text)}\n```\n")
        clear_scratch(spark)
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main()
