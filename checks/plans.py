"""What the physical plans of the registered queries consist of.

    python -m checks.plans SF_DIR [--no-broadcast] [QUERY ...]

``--no-broadcast`` plans as for tables far above the broadcast threshold.
"""

from __future__ import annotations

import re
import sys

from checks.registry import QUERIES
from waybill.session import local_session

# fixed values: what to count, as it is written in a physical plan
PARTS = {
    "scans": r"FileScan",
    "shuffles": r"Exchange (?:hash|range)partitioning",
    "single": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "sort-merge": r"SortMergeJoin",
    "python": r"Python|ArrowEval",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def parts_of(plan: str) -> dict[str, int]:
    return {name: len(re.findall(pattern, plan)) for name, pattern in PARTS.items()}


def main(sf_dir: str, arguments: list[str]) -> None:
    spark = local_session(8, "plans")
    spark.sparkContext.setLogLevel("ERROR")
    if "--no-broadcast" in arguments:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = [a for a in arguments if not a.startswith("--")] or list(QUERIES)
    print(f"{'query':28}" + "".join(f"{name:>11}" for name in PARTS))
    for name in names:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(f"{name:28}" + "".join(f"{n:11}" for n in parts_of(plan).values()), flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
