"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR   folder with the tables   (default /root/testdata/sf0.1)
BENCH_CPUS     cores                    (default 8)
BENCH_REPEATS  runs per query           (default 2, the faster one counts)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES  # noqa: E402
from waybill.session import local_session  # noqa: E402

HEADLINE = (
    "unify_schemas",
    "dedup_full_row",
    "dedup_first",
    "standardize_silver",
    "fact_trips",
    "count_by_type",
    "revenue_monthly",
    "trips_by_hour",
    "trips_by_zone",
    "cube_trips",
    "star_join_inner",
    "q_passengers_by_hour",
    "airport_share",
    "zone_share",
    "landing_completeness",
)


def run(df) -> None:
    """Compute every row and column, keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(
        cpus,
        "bench",
        **{"spark.driver.memory": "12g", "spark.sql.shuffle.partitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["count_by_type"](spark, sf_dir))  # start executors, compile, list files
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(repeats):
            started = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            elapsed = time.perf_counter() - started
            first.setdefault(name, elapsed)
            times[name] = min(elapsed, times.get(name, elapsed))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "first_runs": {name: round(t, 3) for name, t in first.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
