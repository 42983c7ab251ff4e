"""Design variants against each other, on the tables of BENCH_SF_DIR.

* cube over grouped facts against a cube straight over the facts
* sums in whole hundredths against decimal sums and double sums
* a scan per schema against a scan per file, over files written to a folder of this run
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import standins  # noqa: E402
from checks.registry import CUBE_COLUMNS  # noqa: E402
from waybill.operators import marts  # noqa: E402
from waybill.operators.schema import unify_schemas  # noqa: E402
from waybill.session import local_session  # noqa: E402
from waybill.sources.files import read_monthly  # noqa: E402


def best(build, repeats: int = 2) -> float:
    times = []
    for _ in range(repeats):
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return round(min(times), 2)


def direct_cube(fact, dims):
    labelled = (
        fact.join(dims.service_type.frame, "service_type_key")
        .join(dims.time.frame, F.expr("pickup_time_key = time_key"))
        .join(dims.zone.frame, F.expr("pickup_zone_key = zone_key"), "left")
        .join(dims.payment_type.frame, "payment_type_key", "left")
        .selectExpr(
            "*", "pickup_date_key DIV 10000 AS year", "pickup_date_key DIV 100 % 100 AS month"
        )
    )
    cubed = labelled.cube("service_type", "year", "month", "hour", "borough", "payment_type_name")
    averages = ("total_amount", "passenger_count", "trip_distance", "trip_duration_min", "tip_amount")
    return cubed.agg(
        F.grouping_id(), F.count(F.lit(1)), F.sum("total_amount"), *[F.avg(c) for c in averages]
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"), "variants", **{"spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise SystemExit("set spark.checkpoint.dir to a folder that all machines share")
    work = f"{shared}/variants-{uuid.uuid4().hex}"
    dims = standins.dimensions(spark, sf_dir)
    standins.fact(spark, sf_dir, *CUBE_COLUMNS).write.parquet(f"{work}/fact")
    fact = spark.read.parquet(f"{work}/fact")
    times = {
        "cube grouped first": best(lambda: marts.cube_trips(fact, dims)),
        "cube direct": best(lambda: direct_cube(fact, dims)),
    }
    keys = ("service_type_key", "pickup_date_key")
    for name, total in (
        ("hundredths", "sum(CAST(rint(total_amount * 1e2D) AS BIGINT))"),
        ("decimal", "sum(CAST(total_amount AS DECIMAL(12, 2)))"),
        ("double", "sum(total_amount)"),
    ):
        times[f"sum {name}"] = best(lambda t=total: fact.groupBy(*keys).agg(F.expr(t)), 3)

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    paths = []
    for n in range(48):
        amount = "o_totalprice" if n % 2 else "CAST(o_totalprice AS BIGINT) AS O_TotalPrice"
        path = f"{work}/orders-{n:02d}.parquet"
        month = orders.filter(F.expr(f"year(o_orderdate) = {1995 + n // 12} AND month(o_orderdate) = {n % 12 + 1}"))
        month.selectExpr("o_orderkey", "o_custkey", amount).coalesce(1).write.parquet(path)
        paths.append(path)
    times["48 files, scan per schema"] = best(lambda: read_monthly(spark, paths))
    times["48 files, scan per file"] = best(
        lambda: unify_schemas([spark.read.parquet(p) for p in paths])
    )
    spark.stop()
    print(json.dumps(times))


if __name__ == "__main__":
    main()
