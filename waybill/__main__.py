"""Run the flow as a Spark job:

spark-submit --py-files waybill.zip waybill/__main__.py --landing /lake/landing --zone-csv ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from waybill.plans import medallion
from waybill.session import apply_settings

STAGES = {
    "bronze": medallion.write_bronze,
    "zones": medallion.write_zones,
    "silver": medallion.write_silver,
    "gold": medallion.write_gold,
}


def names(text: str) -> tuple[str, ...]:
    return tuple(part.strip() for part in text.split(",") if part.strip())


def parse(arguments: list[str] | None = None) -> tuple[medallion.Medallion, tuple[str, ...]]:
    default = medallion.Medallion(landing="")
    parser = argparse.ArgumentParser(prog="waybill")
    parser.add_argument("--landing", required=True, help="folder with the monthly files")
    parser.add_argument("--zone-csv", help="zone lookup file")
    parser.add_argument("--taxi-types", type=names, default=tuple(default.taxi_types))
    parser.add_argument("--date-start", default=default.date_start, help="first month, YYYY-MM-DD")
    parser.add_argument("--date-stop", default=default.date_stop, help="last month, YYYY-MM-DD")
    for layer in ("bronze", "silver", "gold"):
        parser.add_argument(f"--{layer}", default=getattr(default, layer), help="schema name")
    parser.add_argument("--no-dedup", dest="dedup", action="store_false")
    parser.add_argument("--dedup-keys", type=names, default=None)
    parser.add_argument("--rebalance", action=argparse.BooleanOptionalAction, default=None, help="even out silver file sizes")
    parser.add_argument("--stages", type=names, default=tuple(STAGES))
    options = vars(parser.parse_args(arguments))
    stages = options.pop("stages")
    unknown = [stage for stage in stages if stage not in STAGES]
    if unknown:
        parser.error(f"unknown stages: {', '.join(unknown)}")
    return medallion.Medallion(**options), stages


def main() -> None:
    plan, stages = parse()
    spark = apply_settings(SparkSession.builder.appName("waybill").getOrCreate())
    for stage in stages:
        STAGES[stage](spark, plan)


if __name__ == "__main__":
    main()
