"""landing files -> bronze -> silver -> gold.

Each ``*_frame`` function only composes a plan. ``run`` writes the tables in order; a
stage reads what the stage before it wrote, so a lost executor costs the running tasks
and never a recomputation of earlier stages.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import fixed_values as fv
from waybill.functions.dates import valid_window
from waybill.functions.names import comments_for, silver_comments_for
from waybill.operators import marts
from waybill.operators.bronze import build_bronze
from waybill.operators.dimensions import (
    StarDimensions,
    dim_date_of_months,
    dim_row_counts,
    star_dimensions,
    stored_dimensions,
)
from waybill.operators.fact import build_fact, union_all_types
from waybill.operators.layout import clustered
from waybill.operators.quality import landing_completeness, stored_contract
from waybill.operators.silver import PARTITION_COLUMNS, standardize_silver
from waybill.operators.sinks import create_schema, write_changed, write_table
from waybill.operators.states import refresh_states, trips_of
from waybill.session import shuffles_sized_for
from waybill.sources.calendars import months
from waybill.sources.files import (
    landed_months,
    monthly_paths,
    optional_table,
    read_monthly,
    read_zone_csv,
    stored_bytes,
)
from waybill.sources.inline import inline_values
from waybill.spec import RECORD_TYPES

ZONE_TABLE = "taxi_zone_lookup"
STATE_TABLE = "month_states"
INGESTION = "dt_ingestion"
FACT_CLUSTER = ("pickup_date_key", "pickup_zone_key")


@dataclass(frozen=True)
class Medallion:
    landing: str
    zone_csv: str | None = None
    taxi_types: Sequence[str] = tuple(RECORD_TYPES)
    date_start: str = "2023-01-01"
    date_stop: str = "2023-05-01"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    #: For all record types, or per type; a type that is not named is not deduplicated.
    dedup: bool | Mapping[str, bool] = True
    #: For all record types, or per type: their key columns have names of their own.
    dedup_keys: Sequence[str] | Mapping[str, Sequence[str]] | None = None
    #: Validity window of silver; the ingested period by default.
    valid_start: str | None = None
    valid_end: str | None = None
    #: Even file sizes in silver; by default wherever deduplication has mixed the months.
    rebalance: bool | None = None
    #: Lay the fact out in so many ranges along date and pickup zone; by default as the tasks write it.
    fact_ranges: int | None = None

    def dedup_of(self, taxi_type: str) -> bool:
        return self.dedup.get(taxi_type, False) if isinstance(self.dedup, Mapping) else self.dedup

    def dedup_keys_of(self, taxi_type: str) -> Sequence[str] | None:
        keys = self.dedup_keys
        return keys.get(taxi_type) if isinstance(keys, Mapping) else keys

    def rebalance_of(self, taxi_type: str) -> bool:
        return self.dedup_of(taxi_type) if self.rebalance is None else self.rebalance


def landing_report(spark: SparkSession, plan: Medallion, taxi_type: str) -> DataFrame:
    """Which months of the period have arrived, and which are missing."""
    return landing_completeness(
        months(spark, plan.date_start, plan.date_stop),
        landed_months(spark, plan.landing, taxi_type),
    )


def landing_paths(plan: Medallion, taxi_type: str) -> list[str]:
    return monthly_paths(plan.landing, taxi_type, plan.date_start, plan.date_stop)


def bronze_frame(spark: SparkSession, plan: Medallion, taxi_type: str) -> DataFrame:
    files = read_monthly(spark, landing_paths(plan, taxi_type))
    return build_bronze(files, plan.dedup_of(taxi_type), plan.dedup_keys_of(taxi_type))


def silver_frame(spark: SparkSession, plan: Medallion, taxi_type: str) -> DataFrame:
    start, end = valid_window(plan.date_start, plan.date_stop)
    return standardize_silver(
        spark.read.table(f"{plan.bronze}.{taxi_type}_trips"),
        zone_df=optional_table(spark, f"{plan.silver}.{ZONE_TABLE}"),
        taxi_type=taxi_type,
        valid_start=plan.valid_start or start,
        valid_end=plan.valid_end or end,
    )


def silver_tables(spark: SparkSession, plan: Medallion) -> Mapping[str, DataFrame]:
    return {t: spark.read.table(f"{plan.silver}.{t}_trips") for t in plan.taxi_types}


def write_bronze(spark: SparkSession, plan: Medallion) -> None:
    """Deduplication is the one step of the flow that shuffles whole records."""
    create_schema(spark, plan.bronze)
    for taxi_type in plan.taxi_types:
        frame = bronze_frame(spark, plan, taxi_type)
        size = stored_bytes(spark, landing_paths(plan, taxi_type)) if plan.dedup_of(taxi_type) else 0
        with shuffles_sized_for(spark, size):
            write_table(
                frame, f"{plan.bronze}.{taxi_type}_trips", comments=comments_for(taxi_type)
            )


def write_zones(spark: SparkSession, plan: Medallion) -> None:
    if plan.zone_csv is None:
        return
    create_schema(spark, plan.silver)
    zones = read_zone_csv(spark, plan.zone_csv)
    write_table(zones, f"{plan.silver}.{ZONE_TABLE}", comments=fv.ZONE_COMMENTS)


def write_silver(spark: SparkSession, plan: Medallion) -> list[dict] | None:
    """Writes the months that differ from the stored ones, in any column but the ingestion time.

    Returns these months over all record types; None where a table had to be written whole."""
    create_schema(spark, plan.silver)
    found = [
        write_changed(
            silver_frame(spark, plan, taxi_type),
            f"{plan.silver}.{taxi_type}_trips",
            PARTITION_COLUMNS,
            silver_comments_for(taxi_type),
            ignore=(INGESTION,),
            rebalance=plan.rebalance_of(taxi_type),
        )
        for taxi_type in plan.taxi_types
    ]
    if any(months is None for months in found):
        return None
    return [dict(month) for month in {tuple(m.items()) for months in found for m in months}]


def _write_gold_table(
    plan: Medallion,
    name: str,
    df: DataFrame,
    partition_by: Sequence[str] = (),
    observe: Mapping[str, Column] | None = None,
) -> Mapping[str, int]:
    return write_table(
        df, f"{plan.gold}.{name}", partition_by, table_comment=fv.TABLE_COMMENTS[name], observe=observe
    )


@dataclass(frozen=True)
class GoldCounts:
    """Rows as they were written: per dimension, and trips per service type key."""

    dimensions: Mapping[str, int]
    trips: Mapping[int, int]


def write_gold(spark: SparkSession, plan: Medallion, changed: Sequence[Mapping] | None = None) -> GoldCounts:
    """Dimensions, fact, contract, states, marts and cube.

    What is counted is counted by the writes. The fact is read once more, for the states of the
    ``changed`` months (None: all); marts and cube merge states."""
    create_schema(spark, plan.gold)
    silver = silver_tables(spark, plan)
    zones = spark.read.table(f"{plan.silver}.{ZONE_TABLE}")
    rows = {"rows": F.count(F.lit(1))}
    dimension_rows = {
        name: _write_gold_table(plan, name, dimension.frame, observe=rows)["rows"]
        for name, dimension in star_dimensions(spark, zones, dim_date_of_months(silver)).named().items()
    }
    # The calendar spans exactly these trips, so the marts need no join with it.
    dims = replace(stored_dimensions(spark, plan.gold), date=None)
    built = build_fact(union_all_types(silver), dims)
    trips = _write_gold_table(
        plan,
        "fact_trips",
        clustered(built, FACT_CLUSTER, plan.fact_ranges) if plan.fact_ranges else built,
        ("service_type_key",),
        observe={str(key): F.count_if(F.col("service_type_key") == key) for key, *_ in fv.SERVICE_TYPE_ROWS},
    )
    stored_contract(spark, f"{plan.gold}.fact_trips").first()
    fact = spark.read.table(f"{plan.gold}.fact_trips")
    counted = {int(key): n for key, n in trips.items() if n}
    states = refresh_states(spark, fact, f"{plan.gold}.{STATE_TABLE}", changed)
    if trips_of(states) != counted:  # a run over other record types came between
        states = refresh_states(spark, fact, f"{plan.gold}.{STATE_TABLE}", None)
    for name, mart in (
        ("agg_revenue_monthly", marts.agg_revenue_monthly),
        ("agg_trips_by_hour", marts.agg_trips_by_hour),
        ("agg_trips_by_zone", marts.agg_trips_by_zone),
        ("cube_trips", marts.cube_trips),
    ):
        _write_gold_table(plan, name, mart(states, dims, states=True))
    return GoldCounts(dimension_rows, counted)


def check_landing(spark: SparkSession, plan: Medallion) -> None:
    """Refuses to begin while a month of the period is missing."""
    gaps = {}
    for taxi_type in plan.taxi_types:
        missing = landing_report(spark, plan, taxi_type).filter("status = 'missing'")
        found = sorted(r["year_month"] for r in missing.collect())  # one row per month
        if found:
            gaps[taxi_type] = found
    if gaps:
        listed = "; ".join(f"{name}: {', '.join(found)}" for name, found in gaps.items())
        raise FileNotFoundError(f"months that have not landed: {listed}")


def gold_report(spark: SparkSession, plan: Medallion) -> tuple[DataFrame, DataFrame]:
    """Row counts of the stored dimensions, and trips per record type."""
    dims = stored_dimensions(spark, plan.gold)
    fact = spark.read.table(f"{plan.gold}.fact_trips")
    return dim_row_counts(dims), marts.count_by_type(fact, dims)


def report_of(spark: SparkSession, dims: StarDimensions, counts: GoldCounts) -> tuple[DataFrame, DataFrame]:
    """What ``gold_report`` returns, from the counts of the writes: no table is read for them."""
    dimensions = inline_values(spark, ("dim", "linhas"), list(counts.dimensions.items()))
    trips = inline_values(spark, ("service_type_key", "trips"), list(counts.trips.items()) or [(None, 0)])
    named = trips.join(dims.service_type.frame, "service_type_key").selectExpr("service_type", "CAST(trips AS BIGINT) AS trips")
    return dimensions.selectExpr("dim", "CAST(linhas AS BIGINT) AS linhas"), named.orderBy(F.desc("trips"))


def run(spark: SparkSession, plan: Medallion) -> tuple[DataFrame, DataFrame]:
    """The whole flow; returns what ``gold_report`` does. Nothing is written while files are missing.

    A run over tables that are there writes the silver months that changed and recomputes their states.
    With a subset of the record types, gold is rebuilt from that subset."""
    check_landing(spark, plan)
    write_bronze(spark, plan)
    write_zones(spark, plan)
    changed = write_silver(spark, plan)
    counts = write_gold(spark, plan, changed)
    return report_of(spark, star_dimensions(spark, spark.read.table(f"{plan.silver}.{ZONE_TABLE}")), counts)
