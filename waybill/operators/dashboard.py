"""Dashboard datasets, the roll-ups behind their charts, and their filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import share_of_total
from waybill.operators.dimensions import StarDimensions
from waybill.operators.marts import SERVICE_DESCRIPTION, Axis, star_rollup


def with_share(groups: DataFrame, count: str, share: str) -> DataFrame:
    """Share of the grand total. The window is global, but its input is already aggregated
    to one row per label, so the single partition it needs stays small."""
    return groups.selectExpr("*", f"{share_of_total(count, f'SUM({count}) OVER ()')} AS {share}")


def airport_share(fact: DataFrame, dims: StarDimensions) -> DataFrame:
    """Airport trips per service type and their share of all airport trips."""
    trips = star_rollup(fact.filter(F.col("is_airport_trip")), dims, (SERVICE_DESCRIPTION,))
    counted = trips.withColumnRenamed("trips", "airport_trip_count")
    return with_share(counted, "airport_trip_count", "airport_trip_pct").orderBy(
        F.desc("airport_trip_pct")
    )


def hourly_by_type(fact: DataFrame, dims: StarDimensions) -> DataFrame:
    """Trips per service type and pickup hour, merged by what the types are called."""
    hour = Axis("pickup_time_key", "time", {"hour": "pickup_hour"})
    trips = star_rollup(fact, dims, (SERVICE_DESCRIPTION, hour))
    return trips.selectExpr("description AS service_type", "pickup_hour", "trips AS trip_count").orderBy(
        "service_type", F.desc("trip_count")
    )


def zone_share(fact: DataFrame, dims: StarDimensions) -> DataFrame:
    """Trips per pickup zone and their share of all trips."""
    axis = Axis("pickup_zone_key", "zone", {"zone": "zone", "borough": "borough"})
    trips = star_rollup(fact, dims, (axis,)).withColumnRenamed("trips", "trip_count")
    return with_share(trips, "trip_count", "trip_pct").orderBy(F.desc("trip_count"))


def chart_total(dataset: DataFrame, axis: str, measure: str) -> DataFrame:
    """Second-level sum of a dataset's measure along one axis."""
    return dataset.groupBy(axis).agg(F.sum(measure).alias(f"sum({measure})"))


def metric_count(dataset: DataFrame, *dimensions: str) -> DataFrame:
    """Row count of a dataset, by any of its columns."""
    return dataset.groupBy(*dimensions).agg(F.count(F.lit(1)).alias("count"))


def select_values(dataset: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Multi-select filter; nothing selected means no restriction."""
    return dataset.filter(F.col(column).isin(list(values))) if values else dataset


def filter_options(dataset: DataFrame, column: str, matches: Column | None = None) -> DataFrame:
    """Choices of a multi-select filter, and how many rows of each pass the other filters."""
    passing = F.lit(True) if matches is None else matches
    return dataset.groupBy(column).agg(F.count_if(passing).alias(f"{column}_associativity"))
