"""Marts and the cube over the star schema.

All of them go the same way: aggregate the facts on their integer foreign keys first
(map-side combine, so a hot key leaves one row per task), then attach dimension labels to
the few resulting groups, then merge the groups by label. Facts are never joined row by
row, and the dimensions' sizes do not matter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import Measure
from waybill.operators import lattice
from waybill.operators.dimensions import StarDimensions
from waybill.operators.lookup import Dimension
from waybill.operators.staging import Shelf


@dataclass(frozen=True)
class Axis:
    """One dimension of an analysis: ``take`` maps attributes to label columns. ``optional``
    keeps groups whose key the dimension lacks (left join)."""

    foreign_key: str
    dimension: str
    take: Mapping[str, str]
    optional: bool = False
    derived: Mapping[str, str] = field(default_factory=dict)
    #: Condition on the dimension; facts of its other rows are left out before they are grouped.
    where: str | None = None


SERVICE_TYPE = Axis("service_type_key", "service_type", {"service_type": "service_type"})
SERVICE_DESCRIPTION = Axis("service_type_key", "service_type", {"description": "description"})
HOUR = Axis("pickup_time_key", "time", {"hour": "hour"})
HOUR_AND_PERIOD = Axis(
    "pickup_time_key", "time", {"hour": "hour", "period_of_day": "period_of_day"}
)
PICKUP_ZONE = Axis(
    "pickup_zone_key", "zone", {"borough": "pickup_borough", "zone": "pickup_zone"}
)
PICKUP_BOROUGH = Axis("pickup_zone_key", "zone", {"borough": "pickup_borough"}, optional=True)
PAYMENT = Axis(
    "payment_type_key", "payment_type", {"payment_type_name": "payment_type_name"}, optional=True
)


# Year and month of the pickup. Both are digits of the key, and the calendar covers every
# pickup by construction, so without a stored calendar the inner join comes down to
# dropping rows that have no pickup date.
MONTH = Axis(
    "pickup_date_key",
    "date",
    {"year": "year", "month": "month"},
    derived={
        "year": "CAST(pickup_date_key DIV 10000 AS INT)",
        "month": "CAST(pickup_date_key DIV 100 % 100 AS INT)",
    },
)


DISTANCE = Measure("trip_distance", average="avg_trip_distance")
DURATION = Measure("trip_duration_min", average="avg_trip_duration_min", whole=True)
TIP = Measure("tip_amount", average="avg_tip_amount")
PASSENGERS = Measure("passenger_count", average="avg_passenger_count", whole=True)
TOTAL = Measure("total_amount", average="avg_total_amount", total="sum_total_amount")
TOTAL_AVERAGE = Measure("total_amount", average="avg_total_amount")
AIRPORT = Measure("is_airport_trip", total="airport_trips", whole=True)


def _label(groups: DataFrame, axis: Axis, dimension: Dimension) -> DataFrame:
    side = dimension.frame.selectExpr(
        f"{dimension.key} AS __key", *[f"{a} AS {name}" for a, name in axis.take.items()]
    )
    how = "left" if axis.optional else "inner"
    return groups.join(side, F.expr(f"{axis.foreign_key} = __key"), how).drop("__key")


def _expressions(parts: Sequence[str]) -> list[Column]:
    return [F.expr(part) for part in dict.fromkeys(parts)]


def star_groups(
    fact: DataFrame, dims: StarDimensions, axes: Sequence[Axis], measures: Sequence[Measure], states: bool = False
) -> tuple[DataFrame, list[str], list[Column]]:
    """Facts grouped by foreign keys and labelled; the label names; how to merge groups. With ``states``
    the rows are partial sums already (see ``operators.states``) instead of facts."""
    joined = [(axis, getattr(dims, axis.dimension)) for axis in axes]
    for axis, dimension in joined:
        if axis.where and dimension:
            # on a partition column of the fact this also prunes what is read, at run time
            chosen = dimension.frame.filter(axis.where).select(F.col(dimension.key).alias(axis.foreign_key))
            chosen = F.broadcast(chosen) if dimension.broadcastable else chosen
            fact = fact.join(chosen, axis.foreign_key, "left_semi")
    keys = [axis.foreign_key for axis, dimension in joined if dimension]
    for axis, dimension in joined:
        if dimension is None:  # labels that follow from the key itself
            fact = fact.filter(f"{axis.foreign_key} IS NOT NULL")
            keys += [f"{sql} AS {name}" for name, sql in axis.derived.items()]
    merge = ["sum(trips) AS trips"] + [c for m in measures for c in m.merged()]
    partial = merge if states else ["count(1) AS trips"] + [p for m in measures for p in m.partial()]
    groups = fact.groupBy(*_expressions(keys)).agg(*_expressions(partial))
    for axis, dimension in joined:
        if dimension:
            groups = _label(groups, axis, dimension)
    labels = [name for axis in axes for name in axis.take.values()]
    return groups, labels, _expressions(merge)


def star_rollup(
    fact: DataFrame,
    dims: StarDimensions,
    axes: Sequence[Axis],
    measures: Sequence[Measure] = (),
    states: bool = False,
) -> DataFrame:
    """Trips and measures by the labels of the axes."""
    groups, labels, merge = star_groups(fact, dims, axes, measures, states)
    merged = groups.groupBy(*labels).agg(*merge)
    return merged.selectExpr(*labels, "trips", *[c for m in measures for c in m.finished()])


def agg_revenue_monthly(fact: DataFrame, dims: StarDimensions, states: bool = False) -> DataFrame:
    axes = (SERVICE_TYPE, MONTH)
    return star_rollup(fact, dims, axes, (TOTAL, DISTANCE, DURATION, TIP), states)


def agg_trips_by_hour(fact: DataFrame, dims: StarDimensions, states: bool = False) -> DataFrame:
    axes = (SERVICE_TYPE, MONTH, HOUR_AND_PERIOD)
    return star_rollup(fact, dims, axes, (PASSENGERS, TOTAL_AVERAGE), states)


def agg_trips_by_zone(fact: DataFrame, dims: StarDimensions, states: bool = False) -> DataFrame:
    axes = (SERVICE_TYPE, PICKUP_ZONE)
    return star_rollup(fact, dims, axes, (TOTAL_AVERAGE, DISTANCE, AIRPORT), states)


CUBE_MEASURES = (TOTAL, PASSENGERS, DISTANCE, DURATION, TIP)


CUBE_AXES = (SERVICE_TYPE, MONTH, HOUR, PICKUP_BOROUGH, PAYMENT)


def finest_groups(
    fact: DataFrame, dims: StarDimensions, states: bool = False
) -> tuple[DataFrame, list[str], list[Column]]:
    """What the cube rolls up: trips and sums by all of its labels."""
    groups, labels, merge = star_groups(fact, dims, CUBE_AXES, CUBE_MEASURES, states)
    return groups.groupBy(*labels).agg(*merge), labels, merge


def cube_trips(fact: DataFrame, dims: StarDimensions, states: bool = False) -> DataFrame:
    """All 2^6 subtotals. ``grouping_id`` tells a rolled-up dimension from a NULL label.

    The trips are read once, for the finest groups, which the dimensions bound. Every other
    cuboid is merged from its smallest parent; steps are tables in the shared folder."""
    finest, labels, merge = finest_groups(fact, dims, states)
    shelf = Shelf(fact.sparkSession, "cube")
    cubed = lattice.cube(finest, labels, merge, shelf.put)
    return cubed.selectExpr(
        *labels, "grouping_id", "trips", *[c for m in CUBE_MEASURES for c in m.finished()]
    )


def count_by_type(fact: DataFrame, dims: StarDimensions) -> DataFrame:
    return star_rollup(fact, dims, (SERVICE_TYPE,)).orderBy(F.desc("trips"))
