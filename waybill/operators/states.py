"""Mergeable sums per month, kept in a table of their own.

A state is what a group of trips leaves behind for any mart: the number of trips, and per measure exact
sums and counts. Groups are as fine as the marts and the cube need, by foreign keys, so all of them can be
merged from the states without reading a trip. The table is partitioned by month: where the trips of one month
change, its states are computed anew, from the row groups that hold this month, and all others stay.

Sums are decimals, so merged states equal sums over the trips bit for bit, whatever was recomputed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.operators import marts
from waybill.operators.sinks import replace_partitions, table_folder, write_table

STATE_LAYOUT = ("state_year", "state_month")
#: Keys that marts and cube group by; the date is that of the month's first day.
STATE_KEYS = ("service_type_key", "pickup_time_key", "pickup_zone_key", "payment_type_key")
STATE_MEASURES = (*marts.CUBE_MEASURES, marts.AIRPORT)
_FIRST_OF_MONTH = "CAST(pickup_date_key DIV 100 * 100 + 1 AS INT)"


def month_states(fact: DataFrame) -> DataFrame:
    """Trips and partial sums by month and keys. Trips without a pickup date are a month of their own."""
    partial = [p for m in STATE_MEASURES for p in m.partial()]
    return fact.groupBy(
        F.expr("CAST(pickup_date_key DIV 10000 AS INT) AS state_year"),
        F.expr("CAST(pickup_date_key DIV 100 % 100 AS INT) AS state_month"),
        F.expr(f"{_FIRST_OF_MONTH} AS pickup_date_key"),
        *STATE_KEYS,
    ).agg(F.expr("count(1) AS trips"), *[F.expr(p) for p in dict.fromkeys(partial)])


def picked_up_in(months: Sequence[Mapping[str, Any]]) -> str:
    """Condition on the date key; ranges, so that row groups of other months are skipped."""
    tests = [
        "pickup_date_key IS NULL"
        if m["pickup_year"] is None
        else "pickup_date_key BETWEEN {0} AND {0} + 99".format(m["pickup_year"] * 10000 + m["pickup_month"] * 100)
        for m in months
    ]
    return " OR ".join(tests) or "false"


def refresh_states(
    spark: SparkSession, fact: DataFrame, full_table: str, changed: Sequence[Mapping[str, Any]] | None
) -> DataFrame:
    """Bring the stored states to the fact, given the months (``pickup_year``, ``pickup_month``) in which trips
    changed; None recomputes all. Returns the stored states."""
    if changed is None or not table_folder(spark, full_table):
        write_table(month_states(fact), full_table, STATE_LAYOUT)
    elif changed:
        fresh = month_states(fact.filter(picked_up_in(changed)))
        gone = [dict(zip(STATE_LAYOUT, (m["pickup_year"], m["pickup_month"]))) for m in changed]
        replace_partitions(fresh, full_table, gone)  # those of `gone` that have trips are replaced
    return spark.read.table(full_table)


def trips_of(states: DataFrame) -> dict[int, int]:
    """Trips per service type key: one row per type."""
    return {r["service_type_key"]: r["n"] for r in states.groupBy("service_type_key").agg(F.sum("trips").alias("n")).collect()}
