"""The zone dimension in its two roles: pickup and dropoff."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill import fixed_values as fv
from waybill.operators.lookup import Dimension, lookup, measured
from waybill.operators.schema import snake_case_columns

_ROLES = (("pickup", fv.PICKUP_LOCATION), ("dropoff", fv.DROPOFF_LOCATION))
_ATTRIBUTES = ("borough", "zone", "service_zone")


def zone_lookup(zones: DataFrame) -> Dimension:
    """A zone table in any name style, as a counted dimension keyed by ``location_id``."""
    named = snake_case_columns(zones)
    typed = named.selectExpr("try_cast(location_id AS INT) AS location_id", *_ATTRIBUTES)
    return measured(typed, "location_id")


def enrich_with_zones(df: DataFrame, zone_df: DataFrame | Dimension) -> DataFrame:
    """Borough, zone and service zone for each side whose location id exists, then the
    airport flag. Rows with an unknown zone stay, with NULLs."""
    zones = zone_df if isinstance(zone_df, Dimension) else zone_lookup(zone_df)
    for role, location in _ROLES:
        if location in df.columns:
            take = {attribute: f"{role}_{attribute}" for attribute in _ATTRIBUTES}
            df = lookup(df, zones, location, take)
    return add_airport_flag(df)


def add_airport_flag(df: DataFrame) -> DataFrame:
    """True when either side lies in an airport service zone; unknown sides count as not.
    Without any service zone column nothing is added."""
    sides = [f"{role}_service_zone" for role, _ in _ROLES if f"{role}_service_zone" in df.columns]
    if not sides:
        return df
    tests = [f"COALESCE({side} = '{fv.AIRPORT_SERVICE_ZONE}', false)" for side in sides]
    return df.withColumn("is_airport_trip", F.expr(" OR ".join(tests)))
