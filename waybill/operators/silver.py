"""Silver: same records, standard names and types, invalid dates removed.

Every step looks at which columns exist, so one set of operators serves all schemas. All
steps are row-wise (plus broadcast lookups): silver never shuffles the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill import fixed_values as fv
from waybill.functions.literals import literal
from waybill.functions.dates import as_timestamp
from waybill.functions.labels import code_label, yes_no
from waybill.functions.names import detect_dropoff_col, detect_pickup_col
from waybill.operators.lookup import Dimension
from waybill.operators.schema import snake_case_columns
from waybill.operators.zones import enrich_with_zones
from waybill.spec import RECORD_TYPES

PARTITION_COLUMNS = ("pickup_year", "pickup_month")


def cast_datetimes(df: DataFrame) -> DataFrame:
    found = (detect_pickup_col(df.columns), detect_dropoff_col(df.columns))
    return df.withColumns({name: F.expr(as_timestamp(df, name)) for name in found if name})


def cast_locations(df: DataFrame) -> DataFrame:
    found = [c for c in (fv.PICKUP_LOCATION, fv.DROPOFF_LOCATION) if c in df.columns]
    return df.withColumns({name: F.expr(f"try_cast(`{name}` AS INT)") for name in found})


def filter_valid_dates(df: DataFrame, valid_start: str, valid_end: str) -> DataFrame:
    """Keep rows picked up in [start, end) whose dropoff, if known, is not earlier than the
    pickup. Without a pickup column nothing is removed."""
    pickup = detect_pickup_col(df.columns)
    if pickup is None:
        return df
    picked_up = as_timestamp(df, pickup)
    kept = df.filter(
        f"{picked_up} IS NOT NULL AND {picked_up} >= CAST({literal(valid_start)} AS TIMESTAMP)"
        f" AND {picked_up} < CAST({literal(valid_end)} AS TIMESTAMP)"
    )
    dropoff = detect_dropoff_col(df.columns)
    if dropoff is None:
        return kept
    dropped_off = as_timestamp(df, dropoff)
    return kept.filter(f"{dropped_off} IS NULL OR {dropped_off} >= {picked_up}")


def derive_partitions(df: DataFrame) -> DataFrame:
    pickup = detect_pickup_col(df.columns)
    if pickup is None:
        return df
    return df.withColumns({"pickup_year": F.year(pickup), "pickup_month": F.month(pickup)})


def add_coded_labels(df: DataFrame, taxi_type: str) -> DataFrame:
    """Label columns beside the codes, and Y/N flags as booleans, as the record type asks."""
    record_type = RECORD_TYPES.get(taxi_type)
    if record_type is None:
        return df
    derived = {
        label.target: code_label(label.source, label.names)
        for label in record_type.labels
        if label.source in df.columns
    } | {flag: yes_no(flag) for flag in record_type.flags if flag in df.columns}
    return df.withColumns({n: F.expr(sql) for n, sql in derived.items()}) if derived else df


def standardize_silver(
    df: DataFrame,
    zone_df: DataFrame | Dimension | None = None,
    taxi_type: str | None = None,
    valid_start: str | None = None,
    valid_end: str | None = None,
) -> DataFrame:
    df = df.transform(snake_case_columns).transform(cast_datetimes).transform(cast_locations)
    if valid_start and valid_end:
        df = filter_valid_dates(df, valid_start, valid_end)
    df = derive_partitions(df)
    if zone_df is not None:
        df = enrich_with_zones(df, zone_df)
    return add_coded_labels(df, taxi_type) if taxi_type else df
