"""Declarative description of the record types.

One ``RecordType`` says everything the generic operators need to know about a kind of
record: which codes get a label, which Y/N flags become booleans, which silver column
feeds which conformed fact column, and how its columns are described.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from waybill import fixed_values as fv


@dataclass(frozen=True)
class CodeLabel:
    source: str
    target: str
    names: Mapping


@dataclass(frozen=True)
class RecordType:
    name: str
    comments: Mapping[str, str]
    conform: Mapping[str, str]
    total_of: tuple[str, ...] = ()
    labels: tuple[CodeLabel, ...] = ()
    flags: tuple[str, ...] = ()


# The conformed grain shared by all record types, in output order.
CONFORMED_SCHEMA: dict[str, str] = {
    "service_type": "string",
    "vendor_id": "bigint",
    "ratecode_id": "double",
    "payment_type": "double",
    "hvfhs_license_num": "string",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "pu_location_id": "int",
    "do_location_id": "int",
    "passenger_count": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
    "is_airport_trip": "boolean",
}

_ZONES = {
    "pu_location_id": "pu_location_id",
    "do_location_id": "do_location_id",
    "is_airport_trip": "is_airport_trip",
}
_METERED = {
    name: name
    for name in (
        "vendor_id",
        "ratecode_id",
        "payment_type",
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "tolls_amount",
        "total_amount",
    )
} | _ZONES
_METERED_LABELS = (
    CodeLabel("vendor_id", "vendor_name", fv.VENDOR_NAMES),
    CodeLabel("ratecode_id", "ratecode_name", fv.RATECODE_NAMES),
    CodeLabel("payment_type", "payment_type_name", fv.PAYMENT_TYPE_NAMES),
)

YELLOW = RecordType(
    name="yellow",
    comments=fv.YELLOW_COMMENTS,
    conform=_METERED
    | {
        "pickup_datetime": "tpep_pickup_datetime",
        "dropoff_datetime": "tpep_dropoff_datetime",
    },
    labels=_METERED_LABELS,
    flags=("store_and_fwd_flag",),
)
GREEN = RecordType(
    name="green",
    comments=fv.GREEN_COMMENTS,
    conform=_METERED
    | {
        "pickup_datetime": "lpep_pickup_datetime",
        "dropoff_datetime": "lpep_dropoff_datetime",
    },
    labels=_METERED_LABELS,
    flags=("store_and_fwd_flag",),
)
FHV = RecordType(
    name="fhv",
    comments=fv.FHV_COMMENTS,
    conform=_ZONES
    | {
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "drop_off_datetime",
    },
)
FHVHV = RecordType(
    name="fhvhv",
    comments=fv.FHVHV_COMMENTS,
    conform=_ZONES
    | {
        "hvfhs_license_num": "hvfhs_license_num",
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "dropoff_datetime",
        "trip_distance": "trip_miles",
        "fare_amount": "base_passenger_fare",
        "tip_amount": "tips",
        "tolls_amount": "tolls",
    },
    total_of=(
        "base_passenger_fare",
        "tolls",
        "bcf",
        "sales_tax",
        "congestion_surcharge",
        "airport_fee",
        "tips",
    ),
    labels=(CodeLabel("hvfhs_license_num", "hvfhs_license_name", fv.HVFHS_LICENSE_NAMES),),
    flags=("shared_request_flag",),
)

RECORD_TYPES: dict[str, RecordType] = {t.name: t for t in (YELLOW, GREEN, FHV, FHVHV)}
