"""The trip fact: record types conformed to one grain, with dimension keys."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill import fixed_values as fv
from waybill.functions.dates import date_key, duration_minutes
from waybill.functions.keys import natural_key, sequential_key, unknown_member
from waybill.functions.measures import coalesced_sum
from waybill.operators.dimensions import StarDimensions
from waybill.operators.lookup import lookup
from waybill.operators.numbering import with_row_numbers
from waybill.operators.skew import split_join
from waybill.operators.staging import Shelf
from waybill.spec import CONFORMED_SCHEMA, RECORD_TYPES, RecordType


def conform(df: DataFrame, record_type: RecordType) -> DataFrame:
    """Project a silver table onto the conformed columns. What the type does not record is
    a typed NULL; so is the airport flag if silver was built without zones."""

    def source(name: str) -> str:
        if name == "service_type":
            return f"'{record_type.name}'"
        if name == "total_amount" and record_type.total_of:
            return coalesced_sum(record_type.total_of)
        column = f"`{record_type.conform[name]}`" if name in record_type.conform else "NULL"
        return "NULL" if name == "is_airport_trip" and name not in df.columns else column

    return df.selectExpr(
        *[f"try_cast({source(n)} AS {t}) AS `{n}`" for n, t in CONFORMED_SCHEMA.items()]
    )


def union_all_types(silver: Mapping[str, DataFrame]) -> DataFrame:
    """All record types as one frame. Duplicates stay."""
    parts = [conform(df, RECORD_TYPES[name]) for name, df in silver.items()]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class KeyLookup:
    """How a foreign key is found: in which dimension, by which of its columns, for which
    value of the trip, and what stands for no match."""

    dimension: str
    key: str
    match: str
    value: str
    unknown: int = fv.UNKNOWN_CODE_KEY


KEY_LOOKUPS = {
    "pickup_zone_key": KeyLookup(
        "zone", "zone_key", "zone_key", "pu_location_id", fv.UNKNOWN_ZONE_KEY
    ),
    "dropoff_zone_key": KeyLookup(
        "zone", "zone_key", "zone_key", "do_location_id", fv.UNKNOWN_ZONE_KEY
    ),
    "vendor_key": KeyLookup("vendor", "vendor_key", "vendor_key", "vendor_id"),
    "rate_code_key": KeyLookup(
        "rate_code", "rate_code_key", "rate_code_key", "try_cast(ratecode_id AS INT)"
    ),
    "payment_type_key": KeyLookup(
        "payment_type", "payment_type_key", "payment_type_key", "try_cast(payment_type AS INT)"
    ),
    "hvfhs_license_key": KeyLookup(
        "hvfhs_license", "hvfhs_license_key", "hvfhs_license_num", "hvfhs_license_num"
    ),
}

# Output columns of the fact, in order.
FACT_COLUMNS = (
    "trip_sk",
    "pickup_date_key",
    "pickup_time_key",
    "dropoff_date_key",
    "pickup_zone_key",
    "dropoff_zone_key",
    "vendor_key",
    "rate_code_key",
    "payment_type_key",
    "hvfhs_license_key",
    "service_type_key",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_distance",
    "trip_duration_min",
    "passenger_count",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "is_airport_trip",
)


def with_stable_keys(rows: DataFrame) -> DataFrame:
    """Turns `trip_sk`, the hash of the natural key, into a key of the trip: the hash and the trip's
    number among those equal in it. Unique, and the same set of keys in every run, whatever the
    partitioning.

    All trips are numbered by prefix sums over ranges of the hash, so that a natural key held by
    many trips is cut over tasks; a trip's number is that less the first of its key. Only keys that
    repeat are looked up, and hot ones among them are split."""
    shelf = Shelf(rows.sparkSession, "stable-keys")
    same = [F.col(c) for c in ("trip_sk", "total_amount", "trip_distance") if c in rows.columns]
    numbered = with_row_numbers(rows, same, "__number", lambda df: shelf.put(df, "sorted"))
    repeated = shelf.put(
        numbered.groupBy("trip_sk").agg(F.min("__number").alias("__first"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
        "repeated",
    )
    trips = numbered.count()
    looked_up = split_join(
        numbered, repeated.drop("n"), ["trip_sk"], "left", counts=repeated, rows=trips, deal_by=F.col("__number")
    )
    within = "CAST(__number - COALESCE(__first, __number) + 1 AS STRING)"
    return looked_up.withColumn("trip_sk", F.expr(f"concat(trip_sk, '-', {within})")).select(*rows.columns)


def build_fact(
    unified: DataFrame,
    dims: StarDimensions,
    columns: Collection[str] | None = None,
    stable_keys: bool = False,
) -> DataFrame:
    """Fact rows from conformed rows.

    ``columns`` limits the output, and with it the lookups: Catalyst prunes unused columns
    but has to keep a left join it cannot prove harmless. Every dimension involved is
    literal or counted, so no lookup shuffles the facts. ``stable_keys`` replaces the
    per-run sequence number by a hash of the natural key and, among trips that are equal in
    it, a number; sorting the trips by it into a staged table is what such keys cost.
    """
    wanted = [c for c in FACT_COLUMNS if columns is None or c in columns]
    service = dims.service_type
    rows = lookup(
        unified,
        service.keyed_by("service_type"),
        "service_type",
        {"service_type_key": "service_type_key"},
        how="inner",
    )
    looked_up = {name: KEY_LOOKUPS[name] for name in wanted if name in KEY_LOOKUPS}
    for name, how in looked_up.items():
        dimension = getattr(dims, how.dimension)
        rows = lookup(rows, dimension.keyed_by(how.match), how.value, {how.key: name})

    computed = {
        "trip_sk": natural_key() if stable_keys else sequential_key(),
        "pickup_date_key": date_key("pickup_datetime"),
        "pickup_time_key": "hour(pickup_datetime)",
        "dropoff_date_key": date_key("dropoff_datetime"),
        "trip_duration_min": duration_minutes("pickup_datetime", "dropoff_datetime"),
    } | {name: unknown_member(name, how.unknown) for name, how in looked_up.items()}
    fact = rows.selectExpr(*[f"{computed.get(c, c)} AS `{c}`" for c in wanted])
    return with_stable_keys(fact) if stable_keys and "trip_sk" in wanted else fact
