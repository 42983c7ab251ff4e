"""The given tables in the shape of the published trip files.

No trip data is given, so order lines, orders and events stand in for trips: the columns
get the published names and types, and from there on the real operators run unchanged.

  yellow  order lines not returned   pickup = order time, dropoff = ship date
  green   returned order lines       same
  fhv     orders                     no dropoff, no amounts
  fhvhv   events                     amounts as components
  zones   nation joined with region

An hour of day is derived from the customer key, because order dates are midnights.
Lines, orders, customers and suppliers are all large, so joining them is left to Catalyst:
below its broadcast threshold a side is broadcast, above it the join shuffles on its key
and adaptive execution splits hot partitions. Every query
joins them, whether or not it looks at the locations they contribute: that their keys are unique
is nobody's promise.

The functions are cached per session: what is kept are lazy plans, never rows, so that
sixty queries do not list the same files and analyze the same projections sixty times.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.dates import valid_window
from waybill.operators.bronze import build_bronze
from waybill.operators.dimensions import StarDimensions, star_dimensions
from waybill.operators.fact import FACT_COLUMNS, build_fact, union_all_types
from waybill.operators.lookup import Dimension
from waybill.operators.silver import standardize_silver
from waybill.operators.zones import zone_lookup
from waybill.sources.calendars import date_bounds

TYPES = ("yellow", "green", "fhv", "fhvhv")
ORDERED_AT = "timestampadd(HOUR, CAST(o_custkey % 24 AS INT), o_orderdate)"


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    service = (
        F.when(F.col("r_name") == "ASIA", "Airports")
        .when(F.col("r_name") == "AMERICA", "Yellow Zone")
        .when(F.col("r_name") == "EUROPE", "EWR")
        .otherwise("Boro Zone")
    )
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        service.alias("service_zone"),
    )


def _with_nation(
    spark: SparkSession, sf_dir: str, df: DataFrame, on: str, party: str, key: str
) -> DataFrame:
    """Add the nation of a customer or supplier; NULL if there is none."""
    nation = f"{key[0]}_nationkey"
    parties = table(spark, sf_dir, party).select(key, nation)
    return df.join(parties, F.col(on) == F.col(key), "left")


@cache
def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's nation and a time of day."""
    orders = table(spark, sf_dir, "orders")
    placed = _with_nation(spark, sf_dir, orders, "o_custkey", "customer", "c_custkey")
    return placed.select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.expr(ORDERED_AT).alias("ordered_at"),
        "c_nationkey",
    )


@cache
def lines_raw(
    spark: SparkSession, sf_dir: str, prefix: str, returned: bool
) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    chosen = lines.filter(
        F.col("l_returnflag") == "R" if returned else F.col("l_returnflag") != "R"
    )
    ordered = _ordered(spark, sf_dir)
    joined = _with_nation(
        spark,
        sf_dir,
        chosen.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")),
        "l_suppkey",
        "supplier",
        "s_suppkey",
    )
    price = F.col("l_extendedprice")
    tip, tolls = price * F.col("l_discount"), price * F.col("l_tax")
    return joined.select(
        F.col("l_linenumber").cast("bigint").alias("VendorID"),
        F.col("ordered_at").alias(f"{prefix}_pickup_datetime"),
        F.col("l_shipdate").alias(f"{prefix}_dropoff_datetime"),
        F.col("l_quantity").alias("passenger_count"),
        (F.col("l_quantity") * 0.25).alias("trip_distance"),
        (F.col("l_tax") * 100).alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "O", "Y").when(F.col("l_linestatus") == "F", "N")
        .alias("store_and_fwd_flag"),
        F.col("c_nationkey").cast("bigint").alias("PULocationID"),
        F.col("s_nationkey").cast("bigint").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("payment_type"),
        price.alias("fare_amount"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        (price + tip + tolls).alias("total_amount"),
    )


@cache
def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ordered(spark, sf_dir).select(
        F.concat(F.lit("B"), "o_orderstatus").alias("dispatching_base_num"),
        F.col("ordered_at").alias("pickup_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("dropOff_datetime"),
        F.col("c_nationkey").cast("double").alias("PUlocationID"),
        F.lit(None).cast("double").alias("DOlocationID"),
        F.when(F.col("o_orderstatus") == "P", 1).alias("SR_Flag"),
        F.col("o_orderpriority").alias("Affiliated_base_number"),
    )


@cache
def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    joined = _with_nation(spark, sf_dir, events, "user_id", "customer", "c_custkey")
    kind, value = F.col("event_type"), F.col("value")
    licence = (
        F.when(kind == "click", "HV0002")
        .when(kind == "view", "HV0003")
        .when(kind == "purchase", "HV0004")
        .when(kind == "signup", "HV0005")
        .otherwise("HV0009")
    )
    return joined.select(
        licence.alias("hvfhs_license_num"),
        kind.alias("dispatching_base_num"),
        F.col("ts").alias("pickup_datetime"),
        F.expr(
            "CASE WHEN event_type <> 'signup'"
            " THEN timestampadd(SECOND, CAST(floor(value * 10) AS INT), ts) END"
        ).alias("dropoff_datetime"),
        F.col("c_nationkey").cast("bigint").alias("PULocationID"),
        (F.col("c_nationkey") + 3).cast("bigint").alias("DOLocationID"),
        value.alias("trip_miles"),
        value.alias("base_passenger_fare"),
        F.when(kind == "purchase", 6.55).alias("tolls"),
        (value * 0.03).alias("bcf"),
        (value * 0.08875).alias("sales_tax"),
        F.lit(2.75).alias("congestion_surcharge"),
        F.when(kind == "view", 2.5).alias("airport_fee"),
        F.when(kind != "error", value * 0.2).alias("tips"),
        F.when(kind == "view", " y").when(kind == "click", "N").alias("shared_request_flag"),
    )


def raw(spark: SparkSession, sf_dir: str, taxi_type: str) -> DataFrame:
    if taxi_type == "yellow":
        return lines_raw(spark, sf_dir, "tpep", False)
    if taxi_type == "green":
        return lines_raw(spark, sf_dir, "lpep", True)
    return (orders_raw if taxi_type == "fhv" else events_raw)(spark, sf_dir)


@cache
def zones(spark: SparkSession, sf_dir: str) -> Dimension:
    return zone_lookup(zones_raw(spark, sf_dir))


@cache
def window(spark: SparkSession, sf_dir: str, taxi_type: str) -> tuple[str | None, str | None]:
    """Validity window of a stand-in: the period its table covers, from the first day to the
    end of the last month. One small job over two columns; an empty table has no window."""
    if taxi_type == "fhvhv":
        times = table(spark, sf_dir, "events"), "ts"
    else:
        times = table(spark, sf_dir, "orders").selectExpr(f"{ORDERED_AT} AS ordered_at"), "ordered_at"
    found = date_bounds([times]).selectExpr("CAST(low AS STRING) AS low", "CAST(high AS STRING) AS high").first()
    return valid_window(found["low"], found["high"]) if found["low"] else (None, None)


@cache
def silver(
    spark: SparkSession,
    sf_dir: str,
    taxi_type: str,
    with_zones: bool = True,
) -> DataFrame:
    start, end = window(spark, sf_dir, taxi_type)
    return standardize_silver(
        build_bronze(raw(spark, sf_dir, taxi_type), dedup=False).drop("dt_ingestion"),
        zone_df=zones(spark, sf_dir) if with_zones else None,
        taxi_type=taxi_type,
        valid_start=start,
        valid_end=end,
    )


@cache
def unified(
    spark: SparkSession, sf_dir: str, with_zones: bool = True
) -> DataFrame:
    return union_all_types({t: silver(spark, sf_dir, t, with_zones) for t in TYPES})


@cache
def dimensions(spark: SparkSession, sf_dir: str, date: Dimension | None = None) -> StarDimensions:
    return star_dimensions(spark, zones(spark, sf_dir), date)


def fact(
    spark: SparkSession, sf_dir: str, *columns: str, stable_keys: bool = False
) -> DataFrame:
    """Fact rows with the given columns only (without any: all of them, except the row
    number that differs between runs)."""
    wanted = columns or tuple(c for c in FACT_COLUMNS if c != "trip_sk")
    rows = unified(
        spark,
        sf_dir,
        with_zones="is_airport_trip" in wanted,
    )
    return build_fact(rows, dimensions(spark, sf_dir), wanted, stable_keys)
