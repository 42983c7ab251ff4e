"""The eight conformed dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import fixed_values as fv
from waybill.functions.dates import date_key, period_of_day
from waybill.operators.lookup import Dimension, literal_dimension, measured
from waybill.operators.zones import zone_lookup
from waybill.sources.calendars import date_bounds, days_of, hours
from waybill.sources.inline import inline_values
from waybill.spec import RECORD_TYPES

ZONE_COLUMNS = ("zone_key", "location_id", "borough", "zone", "service_zone")


def dim_service_type(spark: SparkSession) -> Dimension:
    columns = ("service_type_key", "service_type", "description")
    return literal_dimension(spark, columns, fv.SERVICE_TYPE_ROWS, "service_type_key")


def dim_vendor(spark: SparkSession) -> Dimension:
    return literal_dimension(spark, ("vendor_key", "vendor_name"), fv.VENDOR_ROWS, "vendor_key")


def dim_rate_code(spark: SparkSession) -> Dimension:
    columns = ("rate_code_key", "rate_code_name")
    return literal_dimension(spark, columns, fv.RATE_CODE_ROWS, "rate_code_key")


def dim_payment_type(spark: SparkSession) -> Dimension:
    columns = ("payment_type_key", "payment_type_name")
    return literal_dimension(spark, columns, fv.PAYMENT_TYPE_ROWS, "payment_type_key")


def dim_hvfhs_license(spark: SparkSession) -> Dimension:
    columns = ("hvfhs_license_key", "hvfhs_license_num", "hvfhs_license_name")
    return literal_dimension(spark, columns, fv.HVFHS_LICENSE_ROWS, "hvfhs_license_key")


def dim_zone(spark: SparkSession, zones: DataFrame | Dimension) -> Dimension:
    """The zone table behind an unknown member with key -1."""
    known = zones if isinstance(zones, Dimension) else zone_lookup(zones)
    unknown = inline_values(spark, ZONE_COLUMNS, [fv.UNKNOWN_ZONE_ROW])
    rows = known.frame.selectExpr("location_id AS zone_key", *ZONE_COLUMNS[1:])
    if known.rows is None or known.size is None:
        return Dimension(unknown.unionByName(rows), "zone_key")
    # the id is there twice, and the unknown member is short
    return Dimension(unknown.unionByName(rows), "zone_key", known.rows + 1, known.size + 8 * known.rows + 100)


def dim_time(spark: SparkSession) -> Dimension:
    period = f"{period_of_day('hour')} AS period_of_day"
    frame = hours(spark).selectExpr("hour AS time_key", "hour", period)
    return Dimension(frame, "time_key", 24, 24 * 64)


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day of a one-row frame (low, high)."""
    return days_of(bounds).selectExpr(
        f"{date_key('full_date')} AS date_key",
        "full_date",
        "year(full_date) AS year",
        "month(full_date) AS month",
        "day(full_date) AS day",
        "quarter(full_date) AS quarter",
        "weekofyear(full_date) AS week_of_year",
        "dayofweek(full_date) AS day_of_week",
        "date_format(full_date, 'EEEE') AS day_name",
        "dayofweek(full_date) IN (1, 7) AS is_weekend",
    )


def dim_date(silver: Mapping[str, DataFrame]) -> Dimension:
    """Calendar over the pickup dates of all silver tables. Not counted: it is used only
    after the facts have been aggregated, where no broadcast hint is needed."""
    inputs = [(df, RECORD_TYPES[name].conform["pickup_datetime"]) for name, df in silver.items()]
    return Dimension(calendar(date_bounds(inputs)), "date_key")


def dim_date_of_months(silver: Mapping[str, DataFrame]) -> Dimension:
    """The same calendar from tables stored by month. The months come off the partition names;
    only the first and the last one are read for their dates. The driver gets one row."""
    month = "pickup_year * 100 + pickup_month"
    stacked = reduce(DataFrame.unionByName, [df.selectExpr(f"{month} AS m").distinct() for df in silver.values()])
    ends = stacked.selectExpr("min(m) AS low", "max(m) AS high").first()
    outer = F.expr(month).isin(*{m for m in ends if m is not None})
    return dim_date({name: df.filter(outer) for name, df in silver.items()})


@dataclass(frozen=True)
class StarDimensions:
    """``date`` may be left out: see ``marts.CALENDAR``."""

    service_type: Dimension
    vendor: Dimension
    rate_code: Dimension
    payment_type: Dimension
    hvfhs_license: Dimension
    zone: Dimension
    time: Dimension
    date: Dimension | None = None

    def named(self) -> dict[str, Dimension]:
        pairs = ((f"dim_{f.name}", getattr(self, f.name)) for f in fields(self))
        return {name: dimension for name, dimension in pairs if dimension is not None}


def star_dimensions(
    spark: SparkSession, zones: DataFrame | Dimension, date: Dimension | None = None
) -> StarDimensions:
    return StarDimensions(
        dim_service_type(spark),
        dim_vendor(spark),
        dim_rate_code(spark),
        dim_payment_type(spark),
        dim_hvfhs_license(spark),
        dim_zone(spark, zones),
        dim_time(spark),
        date,
    )


def stored_dimensions(spark: SparkSession, schema: str) -> StarDimensions:
    """The dimensions as tables of a schema, counted and checked for unique keys."""
    keys = {
        "service_type": "service_type_key",
        "vendor": "vendor_key",
        "rate_code": "rate_code_key",
        "payment_type": "payment_type_key",
        "hvfhs_license": "hvfhs_license_key",
        "zone": "zone_key",
        "time": "time_key",
        "date": "date_key",
    }
    return StarDimensions(
        **{n: measured(spark.read.table(f"{schema}.dim_{n}"), key) for n, key in keys.items()}
    )


def dim_row_counts(dims: StarDimensions) -> DataFrame:
    """Row count per dimension."""
    counted = [
        dimension.frame.selectExpr(f"'{name}' AS dim", "count(*) AS linhas")
        for name, dimension in dims.named().items()
    ]
    first, *rest = counted
    for frame in rest:
        first = first.unionByName(frame)
    return first
