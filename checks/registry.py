"""Every registered query, next to the SQL it must agree with.

A query builds on the stand-in trips (``standins``) and calls the library operator it is
named after. All of them read whole tables. Amounts are summed as decimals, unrounded, so both
engines get the same bits in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import standins as trips
from checks.sql import (
    CUBE_MEASURES,
    REVENUE_MONTHLY,
    exact_avg,
    exact_sum,
    half_up,
    over_sources,
    share,
    whole_avg,
)
from waybill import fixed_values as fv
from waybill.functions.dates import window_end
from waybill.functions.names import detect_dropoff_col, detect_pickup_col
from waybill.operators import bronze, dashboard, marts, quality, questions, schema, silver
from waybill.operators.dimensions import calendar, dim_date, dim_row_counts
from waybill.operators.fact import FACT_COLUMNS, conform
from waybill.operators.lookup import Dimension
from waybill.operators.sinks import preview
from waybill.operators.zones import enrich_with_zones, zone_lookup
from waybill.session import apply_settings
from waybill.sources.calendars import date_bounds, days_of, hours, months_of
from waybill.sources.files import optional_table, read_monthly
from waybill.sources.inline import inline_values
from waybill.spec import RECORD_TYPES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the other engine returns them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return wall_clock(build(apply_settings(spark), sf_dir))

        QUERIES[name] = run
        ORACLE[name] = sql.strip()
        return build

    return register


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return dashboard.metric_count(df, *columns)


def counts_sql(source: str, *columns: str) -> str:
    names = ", ".join(columns)
    return over_sources(f"SELECT {names}, count(*) AS count FROM {source} GROUP BY ALL")


ZONE_COLUMNS_SQL = """
  p.borough AS pickup_borough, p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
  d.borough AS dropoff_borough, d.zone AS dropoff_zone, d.service_zone AS dropoff_service_zone,
  coalesce(p.service_zone = 'Airports', false) OR coalesce(d.service_zone = 'Airports', false)
    AS is_airport_trip"""
ZONE_JOINS_SQL = """LEFT JOIN zone p ON t.pu_location_id = p.location_id
                    LEFT JOIN zone d ON t.do_location_id = d.location_id"""


# --- sources -----------------------------------------------------------------------


def _order_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_bounds([(trips.table(spark, sf_dir, "orders"), "o_orderdate")])


def _all_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_bounds(
        [
            (trips.table(spark, sf_dir, "orders"), "o_orderdate"),
            (trips.table(spark, sf_dir, "lineitem"), "l_shipdate"),
            (trips.table(spark, sf_dir, "events"), "ts"),
        ]
    )


DAYS_OF_ALL = """
  SELECT CAST(o_orderdate AS DATE) AS d FROM orders
  UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
  UNION SELECT CAST(ts AS DATE) FROM events"""


@query(
    "month_range",
    """SELECT strftime(m, '%Y-%m') AS year_month FROM (
         SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                       date_trunc('month', max(o_orderdate)),
                                       INTERVAL 1 MONTH)) AS m FROM orders)""",
)
def month_range(spark, sf_dir):
    return months_of(_order_bounds(spark, sf_dir))


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return read_monthly(spark, [f"{sf_dir}/orders.parquet"])


def _view(df: DataFrame, name: str) -> str:
    """A catalog entry of this session only; nothing is written."""
    df.createOrReplaceTempView(name)
    return name


@query(
    "scan_table",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ALL",
)
def scan_table(spark, sf_dir):
    name = _view(trips.table(spark, sf_dir, "orders"), "waybill_orders")
    return count_by(optional_table(spark, name), "o_orderstatus", "o_orderpriority")


@query(
    "optional_dim",
    over_sources(
        f"""SELECT true AS with_zones, is_airport_trip, count(*) AS count
            FROM (SELECT {ZONE_COLUMNS_SQL} FROM valid_ride t {ZONE_JOINS_SQL}) GROUP BY ALL
            UNION ALL SELECT false, NULL, count(*) FROM valid_ride"""
    ),
)
def optional_dim(spark, sf_dir):
    """The zone table if the catalog has one; without it silver does without the airport flag."""
    rides = trips.raw(spark, sf_dir, "fhvhv")
    present = _view(trips.zones_raw(spark, sf_dir), "waybill_zones")
    parts = []
    for name in (present, "waybill_no_such_zones"):
        zones = optional_table(spark, name)
        tidy = silver.standardize_silver(rides, zones, "fhvhv", *trips.window(spark, sf_dir, "fhvhv"))
        flag = "is_airport_trip" if "is_airport_trip" in tidy.columns else "CAST(NULL AS BOOLEAN)"
        parts.append(
            tidy.selectExpr(f"{'false' if zones is None else 'true'} AS with_zones", f"{flag} AS is_airport_trip")
        )
    return count_by(schema.balanced_union(parts), "with_zones", "is_airport_trip")


@query(
    "gen_hours",
    over_sources(
        """SELECT CAST(h AS INTEGER) AS hour, count(pickup_time_key) AS trips
           FROM range(24) AS t(h) LEFT JOIN fact ON pickup_time_key = h GROUP BY h"""
    ),
)
def gen_hours(spark, sf_dir):
    used = count_by(trips.fact(spark, sf_dir, "pickup_time_key"), "pickup_time_key")
    joined = hours(spark).join(used, F.expr("hour = pickup_time_key"), "left")
    return joined.selectExpr("hour", "COALESCE(count, 0) AS trips")


@query(
    "gen_calendar",
    f"""WITH bounds AS (SELECT min(d) AS low, max(d) AS high FROM ({DAYS_OF_ALL}) WHERE d IS NOT NULL),
         days AS (SELECT unnest(generate_series(CAST(low AS TIMESTAMP), CAST(high AS TIMESTAMP),
                                                INTERVAL 1 DAY)) AS d FROM bounds)
         SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, count(o_orderkey) AS orders
         FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY d""",
)
def gen_calendar(spark, sf_dir):
    per_day = (
        trips.table(spark, sf_dir, "orders")
        .groupBy(F.expr("CAST(o_orderdate AS DATE) AS ordered_on"))
        .agg(F.expr("count(1) AS orders"))
    )
    days = calendar(_all_bounds(spark, sf_dir)).join(per_day, F.expr("full_date = ordered_on"), "left")
    return days.selectExpr("date_key", "COALESCE(orders, 0) AS orders")


def _used_labels(spark: SparkSession, sf_dir: str) -> list[tuple[str, Dimension, str, str]]:
    dims = trips.dimensions(spark, sf_dir)
    return [
        ("service_type", dims.service_type, "service_type_key", "service_type"),
        ("vendor", dims.vendor, "vendor_key", "vendor_name"),
        ("rate_code", dims.rate_code, "rate_code_key", "rate_code_name"),
        ("payment_type", dims.payment_type, "payment_type_key", "payment_type_name"),
        ("hvfhs_license", dims.hvfhs_license, "hvfhs_license_key", "hvfhs_license_name"),
    ]


def _values_sql(rows: tuple, width: int) -> str:
    def text(value):
        return f"'{value}'" if isinstance(value, str) else str(value)

    return ", ".join("(" + ", ".join(text(v) for v in row[:width]) + ")" for row in rows)


def dimension_usage(dimension: Dimension, fact: DataFrame) -> DataFrame:
    """A dimension's rows with the number of trips that refer to each."""
    used = fact.groupBy(dimension.key).agg(F.expr("count(1) AS trips"))
    joined = dimension.frame.join(used, dimension.key, "left")
    return joined.selectExpr(*dimension.frame.columns, "COALESCE(trips, 0) AS trips")


def usage_sql(values: str, columns: str, key: str) -> str:
    return over_sources(
        f"""SELECT t.*, count(f.{key}) AS trips FROM (VALUES {values}) AS t({columns})
            LEFT JOIN fact f ON f.{key} = t.{key} GROUP BY ALL"""
    )


def _register_code_dimension(name: str, rows: tuple, columns: str) -> None:
    key = columns.split(",")[0]

    @query(name, usage_sql(_values_sql(rows, 3), columns, key))
    def build(spark, sf_dir):
        dimension = getattr(trips.dimensions(spark, sf_dir), name.removeprefix("dim_"))
        return dimension_usage(dimension, trips.fact(spark, sf_dir, key))


_register_code_dimension("dim_service_type", fv.SERVICE_TYPE_ROWS, "service_type_key, service_type, description")
_register_code_dimension("dim_vendor", fv.VENDOR_ROWS, "vendor_key, vendor_name")
_register_code_dimension("dim_rate_code", fv.RATE_CODE_ROWS, "rate_code_key, rate_code_name")
_register_code_dimension("dim_payment_type", fv.PAYMENT_TYPE_ROWS, "payment_type_key, payment_type_name")
_register_code_dimension(
    "dim_hvfhs_license", fv.HVFHS_LICENSE_ROWS, "hvfhs_license_key, hvfhs_license_num, hvfhs_license_name"
)


@query(
    "inline_values",
    over_sources(
        "\nUNION ALL ".join(
            f"""SELECT '{name}' AS dim, t.k AS key, t.label, count(f.{name}_key) AS trips
                FROM (VALUES {_values_sql([(r[0], r[-1 if name == 'hvfhs_license' else 1]) for r in rows], 2)}) AS t(k, label)
                LEFT JOIN fact f ON f.{name}_key = t.k GROUP BY t.k, t.label"""
            for name, rows in (
                ("service_type", fv.SERVICE_TYPE_ROWS),
                ("vendor", fv.VENDOR_ROWS),
                ("rate_code", fv.RATE_CODE_ROWS),
                ("payment_type", fv.PAYMENT_TYPE_ROWS),
                ("hvfhs_license", fv.HVFHS_LICENSE_ROWS),
            )
        )
    ),
)
def all_code_labels(spark, sf_dir):
    """The facts are read once: grouped by all five keys, and each group then counts for one
    row of every dimension."""
    labels = _used_labels(spark, sf_dir)
    keys = [key for _, _, key, _ in labels]
    groups = count_by(trips.fact(spark, sf_dir, *keys), *keys)
    pairs = ", ".join(f"'{name}', {key}" for name, _, key, _ in labels)
    used = (
        groups.selectExpr("count", f"stack({len(keys)}, {pairs}) AS (used_dim, used_key)")
        .groupBy("used_dim", "used_key")
        .agg(F.expr("sum(count) AS trips"))
    )
    members = schema.balanced_union(
        [
            dimension.frame.selectExpr(f"'{name}' AS dim", f"{key} AS key", f"{label} AS label")
            for name, dimension, key, label in labels
        ]
    )
    joined = members.join(used, F.expr("dim = used_dim AND key = used_key"), "left")
    return joined.selectExpr("dim", "key", "label", "COALESCE(trips, 0) AS trips")


FACT_VALUES = tuple(c for c in FACT_COLUMNS if c != "trip_sk")


def value_counts_by_column(df: DataFrame, *columns: str) -> DataFrame:
    """One row per column: its name and how many values it has. One pass, no shuffle of rows."""
    counted = df.agg(*[F.expr(f"count({c}) AS {c}") for c in columns])
    pairs = ", ".join(f"'{c.lower()}', {c}" for c in columns)
    return counted.selectExpr(f"stack({len(columns)}, {pairs}) AS (col, filled)")


@query(
    "scan_column_catalog",
    over_sources(
        "\nUNION ALL ".join(f"SELECT '{c}' AS col, count({c}) AS filled FROM fact" for c in FACT_VALUES)
    ),
)
def scan_column_catalog(spark, sf_dir):
    fact = trips.fact(spark, sf_dir)
    filled = value_counts_by_column(fact, *fact.columns)
    return quality.column_names(fact).join(filled, "col")


LANDED = """SELECT strftime(o_orderdate, '%Y-%m') AS year_month FROM orders
            UNION SELECT strftime(ts, '%Y-%m') FROM events"""


def _landed_and_expected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders, events = trips.table(spark, sf_dir, "orders"), trips.table(spark, sf_dir, "events")
    present = [
        df.groupBy(F.expr(f"date_format({when}, 'yyyy-MM') AS year_month")).agg(F.expr("count(1) AS n"))
        for df, when in ((orders, "o_orderdate"), (events, "ts"))
    ]
    expected = months_of(date_bounds([(orders, "o_orderdate"), (events, "ts")]))
    return present[0].unionByName(present[1]), expected


EXPECTED = """SELECT strftime(m, '%Y-%m') AS year_month FROM (
      SELECT unnest(generate_series(date_trunc('month', least(o.low, e.low)),
                                    date_trunc('month', greatest(o.high, e.high)),
                                    INTERVAL 1 MONTH)) AS m
      FROM (SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders) o,
           (SELECT min(ts) AS low, max(ts) AS high FROM events) e)"""


@query(
    "landing_completeness",
    f"""WITH landed AS ({LANDED}), expected AS ({EXPECTED})
        SELECT year_month, CASE WHEN year_month IN (SELECT year_month FROM landed)
               THEN 'ingested' ELSE 'missing' END AS status FROM expected""",
)
def landing_completeness(spark, sf_dir):
    landed, expected = _landed_and_expected(spark, sf_dir)
    return quality.landing_completeness(expected, landed)


@query(
    "landing_missing_months",
    f"WITH landed AS ({LANDED}), expected AS ({EXPECTED}) SELECT * FROM expected EXCEPT SELECT * FROM landed",
)
def landing_missing_months(spark, sf_dir):
    landed, expected = _landed_and_expected(spark, sf_dir)
    return quality.missing_months(expected, landed)


# --- schema reconciliation and projections --------------------------------------------


def _drifting_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders as three periodic files: whole amounts at first, then another spelling and an
    extra column, then other types."""
    orders = trips.table(spark, sf_dir, "orders")
    return [
        orders.filter("o_orderdate < TIMESTAMP_NTZ'1997-01-01 00:00:00'").selectExpr(
            "o_orderkey", "o_custkey", "CAST(o_totalprice AS BIGINT) AS o_totalprice"
        ),
        orders.filter(
            "o_orderdate >= TIMESTAMP_NTZ'1997-01-01 00:00:00'"
            " AND o_orderdate < TIMESTAMP_NTZ'1999-01-01 00:00:00'"
        ).selectExpr("o_orderkey", "o_custkey", "o_totalprice AS O_TotalPrice", "o_orderstatus"),
        orders.filter("o_orderdate >= TIMESTAMP_NTZ'1999-01-01 00:00:00'").selectExpr(
            "CAST(o_orderkey AS INT) AS O_ORDERKEY",
            "CAST(o_custkey AS DECIMAL(12, 0)) AS o_custkey",
            "o_orderstatus",
            "o_orderpriority",
        ),
    ]


DRIFTED = """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
       CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN trunc(o_totalprice)
            WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders"""


@query("unify_schemas", DRIFTED)
def unify_schemas(spark, sf_dir):
    return schema.unify_schemas(_drifting_slices(spark, sf_dir))


@query(
    "promote_type",
    """SELECT 'bigint' AS orderkey, 'double' AS custkey, 'double' AS totalprice, count(*) AS n FROM orders""",
)
def promote_type(spark, sf_dir):
    unified = schema.unify_schemas(_drifting_slices(spark, sf_dir))
    return unified.groupBy(
        F.expr("typeof(o_orderkey) AS orderkey"),
        F.expr("typeof(o_custkey) AS custkey"),
        F.expr("typeof(o_totalprice) AS totalprice"),
    ).agg(F.expr("count(1) AS n"))


@query(
    "union_files",
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'none'
                   WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'status' ELSE 'both' END AS extra,
              count(*) AS n FROM orders GROUP BY 1""",
)
def union_files(spark, sf_dir):
    parts = _drifting_slices(spark, sf_dir)
    target = schema.reconcile([p.schema for p in parts])
    unioned = schema.balanced_union([schema.align(p, target) for p in parts])
    return unioned.groupBy(
        F.expr(
            "CASE WHEN o_orderpriority IS NOT NULL THEN 'both'"
            " WHEN o_orderstatus IS NOT NULL THEN 'status' ELSE 'none' END AS extra"
        )
    ).agg(F.expr("count(1) AS n"))


@query(
    "snake_case_columns",
    over_sources(
        """SELECT vendor_id, pickup_datetime AS tpep_pickup_datetime,
                  dropoff_datetime AS tpep_dropoff_datetime, passenger_count, trip_distance,
                  ratecode_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type,
                  fare_amount, tip_amount, tolls_amount, total_amount
           FROM line WHERE service_type = 'yellow'"""
    ),
)
def snake_case_columns(spark, sf_dir):
    return schema.snake_case_columns(trips.raw(spark, sf_dir, "yellow"))


@query(
    "detect_column",
    over_sources(
        """SELECT service_type, CASE service_type WHEN 'yellow' THEN 'tpep_pickup_datetime'
                  ELSE 'lpep_pickup_datetime' END AS pickup_column,
                  CASE service_type WHEN 'yellow' THEN 'tpep_dropoff_datetime'
                  ELSE 'lpep_dropoff_datetime' END AS dropoff_column,
                  count(pickup_datetime) AS picked_up, count(dropoff_datetime) AS dropped_off
           FROM line GROUP BY 1, 2, 3
           UNION ALL SELECT 'fhv', 'pickup_datetime', 'drop_off_datetime',
                  count(pickup_datetime), count(drop_off_datetime) FROM dispatch
           UNION ALL SELECT 'fhvhv', 'pickup_datetime', 'dropoff_datetime',
                  count(pickup_datetime), count(dropoff_datetime) FROM ride"""
    ),
)
def detect_column(spark, sf_dir):
    parts = []
    for taxi_type in trips.TYPES:
        named = schema.snake_case_columns(trips.raw(spark, sf_dir, taxi_type))
        pickup, dropoff = detect_pickup_col(named.columns), detect_dropoff_col(named.columns)
        parts.append(
            named.selectExpr(
                f"'{taxi_type}' AS service_type",
                f"'{pickup}' AS pickup_column",
                f"'{dropoff}' AS dropoff_column",
                f"count({pickup}) AS picked_up",
                f"count({dropoff}) AS dropped_off",
            )
        )
    return schema.balanced_union(parts)


@query("add_ingestion_ts", "SELECT count(*) AS n, count(*) AS stamped FROM lineitem")
def add_ingestion_ts(spark, sf_dir):
    stamped = bronze.add_ingestion_ts(trips.table(spark, sf_dir, "lineitem"))
    return stamped.selectExpr("count(1) AS n", "count_if(dt_ingestion <= now()) AS stamped")


@query(
    "build_bronze",
    over_sources(
        """SELECT DISTINCT dispatching_base_num, pickup_datetime,
                  CAST(NULL AS TIMESTAMP) AS "dropOff_datetime",
                  CAST(pu_location_id AS DOUBLE) AS "PUlocationID",
                  CAST(NULL AS DOUBLE) AS "DOlocationID", sr_flag AS "SR_Flag",
                  affiliated_base_number AS "Affiliated_base_number", true AS stamped
           FROM dispatch"""
    ),
)
def build_bronze(spark, sf_dir):
    replica = bronze.build_bronze(trips.raw(spark, sf_dir, "fhv"))
    return replica.withColumn("stamped", F.expr("dt_ingestion IS NOT NULL")).drop("dt_ingestion")


@query(
    "cast_datetime",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS tpep_pickup_datetime,
              CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END
                AS tpep_dropoff_datetime
       FROM orders""",
)
def cast_datetime(spark, sf_dir):
    """Times that arrive as text, some of it no time at all."""
    text = trips.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_orderdate AS STRING) END AS tpep_pickup_datetime",
        "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS tpep_dropoff_datetime",
    )
    return silver.cast_datetimes(text)


@query(
    "cast_location",
    """SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_nationkey END AS pu_location_id,
              c_nationkey AS do_location_id FROM customer""",
)
def cast_location(spark, sf_dir):
    text = trips.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'N/A' ELSE CAST(c_nationkey AS STRING) END AS pu_location_id",
        "CAST(c_nationkey AS DOUBLE) AS do_location_id",
    )
    return silver.cast_locations(text)


@query(
    "derive_partitions",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS pickup_year,
              CAST(month(o_orderdate) AS INTEGER) AS pickup_month, count(*) AS count
       FROM orders GROUP BY 1, 2""",
)
def derive_partitions(spark, sf_dir):
    orders = trips.table(spark, sf_dir, "orders").selectExpr("o_orderdate AS pickup_datetime")
    return count_by(silver.derive_partitions(orders), *silver.PARTITION_COLUMNS)


# fixed values: published codes and their labels
VENDOR_SQL = "CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.' END"
RATE_SQL = """CASE ratecode_id WHEN 1 THEN 'Standard' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
              WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negociada' WHEN 6 THEN 'Group ride' END"""
PAYMENT_SQL = """CASE payment_type WHEN 1 THEN 'Cartao de credito' WHEN 2 THEN 'Dinheiro'
              WHEN 3 THEN 'Sem cobranca' WHEN 4 THEN 'Disputa' WHEN 5 THEN 'Desconhecido'
              WHEN 6 THEN 'Corrida anulada' END"""
LICENSE_SQL = """CASE hvfhs_license_num WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber'
              WHEN 'HV0004' THEN 'Via' WHEN 'HV0005' THEN 'Lyft' END"""
FLAG_SQL = "CASE upper(trim({0})) WHEN 'Y' THEN true WHEN 'N' THEN false END"


@query(
    "code_labels",
    over_sources(
        f"""SELECT vendor_id, {VENDOR_SQL} AS vendor_name, ratecode_id, {RATE_SQL} AS ratecode_name,
                   payment_type, {PAYMENT_SQL} AS payment_type_name, count(*) AS count
            FROM line WHERE service_type = 'yellow' GROUP BY ALL"""
    ),
)
def code_labels(spark, sf_dir):
    named = schema.snake_case_columns(trips.raw(spark, sf_dir, "yellow"))
    labelled = silver.add_coded_labels(named, "yellow")
    pairs = [c for label in RECORD_TYPES["yellow"].labels for c in (label.source, label.target)]
    return count_by(labelled, *pairs)


@query(
    "code_labels_license",
    over_sources(
        f"""SELECT hvfhs_license_num, {LICENSE_SQL} AS hvfhs_license_name, count(*) AS count
            FROM ride GROUP BY ALL"""
    ),
)
def code_labels_license(spark, sf_dir):
    named = schema.snake_case_columns(trips.raw(spark, sf_dir, "fhvhv"))
    labelled = silver.add_coded_labels(named, "fhvhv")
    return count_by(labelled, "hvfhs_license_num", "hvfhs_license_name")


@query(
    "yn_to_bool",
    over_sources(
        f"""SELECT service_type, {FLAG_SQL.format('store_and_fwd_flag')} AS flag, count(*) AS count
            FROM line GROUP BY ALL
            UNION ALL SELECT 'fhvhv', {FLAG_SQL.format('shared_request_flag')}, count(*)
            FROM ride GROUP BY ALL"""
    ),
)
def yn_to_bool(spark, sf_dir):
    parts = []
    for taxi_type in ("yellow", "green", "fhvhv"):
        named = schema.snake_case_columns(trips.raw(spark, sf_dir, taxi_type))
        (flag,) = RECORD_TYPES[taxi_type].flags
        labelled = silver.add_coded_labels(named, taxi_type)
        parts.append(labelled.selectExpr(f"'{taxi_type}' AS service_type", f"{flag} AS flag"))
    return count_by(schema.balanced_union(parts), "service_type", "flag")


def _metered_sql(service_type: str, prefix: str) -> str:
    return over_sources(
        f"""SELECT t.* EXCLUDE (service_type, pickup_datetime, dropoff_datetime, store_and_fwd_flag,
                                pu_location_id, do_location_id),
                   CAST(t.pu_location_id AS INTEGER) AS pu_location_id,
                   CAST(t.do_location_id AS INTEGER) AS do_location_id,
                   pickup_datetime AS {prefix}_pickup_datetime,
                   dropoff_datetime AS {prefix}_dropoff_datetime,
                   {FLAG_SQL.format('store_and_fwd_flag')} AS store_and_fwd_flag,
                   CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
                   CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
                   {VENDOR_SQL} AS vendor_name, {RATE_SQL} AS ratecode_name,
                   {PAYMENT_SQL} AS payment_type_name, {ZONE_COLUMNS_SQL}
            FROM valid_line t {ZONE_JOINS_SQL} WHERE service_type = '{service_type}'"""
    )


SILVER_SQL = {
    "yellow": _metered_sql("yellow", "tpep"),
    "green": _metered_sql("green", "lpep"),
    "fhv": over_sources(
        f"""SELECT t.* EXCLUDE (pu_location_id, do_location_id),
                   CAST(t.pu_location_id AS INTEGER) AS pu_location_id,
                   CAST(t.do_location_id AS INTEGER) AS do_location_id,
                   CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
                   CAST(month(pickup_datetime) AS INTEGER) AS pickup_month, {ZONE_COLUMNS_SQL}
            FROM valid_dispatch t {ZONE_JOINS_SQL}"""
    ),
    "fhvhv": over_sources(
        f"""SELECT t.* EXCLUDE (pu_location_id, do_location_id, shared_request_flag),
                   CAST(t.pu_location_id AS INTEGER) AS pu_location_id,
                   CAST(t.do_location_id AS INTEGER) AS do_location_id,
                   {FLAG_SQL.format('shared_request_flag')} AS shared_request_flag,
                   CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
                   CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
                   {LICENSE_SQL} AS hvfhs_license_name, {ZONE_COLUMNS_SQL}
            FROM valid_ride t {ZONE_JOINS_SQL}"""
    ),
}


def _register_silver(name: str, taxi_type: str) -> None:
    @query(name, SILVER_SQL[taxi_type])
    def build(spark, sf_dir):
        return trips.silver(spark, sf_dir, taxi_type)


_register_silver("standardize_silver", "yellow")
_register_silver("standardize_silver_green", "green")
_register_silver("standardize_silver_fhv", "fhv")
_register_silver("standardize_silver_fhvhv", "fhvhv")


@query(
    "standardize_silver_unfiltered",
    over_sources(
        f"""SELECT CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
                   CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
                   dropoff_datetime < pickup_datetime AS reversed, {ZONE_COLUMNS_SQL}, count(*) AS count
            FROM line t {ZONE_JOINS_SQL} WHERE service_type = 'yellow' GROUP BY ALL"""
    ),
)
def standardize_silver_unfiltered(spark, sf_dir):
    """Without a window no trip is left out, not even one that ends before it begins."""
    every = silver.standardize_silver(trips.raw(spark, sf_dir, "yellow"), trips.zones(spark, sf_dir), "yellow")
    marked = every.withColumn("reversed", F.expr("tpep_dropoff_datetime < tpep_pickup_datetime"))
    sides = [f"{side}_{what}" for side in ("pickup", "dropoff") for what in ("borough", "zone", "service_zone")]
    return count_by(marked, "pickup_year", "pickup_month", "reversed", *sides, "is_airport_trip")


@query(
    "airport_flag",
    over_sources(
        f"""SELECT pickup_service_zone, dropoff_service_zone, is_airport_trip, count(*) AS count
            FROM (SELECT {ZONE_COLUMNS_SQL} FROM ride t {ZONE_JOINS_SQL}) GROUP BY ALL"""
    ),
)
def airport_flag(spark, sf_dir):
    rides = schema.snake_case_columns(trips.raw(spark, sf_dir, "fhvhv"))
    flagged = enrich_with_zones(rides, trips.zones(spark, sf_dir))
    return count_by(flagged, "pickup_service_zone", "dropoff_service_zone", "is_airport_trip")


@query(
    "conform_project",
    over_sources("SELECT * EXCLUDE (found_pu, found_do) FROM conformed WHERE service_type = 'fhvhv'"),
)
def conform_project(spark, sf_dir):
    return conform(trips.silver(spark, sf_dir, "fhvhv"), RECORD_TYPES["fhvhv"])


@query("union_all_types", over_sources("SELECT * EXCLUDE (found_pu, found_do) FROM conformed"))
def union_all_types(spark, sf_dir):
    return trips.unified(spark, sf_dir)


@query(
    "component_total",
    over_sources("SELECT pickup_datetime, total_amount FROM trip WHERE service_type = 'fhvhv'"),
)
def component_total(spark, sf_dir):
    rides = trips.silver(spark, sf_dir, "fhvhv", with_zones=False)
    return conform(rides, RECORD_TYPES["fhvhv"]).select("pickup_datetime", "total_amount")


def _register_fact_counts(name: str, *columns: str) -> None:
    @query(name, counts_sql("fact", *columns))
    def build(spark, sf_dir):
        return count_by(trips.fact(spark, sf_dir, *columns), *columns)


_register_fact_counts("date_key", "service_type_key", "pickup_date_key", "dropoff_date_key")
_register_fact_counts("hour_key", "service_type_key", "pickup_time_key")
_register_fact_counts("trip_duration", "service_type_key", "trip_duration_min")
_register_fact_counts(
    "unknown_member",
    "pickup_zone_key",
    "dropoff_zone_key",
    "vendor_key",
    "rate_code_key",
    "payment_type_key",
    "hvfhs_license_key",
)
_register_fact_counts("degenerate_attr", "vendor_key", "vendor_id")
_register_fact_counts("role_playing_lookup", "service_type_key", "pickup_zone_key", "dropoff_zone_key")
_register_fact_counts("code_dim_lookup", "service_type_key", "vendor_key", "rate_code_key", "payment_type_key")
_register_fact_counts("natural_key_lookup", "service_type_key", "hvfhs_license_key")
_register_fact_counts("service_type_join", "service_type_key")
_register_fact_counts("metric_count", "service_type_key", "is_airport_trip")


@query(
    "surrogate_key",
    over_sources(
        """SELECT trip_sk, service_type_key, 1::BIGINT AS trips FROM (SELECT md5(service_type || '|' || coalesce(CAST(vendor_id AS VARCHAR), '')
                   || '|' || coalesce(CAST(CAST(pu_location_id AS INTEGER) AS VARCHAR), '')
                   || '|' || coalesce(CAST(CAST(do_location_id AS INTEGER) AS VARCHAR), '')
                   || '|' || coalesce(CAST(epoch_us(pickup_datetime) AS VARCHAR), '')
                   || '|' || coalesce(CAST(epoch_us(dropoff_datetime) AS VARCHAR), '')) AS hashed,
                  hashed || '-' || CAST(row_number() OVER (PARTITION BY hashed) AS VARCHAR) AS trip_sk,
                  service_type_key
           FROM fact)"""
    ),
)
def surrogate_key(spark, sf_dir):
    keyed = trips.fact(spark, sf_dir, "trip_sk", "service_type_key", stable_keys=True)
    return keyed.groupBy("trip_sk", "service_type_key").agg(F.count(F.lit(1)).alias("trips"))


@query(
    "sequential_key",
    over_sources("SELECT count(*) AS n, count(*) AS distinct_keys FROM fact"),
)
def sequential_key(spark, sf_dir):
    keyed = trips.fact(spark, sf_dir, "trip_sk")
    per_key = keyed.groupBy("trip_sk").agg(F.expr("count(1) AS n"))
    return per_key.selectExpr("sum(n) AS n", "count(1) AS distinct_keys")


# --- filters and contracts ---------------------------------------------------------


@query(
    "valid_dates",
    over_sources(
        """SELECT vendor_id, pickup_datetime AS tpep_pickup_datetime,
                  dropoff_datetime AS tpep_dropoff_datetime, total_amount
           FROM valid_line WHERE service_type = 'yellow'"""
    ),
)
def valid_dates(spark, sf_dir):
    lines = schema.snake_case_columns(trips.raw(spark, sf_dir, "yellow"))
    kept = silver.filter_valid_dates(lines, *trips.window(spark, sf_dir, "yellow"))
    return kept.select("vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount")


@query(
    "valid_window_default",
    """SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS valid_start,
              strftime(date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH, '%Y-%m-%d') AS valid_end
       FROM orders""",
)
def valid_window_default(spark, sf_dir):
    return _order_bounds(spark, sf_dir).selectExpr(
        "CAST(low AS STRING) AS valid_start", f"CAST({window_end('high')} AS STRING) AS valid_end"
    )


MART_COLUMNS = (
    "service_type_key",
    "pickup_date_key",
    "total_amount",
    "trip_distance",
    "trip_duration_min",
    "tip_amount",
)


def _revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = trips.fact(spark, sf_dir, *MART_COLUMNS)
    return marts.agg_revenue_monthly(fact, trips.dimensions(spark, sf_dir))


@query(
    "filter_eq",
    over_sources("SELECT * FROM mart WHERE service_type = 'yellow' AND month = 5", f"mart AS ({REVENUE_MONTHLY})"),
)
def filter_eq(spark, sf_dir):
    return _revenue(spark, sf_dir).filter("service_type = 'yellow' AND month = 5")


@query(
    "filter_not_null",
    over_sources(
        "SELECT service_type_key, count(*) AS count FROM fact WHERE dropoff_date_key IS NOT NULL GROUP BY 1"
    ),
)
def filter_not_null(spark, sf_dir):
    fact = trips.fact(spark, sf_dir, "service_type_key", "dropoff_date_key")
    return count_by(fact.filter("dropoff_date_key IS NOT NULL"), "service_type_key")


HOURLY_SQL = """SELECT description AS service_type, hour AS pickup_hour, count(*) AS trip_count
                FROM starred GROUP BY 1, 2"""


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = trips.fact(spark, sf_dir, "service_type_key", "pickup_time_key")
    return dashboard.hourly_by_type(fact, trips.dimensions(spark, sf_dir))


@query(
    "filter_multiselect",
    over_sources("SELECT * FROM hourly WHERE service_type IN ('Yellow Taxi', 'Green Taxi')", f"hourly AS ({HOURLY_SQL})"),
)
def filter_multiselect(spark, sf_dir):
    return dashboard.select_values(_hourly(spark, sf_dir), "service_type", ["Yellow Taxi", "Green Taxi"])


@query(
    "filter_options",
    over_sources(
        """SELECT service_type, count(*) FILTER (pickup_hour >= 12) AS service_type_associativity
           FROM hourly GROUP BY 1""",
        f"hourly AS ({HOURLY_SQL})",
    ),
)
def filter_options(spark, sf_dir):
    return dashboard.filter_options(_hourly(spark, sf_dir), "service_type", F.expr("pickup_hour >= 12"))


@query(
    "column_contract",
    over_sources(f"SELECT '{fv.CONTRACT_OK}' AS consumption_contract, count(*) AS trips FROM fact"),
)
def column_contract(spark, sf_dir):
    fact = trips.fact(spark, sf_dir)
    verdict = quality.column_contract(fact).selectExpr("*", "CAST(NULL AS BIGINT) AS trips")
    counted = fact.selectExpr("CAST(NULL AS STRING) AS consumption_contract", "count(1) AS trips")
    return verdict.unionByName(counted).selectExpr(
        "max(consumption_contract) AS consumption_contract", "max(trips) AS trips"
    )


LACKED = {
    "yellow": ("hvfhs_license_num", "pickup_datetime", "dropoff_datetime"),
    "green": ("hvfhs_license_num", "pickup_datetime", "dropoff_datetime"),
    "fhv": ("vendor_id", "payment_type", "passenger_count", "total_amount", "hvfhs_license_num", "dropoff_datetime"),
    "fhvhv": ("vendor_id", "payment_type", "passenger_count", "total_amount"),
}
ASKED_OF_SILVER = tuple(sorted({c for lacked in LACKED.values() for c in lacked}))


@query(
    "missing_columns",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS taxi_type, '{c}' AS col, (SELECT count(*) FROM {table}) > 0 AS has_rows"
        for t, table in (("yellow", "lineitem"), ("green", "lineitem"), ("fhv", "orders"), ("fhvhv", "events"))
        for c in LACKED[t]
    ),
)
def missing_columns(spark, sf_dir):
    """What each silver table lacks of the columns somebody might ask all of them for."""
    found = []
    for t in trips.TYPES:
        rows = trips.silver(spark, sf_dir, t)
        lacked = [r["col"] for r in quality.missing_columns(rows, ASKED_OF_SILVER).collect()]  # names only
        names = F.explode(F.array(*map(F.lit, lacked))).alias("col")
        found.append(rows.selectExpr("count(1) > 0 AS has_rows").select(F.lit(t).alias("taxi_type"), names, "has_rows"))
    return schema.balanced_union(found)


# --- joins -----------------------------------------------------------------------------


@query(
    "zone_enrich",
    over_sources(
        f"""SELECT pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, count(*) AS count
            FROM (SELECT {ZONE_COLUMNS_SQL} FROM valid_line t {ZONE_JOINS_SQL} WHERE service_type = 'green')
            GROUP BY ALL"""
    ),
)
def zone_enrich(spark, sf_dir):
    enriched = trips.silver(spark, sf_dir, "green")
    return count_by(enriched, "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


QUARTER = marts.Axis(
    "pickup_date_key",
    "date",
    {"year": "year", "quarter": "quarter", "day_name": "day_name", "is_weekend": "is_weekend"},
)


@query(
    "star_join_inner",
    over_sources(
        f"""SELECT service_type, year, CAST(quarter(pickup_datetime) AS INTEGER) AS quarter,
                   dayname(pickup_datetime) AS day_name,
                   dayofweek(pickup_datetime) IN (0, 6) AS is_weekend, count(*) AS trips,
                   {exact_avg('total_amount')} AS avg_total_amount,
                   {exact_sum('total_amount')} AS sum_total_amount
            FROM starred GROUP BY ALL"""
    ),
)
def star_join_inner(spark, sf_dir):
    """With a calendar built from the trips themselves, joined as a table."""
    tables = {t: trips.silver(spark, sf_dir, t, False) for t in trips.TYPES}
    dims = trips.dimensions(spark, sf_dir, dim_date(tables))
    fact = trips.fact(spark, sf_dir, "service_type_key", "pickup_date_key", "total_amount")
    return marts.star_rollup(fact, dims, (marts.SERVICE_TYPE, QUARTER), (marts.TOTAL,))


CUBE_COLUMNS = MART_COLUMNS + ("pickup_time_key", "pickup_zone_key", "payment_type_key", "passenger_count")
CUBE_LABELS = "service_type, year, month, hour, pickup_borough, payment_type_name"


@query("star_join_mixed", over_sources(f"SELECT {CUBE_LABELS}, {CUBE_MEASURES} FROM starred GROUP BY ALL"))
def star_join_mixed(spark, sf_dir):
    fact = trips.fact(spark, sf_dir, *CUBE_COLUMNS)
    return marts.star_rollup(
        fact, trips.dimensions(spark, sf_dir), marts.CUBE_AXES, marts.CUBE_MEASURES
    )


@query(
    "dashboard_join",
    over_sources("SELECT description, pickup_borough, pickup_zone, count(*) AS trips FROM starred GROUP BY ALL"),
)
def dashboard_join(spark, sf_dir):
    fact = trips.fact(spark, sf_dir, "service_type_key", "pickup_zone_key")
    axes = (marts.SERVICE_DESCRIPTION, marts.PICKUP_ZONE)
    return marts.star_rollup(fact, trips.dimensions(spark, sf_dir), axes)


@query(
    "scalar_subquery",
    f"""SELECT strftime(min(d), '%Y-%m-%d') AS low, strftime(max(d), '%Y-%m-%d') AS high,
               CAST(date_diff('day', min(d), max(d)) + 1 AS BIGINT) AS days FROM ({DAYS_OF_ALL})""",
)
def scalar_subquery(spark, sf_dir):
    days = days_of(_all_bounds(spark, sf_dir))
    return days.selectExpr(
        "CAST(min(full_date) AS STRING) AS low",
        "CAST(max(full_date) AS STRING) AS high",
        "count(1) AS days",
    )


# --- deduplication ------------------------------------------------------------------------


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines, the returned ones delivered twice."""
    lines = trips.table(spark, sf_dir, "lineitem")
    return lines.unionByName(lines.filter("l_returnflag = 'R'"))


REDELIVERED = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R')"
LINE_KEY = ("l_orderkey", "l_linenumber")


@query("dedup_full_row", f"SELECT DISTINCT * FROM {REDELIVERED}")
def dedup_full_row(spark, sf_dir):
    return bronze.deduplicate(_redelivered(spark, sf_dir))


@query(
    "dedup_keys",
    f"SELECT DISTINCT l_orderkey, l_linenumber, CAST(1 AS BIGINT) AS kept, CAST(1 AS BIGINT) AS delivered FROM {REDELIVERED}",
)
def dedup_keys(spark, sf_dir):
    """Which row of a key survives is arbitrary. Returned per key: how many rows survive, and
    how many of these the source has exactly like that, in all columns."""
    source = _redelivered(spark, sf_dir)
    kept = bronze.deduplicate(source, LINE_KEY)
    as_delivered = F.expr(" AND ".join(f"kept.{c} <=> source.{c}" for c in source.columns))
    found = kept.alias("kept").join(source.distinct().alias("source"), as_delivered, "left")
    return found.groupBy("kept.l_orderkey", "kept.l_linenumber").agg(
        F.count(F.lit(1)).alias("kept"), F.count("source.l_orderkey").alias("delivered")
    )


@query(
    "dedup_first",
    """SELECT * FROM lineitem QUALIFY row_number() OVER (
         PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                  l_returnflag, l_linestatus) = 1""",
)
def dedup_first(spark, sf_dir):
    lines = trips.table(spark, sf_dir, "lineitem")
    order = ["l_shipdate"] + [c for c in lines.columns if c not in (*LINE_KEY, "l_shipdate")]
    return bronze.deduplicate_first(lines, LINE_KEY, [F.col(c) for c in order])


@query("dedup_off", f"SELECT l_returnflag, count(*) AS count FROM {REDELIVERED} GROUP BY 1")
def dedup_off(spark, sf_dir):
    replica = bronze.build_bronze(_redelivered(spark, sf_dir), dedup=False)
    return count_by(replica, "l_returnflag")


# --- marts and cube ---------------------------------------------------------------------------


@query("revenue_monthly", over_sources(REVENUE_MONTHLY))
def revenue_monthly(spark, sf_dir):
    return _revenue(spark, sf_dir)


@query(
    "trips_by_hour",
    over_sources(
        f"""SELECT service_type, year, month, hour, period_of_day, count(*) AS trips,
                   {whole_avg('passenger_count')} AS avg_passenger_count,
                   {exact_avg('total_amount')} AS avg_total_amount
            FROM starred GROUP BY ALL"""
    ),
)
def trips_by_hour(spark, sf_dir):
    columns = ("service_type_key", "pickup_date_key", "pickup_time_key", "passenger_count", "total_amount")
    fact = trips.fact(spark, sf_dir, *columns)
    return marts.agg_trips_by_hour(fact, trips.dimensions(spark, sf_dir))


ZONE_MART = f"""SELECT service_type, pickup_borough, pickup_zone, count(*) AS trips,
                   {exact_avg('total_amount')} AS avg_total_amount,
                   {exact_avg('trip_distance')} AS avg_trip_distance,
                   CAST(sum(CAST(is_airport_trip AS INTEGER)) AS BIGINT) AS airport_trips
            FROM starred GROUP BY ALL"""


def _zone_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("service_type_key", "pickup_zone_key", "total_amount", "trip_distance", "is_airport_trip")
    fact = trips.fact(spark, sf_dir, *columns)
    return marts.agg_trips_by_zone(fact, trips.dimensions(spark, sf_dir))


@query("trips_by_zone", over_sources(ZONE_MART))
def trips_by_zone(spark, sf_dir):
    return _zone_mart(spark, sf_dir)


@query(
    "cube_trips",
    over_sources(
        f"""SELECT {CUBE_LABELS}, CAST(grouping_id({CUBE_LABELS}) AS BIGINT) AS grouping_id, {CUBE_MEASURES}
            FROM starred GROUP BY CUBE ({CUBE_LABELS})"""
    ),
)
def cube_trips(spark, sf_dir):
    fact = trips.fact(spark, sf_dir, *CUBE_COLUMNS)
    return marts.cube_trips(fact, trips.dimensions(spark, sf_dir))


# --- questions --------------------------------------------------------------------------------


@query(
    "q_monthly_average",
    over_sources(
        f"""SELECT year, month, trips, {half_up('avg_total_amount', 2)} AS avg_total_amount_por_corrida,
                  {half_up('sum_total_amount', 2)} AS total_recebido_no_mes
           FROM mart WHERE service_type = 'yellow'""",
        f"mart AS ({REVENUE_MONTHLY})",
    ),
)
def q_monthly_average(spark, sf_dir):
    return questions.monthly_average(_revenue(spark, sf_dir))


@query(
    "q_average_of_months",
    over_sources(
        f"""SELECT {half_up(exact_avg('sum_total_amount'), 2)} AS media_total_recebido_por_mes,
                  {half_up(exact_avg('avg_total_amount'), 2)} AS media_total_amount_por_corrida
           FROM mart WHERE service_type = 'yellow'""",
        f"mart AS ({REVENUE_MONTHLY})",
    ),
)
def q_average_of_months(spark, sf_dir):
    return questions.average_of_months(_revenue(spark, sf_dir))


@query(
    "q_passengers_by_hour",
    over_sources(
        f"""SELECT hour, period_of_day, {half_up(whole_avg('passenger_count'), 3)} AS avg_passenger_count,
                  count(passenger_count) AS trips_com_passageiros
           FROM starred WHERE month = 5 GROUP BY 1, 2"""
    ),
)
def q_passengers_by_hour(spark, sf_dir):
    fact = trips.fact(spark, sf_dir, "pickup_date_key", "pickup_time_key", "passenger_count")
    return questions.passengers_by_hour(fact, trips.dimensions(spark, sf_dir), month=5)


def _yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.silver(spark, sf_dir, "yellow", with_zones=False)


@query(
    "q_silver_monthly",
    over_sources(
        f"""SELECT CAST(year(pickup_datetime) AS INTEGER) AS ano, CAST(month(pickup_datetime) AS INTEGER) AS mes,
                  count(*) AS qt_corridas, {half_up(exact_avg('total_amount'), 2)} AS media_total_amount,
                  {half_up(exact_sum('total_amount'), 2)} AS soma_total_amount
           FROM valid_line WHERE service_type = 'yellow' GROUP BY 1, 2"""
    ),
)
def q_silver_monthly(spark, sf_dir):
    return questions.silver_monthly(_yellow(spark, sf_dir))


@query(
    "q_silver_overall",
    over_sources(
        f"""SELECT {half_up(exact_avg('total_amount'), 2)} AS media_total_amount_periodo
           FROM valid_line WHERE service_type = 'yellow'"""
    ),
)
def q_silver_overall(spark, sf_dir):
    return questions.silver_overall(_yellow(spark, sf_dir))


@query(
    "q_silver_by_hour",
    over_sources(
        f"""SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hora_do_dia, count(*) AS qt_corridas,
                  {half_up('avg(passenger_count)', 2)} AS media_passageiros
           FROM valid_line WHERE service_type = 'yellow' AND month(pickup_datetime) = 5 GROUP BY 1"""
    ),
)
def q_silver_by_hour(spark, sf_dir):
    return questions.silver_by_hour(_yellow(spark, sf_dir), month=5)


@query("count_by_type", over_sources("SELECT service_type, count(*) AS trips FROM starred GROUP BY 1"))
def count_by_type(spark, sf_dir):
    fact = trips.fact(spark, sf_dir, "service_type_key")
    return marts.count_by_type(fact, trips.dimensions(spark, sf_dir))


# --- dashboard ------------------------------------------------------------------------------


AIRPORT_SQL = f"""SELECT description, airport_trip_count, {share('airport_trip_count')} AS airport_trip_pct
    FROM (SELECT description, count(*) AS airport_trip_count FROM starred WHERE is_airport_trip GROUP BY 1)"""


def _airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = trips.fact(spark, sf_dir, "service_type_key", "is_airport_trip")
    shares = dashboard.airport_share(fact, trips.dimensions(spark, sf_dir))
    return shares.withColumn("airport_trip_pct", F.expr("CAST(airport_trip_pct AS DOUBLE)"))


@query("airport_share", over_sources(AIRPORT_SQL))
def airport_share(spark, sf_dir):
    return _airport(spark, sf_dir)


@query("hourly_by_type", over_sources(HOURLY_SQL))
def hourly_by_type(spark, sf_dir):
    return _hourly(spark, sf_dir)


ZONE_SHARE_SQL = f"""SELECT zone, borough, trip_count, {share('trip_count')} AS trip_pct
    FROM (SELECT pickup_zone AS zone, pickup_borough AS borough, count(*) AS trip_count
          FROM starred GROUP BY 1, 2)"""


def _zone_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = trips.fact(spark, sf_dir, "pickup_zone_key")
    shares = dashboard.zone_share(fact, trips.dimensions(spark, sf_dir))
    return shares.withColumn("trip_pct", F.expr("CAST(trip_pct AS DOUBLE)"))


@query("zone_share", over_sources(ZONE_SHARE_SQL))
def zone_share(spark, sf_dir):
    return _zone_share(spark, sf_dir)


@query(
    "share_of_total",
    over_sources(
        f"""SELECT payment_type_name, trips, {share('trips')} AS pct
            FROM (SELECT payment_type_name, count(*) AS trips FROM starred GROUP BY 1)"""
    ),
)
def share_of_total(spark, sf_dir):
    fact = trips.fact(spark, sf_dir, "payment_type_key")
    paid = marts.star_rollup(fact, trips.dimensions(spark, sf_dir), (marts.PAYMENT,))
    return dashboard.with_share(paid, "trips", "pct").withColumn("pct", F.expr("CAST(pct AS DOUBLE)"))


@query(
    "widget_airport",
    over_sources(
        'SELECT description, sum(airport_trip_pct) AS "sum(airport_trip_pct)" FROM a GROUP BY 1',
        f"a AS ({AIRPORT_SQL})",
    ),
)
def widget_airport(spark, sf_dir):
    return dashboard.chart_total(_airport(spark, sf_dir), "description", "airport_trip_pct")


@query(
    "widget_hours",
    over_sources(
        'SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS "sum(trip_count)" FROM h GROUP BY 1',
        f"h AS ({HOURLY_SQL})",
    ),
)
def widget_hours(spark, sf_dir):
    return dashboard.chart_total(_hourly(spark, sf_dir), "pickup_hour", "trip_count")


@query(
    "widget_zones",
    over_sources(
        'SELECT zone, CAST(sum(trip_count) AS BIGINT) AS "sum(trip_count)" FROM z GROUP BY 1',
        f"z AS ({ZONE_SHARE_SQL})",
    ),
)
def widget_zones(spark, sf_dir):
    return dashboard.chart_total(_zone_share(spark, sf_dir), "zone", "trip_count")


@query(
    "metric_count_of_mart",
    over_sources("SELECT count(*) AS count FROM mart", f"mart AS ({REVENUE_MONTHLY})"),
)
def metric_count_of_mart(spark, sf_dir):
    return dashboard.metric_count(_revenue(spark, sf_dir))


@query(
    "metric_count_of_hours",
    over_sources(
        f"SELECT period_of_day, count(*) AS count FROM (SELECT service_type, year, month, hour, period_of_day FROM starred GROUP BY ALL) GROUP BY 1"
    ),
)
def metric_count_of_hours(spark, sf_dir):
    return dashboard.metric_count(trips_by_hour(spark, sf_dir), "period_of_day")


@query("metric_count_of_zones", over_sources("SELECT borough, count(*) AS count FROM dim_zone GROUP BY 1"))
def metric_count_of_zones(spark, sf_dir):
    return dashboard.metric_count(trips.dimensions(spark, sf_dir).zone.frame, "borough")


@query(
    "filter_zones",
    over_sources("SELECT * FROM z WHERE zone IN ('NATION_2', 'NATION_5', 'NATION_8')", f"z AS ({ZONE_SHARE_SQL})"),
)
def filter_zones(spark, sf_dir):
    return dashboard.select_values(_zone_share(spark, sf_dir), "zone", ["NATION_2", "NATION_5", "NATION_8"])


@query(
    "filters_combined",
    over_sources(
        """SELECT zone, count(*) FILTER (borough IN ('ASIA', 'AFRICA')) AS zone_associativity FROM z
           WHERE trip_count > 0 GROUP BY 1""",
        f"z AS ({ZONE_SHARE_SQL})",
    ),
)
def filters_combined(spark, sf_dir):
    """The zone filter's choices, with how many rows of each the borough filter lets through."""
    shares = _zone_share(spark, sf_dir)
    return dashboard.filter_options(shares, "zone", F.col("borough").isin("ASIA", "AFRICA"))


# --- dimensions, set operations, order ----------------------------------------------------------


@query(
    "zone_dimension_load",
    over_sources(
        """SELECT location_id, borough, zone, service_zone, count(c_custkey) AS customers
           FROM zone LEFT JOIN customer ON c_nationkey = location_id GROUP BY ALL"""
    ),
)
def zone_dimension_load(spark, sf_dir):
    loaded = zone_lookup(trips.zones_raw(spark, sf_dir))
    customers = trips.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.expr("count(c_custkey) AS n"))
    joined = loaded.frame.join(customers, F.expr("location_id = c_nationkey"), "left")
    return joined.selectExpr(*loaded.frame.columns, "COALESCE(n, 0) AS customers")


def _zone_usage_sql() -> str:
    return over_sources(
        """SELECT z.*, count(f.pickup_zone_key) AS trips
           FROM dim_zone z LEFT JOIN fact f ON f.pickup_zone_key = z.zone_key GROUP BY ALL"""
    )


@query("dim_zone", _zone_usage_sql())
def dim_zone(spark, sf_dir):
    dimension = trips.dimensions(spark, sf_dir).zone
    fact = trips.fact(spark, sf_dir, "pickup_zone_key").withColumnRenamed("pickup_zone_key", "zone_key")
    return dimension_usage(dimension, fact)


@query(
    "union_unknown_member",
    over_sources(
        """SELECT z.zone_key, z.zone, count(f.dropoff_zone_key) AS trips
           FROM dim_zone z LEFT JOIN fact f ON f.dropoff_zone_key = z.zone_key GROUP BY 1, 2"""
    ),
)
def union_unknown_member(spark, sf_dir):
    dimension = trips.dimensions(spark, sf_dir).zone
    fact = trips.fact(spark, sf_dir, "dropoff_zone_key").withColumnRenamed("dropoff_zone_key", "zone_key")
    return dimension_usage(dimension, fact).select("zone_key", "zone", "trips")


@query(
    "dim_time",
    over_sources(
        """SELECT CAST(h AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour,
                  CASE WHEN h BETWEEN 0 AND 5 THEN 'Madrugada' WHEN h BETWEEN 6 AND 11 THEN 'Manha'
                       WHEN h BETWEEN 12 AND 17 THEN 'Tarde' ELSE 'Noite' END AS period_of_day,
                  count(pickup_time_key) AS trips
           FROM range(24) AS t(h) LEFT JOIN fact ON pickup_time_key = h GROUP BY h"""
    ),
)
def dim_time(spark, sf_dir):
    dimension = trips.dimensions(spark, sf_dir).time
    fact = trips.fact(spark, sf_dir, "pickup_time_key").withColumnRenamed("pickup_time_key", "time_key")
    return dimension_usage(dimension, fact)


@query(
    "dim_date",
    over_sources(
        """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
                  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
                  CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
                  CAST(weekofyear(d) AS INTEGER) AS week_of_year,
                  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
                  dayofweek(d) IN (0, 6) AS is_weekend
           FROM (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY)) AS d
                 FROM (SELECT date_trunc('day', min(pickup_datetime)) AS low,
                              date_trunc('day', max(pickup_datetime)) AS high FROM trip))"""
    ),
)
def dim_date_rows(spark, sf_dir):
    tables = {t: trips.silver(spark, sf_dir, t, False) for t in trips.TYPES}
    return dim_date(tables).frame.withColumn("full_date", F.expr("CAST(full_date AS STRING)"))


@query(
    "dim_row_counts",
    over_sources(
        """SELECT 'dim_service_type' AS dim, 4 AS linhas UNION ALL SELECT 'dim_vendor', 3
           UNION ALL SELECT 'dim_rate_code', 7 UNION ALL SELECT 'dim_payment_type', 7
           UNION ALL SELECT 'dim_hvfhs_license', 5
           UNION ALL SELECT 'dim_zone', count(*) FROM dim_zone UNION ALL SELECT 'dim_time', 24
           UNION ALL SELECT 'dim_date', date_diff('day', min(pickup_datetime), max(pickup_datetime)) + 1
           FROM trip"""
    ),
)
def dim_row_counts_query(spark, sf_dir):
    tables = {t: trips.silver(spark, sf_dir, t, False) for t in trips.TYPES}
    return dim_row_counts(trips.dimensions(spark, sf_dir, dim_date(tables)))


@query(
    "minmax_bounds",
    over_sources(
        """SELECT strftime(min(d), '%Y-%m-%d') AS low, strftime(max(d), '%Y-%m-%d') AS high
           FROM (SELECT CAST(pickup_datetime AS DATE) AS d FROM trip)"""
    ),
)
def minmax_bounds(spark, sf_dir):
    tables = {t: trips.silver(spark, sf_dir, t, False) for t in trips.TYPES}
    bounds = date_bounds([(df, RECORD_TYPES[t].conform["pickup_datetime"]) for t, df in tables.items()])
    return bounds.selectExpr("CAST(low AS STRING) AS low", "CAST(high AS STRING) AS high")


@query(
    "union_distinct_dates",
    f"SELECT strftime(min(d), '%Y-%m-%d') AS low, strftime(max(d), '%Y-%m-%d') AS high FROM ({DAYS_OF_ALL})",
)
def union_distinct_dates(spark, sf_dir):
    return _all_bounds(spark, sf_dir).selectExpr("CAST(low AS STRING) AS low", "CAST(high AS STRING) AS high")


FILLED_COLUMNS = ("vendor_id", "passenger_count", "total_amount", "pickup_datetime", "dropoff_datetime")
FILLED_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS col, count({c}) AS filled FROM trip WHERE service_type = 'fhvhv'" for c in FILLED_COLUMNS
)


def _unfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns that hold no value for one record type."""
    rides = conform(trips.silver(spark, sf_dir, "fhvhv", False), RECORD_TYPES["fhvhv"])
    filled = value_counts_by_column(rides, *FILLED_COLUMNS).filter("filled > 0").select("col")
    required = inline_values(spark, ("col",), [(c,) for c in fv.CONTRACT_COLUMNS])
    return required.subtract(filled)


@query(
    "except_columns",
    over_sources("SELECT col FROM filled EXCEPT SELECT col FROM filled WHERE filled > 0", f"filled AS ({FILLED_SQL})"),
)
def except_columns(spark, sf_dir):
    return _unfilled(spark, sf_dir)


@query(
    "collect_sorted",
    over_sources(
        """SELECT count(*) AS n, string_agg(col, ', ' ORDER BY col) AS names
           FROM (SELECT col FROM filled EXCEPT SELECT col FROM filled WHERE filled > 0)""",
        f"filled AS ({FILLED_SQL})",
    ),
)
def collect_sorted(spark, sf_dir):
    return quality.sorted_list(_unfilled(spark, sf_dir), "col")


@query(
    "sort_array",
    over_sources(
        """SELECT count(*) AS n, string_agg(pickup_borough, ', ' ORDER BY pickup_borough) AS names
           FROM (SELECT DISTINCT pickup_borough FROM starred)"""
    ),
)
def sort_array(spark, sf_dir):
    """Boroughs with trips; there are only as many as the zone dimension has."""
    fact = trips.fact(spark, sf_dir, "pickup_zone_key")
    boroughs = marts.star_rollup(fact, trips.dimensions(spark, sf_dir), (marts.PICKUP_BOROUGH,))
    return quality.sorted_list(boroughs, "pickup_borough")


@query(
    "order_by",
    over_sources(
        """SELECT service_type, pickup_borough, pickup_zone, trips, airport_trips,
                  CAST(row_number() OVER (ORDER BY service_type, trips DESC, pickup_zone) AS INTEGER) AS position
           FROM mart""",
        f"mart AS ({ZONE_MART})",
    ),
)
def order_by(spark, sf_dir):
    mart = _zone_mart(spark, sf_dir).select(
        "service_type", "pickup_borough", "pickup_zone", "trips", "airport_trips"
    )
    ordered = mart.orderBy("service_type", F.desc("trips"), "pickup_zone")
    # numbers grow with the rows of a partition and with partitions, so they show the order
    numbered = ordered.withColumn("place", F.monotonically_increasing_id())
    return numbered.withColumn("position", F.row_number().over(Window.orderBy("place"))).drop("place")


@query(
    "limit",
    over_sources("SELECT * FROM mart ORDER BY trips DESC, service_type, pickup_zone LIMIT 20", f"mart AS ({ZONE_MART})"),
)
def limit(spark, sf_dir):
    ordered = _zone_mart(spark, sf_dir).orderBy(F.desc("trips"), "service_type", "pickup_zone")
    return preview(ordered)


@query(
    "fact_trips",
    over_sources("SELECT * EXCLUDE (service_type, pu_location_id, do_location_id) FROM fact"),
)
def fact_trips(spark, sf_dir):
    return trips.fact(spark, sf_dir)


from checks import growth  # noqa: E402, F401  (registers its queries here)
