"""The SQL side: stand-in trips, zones and the fact as common table expressions.

Written for the comparison engine and independent of the Spark code: one select for all
order lines, literal code lists, no reuse of names computed by the library.
"""

from __future__ import annotations

SOURCES = """
zone AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
         CASE r_name WHEN 'ASIA' THEN 'Airports' WHEN 'AMERICA' THEN 'Yellow Zone'
                     WHEN 'EUROPE' THEN 'EWR' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
ordered AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, c_nationkey,
         o_orderdate + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS ordered_at
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
),
line AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'green' ELSE 'yellow' END AS service_type,
         CAST(l_linenumber AS BIGINT) AS vendor_id,
         ordered_at AS pickup_datetime, l_shipdate AS dropoff_datetime,
         l_quantity AS passenger_count, l_quantity * 0.25::DOUBLE AS trip_distance,
         l_tax * 100::DOUBLE AS ratecode_id,
         CASE l_linestatus WHEN 'O' THEN 'Y' WHEN 'F' THEN 'N' END AS store_and_fwd_flag,
         CAST(c_nationkey AS BIGINT) AS pu_location_id,
         CAST(s_nationkey AS BIGINT) AS do_location_id,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS payment_type,
         l_extendedprice AS fare_amount,
         l_extendedprice * l_discount AS tip_amount,
         l_extendedprice * l_tax AS tolls_amount,
         l_extendedprice + l_extendedprice * l_discount + l_extendedprice * l_tax AS total_amount
  FROM lineitem JOIN ordered ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
),
order_period AS (
  SELECT date_trunc('day', min(ordered_at)) AS low, date_trunc('month', max(ordered_at)) + INTERVAL 1 MONTH AS high
  FROM ordered
),
event_period AS (
  SELECT date_trunc('day', min(ts)) AS low, date_trunc('month', max(ts)) + INTERVAL 1 MONTH AS high FROM events
),
valid_line AS (
  SELECT line.* FROM line, order_period
  WHERE pickup_datetime >= low AND pickup_datetime < high
    AND (dropoff_datetime IS NULL OR dropoff_datetime >= pickup_datetime)
),
dispatch AS (
  SELECT 'B' || o_orderstatus AS dispatching_base_num, ordered_at AS pickup_datetime,
         CAST(NULL AS TIMESTAMP) AS drop_off_datetime,
         CAST(c_nationkey AS DOUBLE) AS pu_location_id, CAST(NULL AS DOUBLE) AS do_location_id,
         CASE WHEN o_orderstatus = 'P' THEN 1 END AS sr_flag,
         o_orderpriority AS affiliated_base_number
  FROM ordered
),
valid_dispatch AS (
  SELECT dispatch.* FROM dispatch, order_period
  WHERE pickup_datetime >= low AND pickup_datetime < high
),
ride AS (
  SELECT CASE event_type WHEN 'click' THEN 'HV0002' WHEN 'view' THEN 'HV0003'
                         WHEN 'purchase' THEN 'HV0004' WHEN 'signup' THEN 'HV0005'
                         ELSE 'HV0009' END AS hvfhs_license_num,
         event_type AS dispatching_base_num,
         ts AS pickup_datetime,
         CASE WHEN event_type <> 'signup'
              THEN ts + to_seconds(CAST(floor(value * 10) AS INTEGER)) END AS dropoff_datetime,
         CAST(c_nationkey AS BIGINT) AS pu_location_id,
         CAST(c_nationkey + 3 AS BIGINT) AS do_location_id,
         value AS trip_miles, value AS base_passenger_fare,
         CASE WHEN event_type = 'purchase' THEN 6.55::DOUBLE END AS tolls,
         value * 0.03::DOUBLE AS bcf, value * 0.08875::DOUBLE AS sales_tax,
         2.75::DOUBLE AS congestion_surcharge,
         CASE WHEN event_type = 'view' THEN 2.5::DOUBLE END AS airport_fee,
         CASE WHEN event_type <> 'error' THEN value * 0.2::DOUBLE END AS tips,
         CASE event_type WHEN 'view' THEN ' y' WHEN 'click' THEN 'N' END AS shared_request_flag
  FROM events LEFT JOIN customer ON user_id = c_custkey
),
valid_ride AS (
  SELECT ride.* FROM ride, event_period
  WHERE pickup_datetime >= low AND pickup_datetime < high
    AND (dropoff_datetime IS NULL OR dropoff_datetime >= pickup_datetime)
),
trip AS (
  SELECT service_type, vendor_id, ratecode_id, payment_type,
         CAST(NULL AS VARCHAR) AS hvfhs_license_num, pickup_datetime, dropoff_datetime,
         pu_location_id, do_location_id,
         CAST(trunc(passenger_count) AS INTEGER) AS passenger_count, trip_distance,
         fare_amount, tip_amount, tolls_amount, total_amount
  FROM valid_line
  UNION ALL
  SELECT 'fhv', NULL, NULL, NULL, NULL, pickup_datetime, drop_off_datetime,
         pu_location_id, do_location_id, NULL, NULL, NULL, NULL, NULL, NULL
  FROM valid_dispatch
  UNION ALL
  SELECT 'fhvhv', NULL, NULL, NULL, hvfhs_license_num, pickup_datetime, dropoff_datetime,
         pu_location_id, do_location_id, NULL, trip_miles, base_passenger_fare, tips, tolls,
         coalesce(base_passenger_fare, 0) + coalesce(tolls, 0) + coalesce(bcf, 0)
           + coalesce(sales_tax, 0) + coalesce(congestion_surcharge, 0)
           + coalesce(airport_fee, 0) + coalesce(tips, 0)
  FROM valid_ride
),
conformed AS (
  SELECT service_type, vendor_id, ratecode_id, payment_type, hvfhs_license_num,
         pickup_datetime, dropoff_datetime,
         CAST(pu_location_id AS INTEGER) AS pu_location_id,
         CAST(do_location_id AS INTEGER) AS do_location_id,
         passenger_count, trip_distance, fare_amount, tip_amount, tolls_amount, total_amount,
         coalesce(p.service_zone = 'Airports', false)
           OR coalesce(d.service_zone = 'Airports', false) AS is_airport_trip,
         p.location_id AS found_pu, d.location_id AS found_do
  FROM trip
  LEFT JOIN zone p ON pu_location_id = p.location_id
  LEFT JOIN zone d ON do_location_id = d.location_id
),
fact AS (
  SELECT CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS pickup_date_key,
         CAST(hour(pickup_datetime) AS INTEGER) AS pickup_time_key,
         CAST(strftime(dropoff_datetime, '%Y%m%d') AS INTEGER) AS dropoff_date_key,
         CAST(coalesce(found_pu, -1) AS INTEGER) AS pickup_zone_key,
         CAST(coalesce(found_do, -1) AS INTEGER) AS dropoff_zone_key,
         CAST(CASE WHEN vendor_id IN (1, 2) THEN vendor_id ELSE 0 END AS INTEGER) AS vendor_key,
         CAST(CASE WHEN trunc(ratecode_id) BETWEEN 1 AND 6 THEN trunc(ratecode_id) ELSE 0 END
              AS INTEGER) AS rate_code_key,
         CAST(CASE WHEN trunc(payment_type) BETWEEN 1 AND 6 THEN trunc(payment_type) ELSE 0 END
              AS INTEGER) AS payment_type_key,
         CASE hvfhs_license_num WHEN 'HV0002' THEN 1 WHEN 'HV0003' THEN 2
              WHEN 'HV0004' THEN 3 WHEN 'HV0005' THEN 4 ELSE 0 END AS hvfhs_license_key,
         CASE service_type WHEN 'yellow' THEN 1 WHEN 'green' THEN 2
              WHEN 'fhv' THEN 3 ELSE 4 END AS service_type_key,
         vendor_id, pickup_datetime, dropoff_datetime, trip_distance,
         CAST(trunc((floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60)
              AS INTEGER) AS trip_duration_min,
         passenger_count, fare_amount, tip_amount, tolls_amount, total_amount, is_airport_trip,
         service_type, pu_location_id, do_location_id
  FROM conformed
),
dim_zone AS (
  SELECT -1 AS zone_key, -1 AS location_id, 'Unknown' AS borough, 'Unknown' AS zone,
         'Unknown' AS service_zone
  UNION ALL SELECT location_id, * FROM zone
),
starred AS (
  SELECT f.*, z.borough AS pickup_borough, z.zone AS pickup_zone,
         CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month, pickup_time_key AS hour,
         CASE WHEN pickup_time_key < 6 THEN 'Madrugada' WHEN pickup_time_key < 12 THEN 'Manha'
              WHEN pickup_time_key < 18 THEN 'Tarde' ELSE 'Noite' END AS period_of_day,
         CASE payment_type_key WHEN 0 THEN 'Nao informado' WHEN 1 THEN 'Cartao de credito'
              WHEN 2 THEN 'Dinheiro' WHEN 3 THEN 'Sem cobranca' WHEN 4 THEN 'Disputa'
              WHEN 5 THEN 'Desconhecido' ELSE 'Corrida anulada' END AS payment_type_name,
         CASE service_type_key WHEN 1 THEN 'Yellow Taxi' WHEN 2 THEN 'Green Taxi'
              WHEN 3 THEN 'For-Hire Vehicle' ELSE 'High-Volume For-Hire Vehicle' END AS description
  FROM fact f JOIN dim_zone z ON pickup_zone_key = zone_key
)
"""


def over_sources(select: str, more: str = "") -> str:
    return f"WITH {SOURCES.strip()}{', ' + more if more else ''}\n{select}"


def exact_sum(column: str) -> str:
    """A sum of doubles by their decimal digits, whatever the order. Text stands between double
    and decimal because this engine's direct casts scale by a power of ten first."""
    exact = f"sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL(28, 10)))"
    return f"CAST(CAST({exact} AS VARCHAR) AS DOUBLE)"


def exact_avg(column: str) -> str:
    return f"({exact_sum(column)}) / CAST(nullif(count({column}), 0) AS DOUBLE)"


def whole_avg(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / CAST(nullif(count({column}), 0) AS DOUBLE)"


def half_up(value: str, digits: int) -> str:
    """A double rounded half up by its decimal digits, as Spark rounds. The other engine's
    own rounding of doubles scales by a power of ten first, which moves ties."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 14)), {digits}) AS DOUBLE)"


def share(count: str) -> str:
    """Percentage rounded half up to two decimals, in integers."""
    whole = f"sum({count}) OVER ()"
    return f"CAST((20000 * {count} + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


REVENUE_MONTHLY = f"""
SELECT service_type, year, month, count(*) AS trips,
       {exact_avg('total_amount')} AS avg_total_amount,
       {exact_sum('total_amount')} AS sum_total_amount,
       {exact_avg('trip_distance')} AS avg_trip_distance,
       {whole_avg('trip_duration_min')} AS avg_trip_duration_min,
       {exact_avg('tip_amount')} AS avg_tip_amount
FROM starred GROUP BY service_type, year, month"""

CUBE_MEASURES = f"""count(*) AS trips,
       {exact_avg('total_amount')} AS avg_total_amount,
       {exact_sum('total_amount')} AS sum_total_amount,
       {whole_avg('passenger_count')} AS avg_passenger_count,
       {exact_avg('trip_distance')} AS avg_trip_distance,
       {whole_avg('trip_duration_min')} AS avg_trip_duration_min,
       {exact_avg('tip_amount')} AS avg_tip_amount"""
