"""Star schema, marts, cube, questions and dashboard on a small hand-made silver layer."""

import datetime as dt
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from waybill import fixed_values as fv
from waybill.operators import dashboard, marts, quality, questions
from waybill.operators.dimensions import dim_date, dim_row_counts, star_dimensions
from waybill.operators.fact import FACT_COLUMNS, build_fact, union_all_types


def at(text):
    return dt.datetime.fromisoformat(text) if text else None


def metered(prefix):
    return (
        "vendor_id bigint, ratecode_id double, payment_type double,"
        f" {prefix}_pickup_datetime timestamp, {prefix}_dropoff_datetime timestamp,"
        " pu_location_id int, do_location_id int, passenger_count double, trip_distance double,"
        " fare_amount double, tip_amount double, tolls_amount double, total_amount double,"
        " is_airport_trip boolean"
    )


@pytest.fixture(scope="module")
def silver(spark):
    yellow = [
        # 125 seconds are two whole minutes
        (1, 2.0, 1.0, at("2023-05-01 08:00:00"), at("2023-05-01 08:02:05"), 61, 57, 2.0, 3.5, 10.0, 2.0, 0.0, 12.0, True),
        # unknown zone, vendor and codes; 2.5 is cut to rate code 2
        (9, 2.5, 0.0, at("2023-05-02 23:59:59"), at("2023-05-03 00:10:00"), 999, 57, None, 1.0, 5.0, 0.0, 0.0, 5.0, False),
        (2, 99.0, None, at("2023-04-30 06:00:00"), None, None, None, 1.0, None, 7.0, 1.0, 0.0, None, False),
    ]
    green = [
        (2, 1.0, 2.0, at("2023-05-01 12:00:00"), at("2023-05-01 13:00:00"), 57, 61, 4.0, 8.0, 20.0, 0.0, 6.0, 26.0, True)
    ]
    fhv = [("B1", at("2023-05-01 18:30:00"), at("2023-05-01 18:31:59"), 57, None)]
    fhvhv = [
        ("HV0003", at("2023-05-01 08:15:00"), at("2023-05-01 08:00:00"), 57, 57, 2.0, 10.0, None, 0.5, 1.0, 2.75, None, 3.0),
        ("HV9999", at("2023-06-30 00:00:00"), at("2023-06-30 01:00:00"), 61, 57, 1.0, None, None, None, None, None, None, None),
    ]
    return {
        "yellow": spark.createDataFrame(yellow, metered("tpep")),
        "green": spark.createDataFrame(green, metered("lpep")),
        "fhv": spark.createDataFrame(
            fhv,
            "dispatching_base_num string, pickup_datetime timestamp, drop_off_datetime timestamp,"
            " pu_location_id int, do_location_id int",
        ),
        "fhvhv": spark.createDataFrame(
            fhvhv,
            "hvfhs_license_num string, pickup_datetime timestamp, dropoff_datetime timestamp,"
            " pu_location_id int, do_location_id int, trip_miles double, base_passenger_fare double,"
            " tolls double, bcf double, sales_tax double, congestion_surcharge double,"
            " airport_fee double, tips double",
        ),
    }


@pytest.fixture(scope="module")
def dims(spark, silver):
    zones = spark.createDataFrame(
        [(61, "Northside", "North Field", "Airports"), (57, "Midtown", "Mill Lane", "Yellow Zone")],
        ["LocationID", "Borough", "Zone", "service_zone"],
    )
    return star_dimensions(spark, zones, dim_date(silver))


@pytest.fixture(scope="module")
def fact(silver, dims):
    return build_fact(union_all_types(silver), dims).cache()


def test_fact_schema(fact):
    assert tuple(fact.columns) == FACT_COLUMNS
    types = dict(fact.dtypes)
    assert {types[c] for c in FACT_COLUMNS if c.endswith("_key")} == {"int"}
    assert types["trip_sk"] == types["vendor_id"] == "bigint"
    assert types["pickup_datetime"] == types["dropoff_datetime"] == "timestamp"
    assert types["trip_duration_min"] == types["passenger_count"] == "int"
    assert types["total_amount"] == "double" and types["is_airport_trip"] == "boolean"


def test_fact_keys(fact):
    got = rows(
        fact,
        "service_type_key",
        "pickup_zone_key",
        "dropoff_zone_key",
        "vendor_key",
        "rate_code_key",
        "payment_type_key",
        "hvfhs_license_key",
    )
    assert got == sorted(
        [
            (1, 61, 57, 1, 2, 1, 0),
            (1, -1, 57, 0, 2, 0, 0),
            (1, -1, -1, 2, 0, 0, 0),
            (2, 57, 61, 2, 1, 2, 0),
            (3, 57, -1, 0, 0, 0, 0),
            (4, 57, 57, 0, 0, 0, 2),
            (4, 61, 57, 0, 0, 0, 0),
        ],
        key=lambda r: tuple(str(v) for v in r),
    )
    assert fact.select("trip_sk").distinct().count() == 7
    assert rows(fact.filter("vendor_key = 0 AND vendor_id IS NOT NULL"), "vendor_id") == [(9,)]


def test_fact_times(fact):
    got = {
        (r.pickup_date_key, r.pickup_time_key): (r.dropoff_date_key, r.trip_duration_min)
        for r in fact.collect()
    }
    assert got[(20230501, 8)] in [(20230501, 2), (20230501, -15)]
    assert got[(20230502, 23)] == (20230503, 10)
    assert got[(20230430, 6)] == (None, None)
    assert got[(20230501, 18)] == (20230501, 1)
    # minus 15 minutes and minus 90 seconds go toward zero
    durations = sorted(r.trip_duration_min for r in fact.filter("service_type_key = 4").collect())
    assert durations == [-15, 60]


def test_components_and_missing_measures(fact):
    got = rows(fact.filter("service_type_key = 4"), "fare_amount", "tip_amount", "total_amount")
    assert got == [(10.0, 3.0, 17.25), (None, None, 0.0)]
    (dispatched,) = fact.filter("service_type_key = 3").collect()
    assert dispatched.total_amount is None and dispatched.is_airport_trip is None


def test_stable_keys_do_not_depend_on_partitioning(silver, dims):
    unified = union_all_types(silver)
    columns = ("trip_sk", "pickup_datetime")
    once = build_fact(unified, dims, columns, stable_keys=True)
    again = build_fact(unified.repartition(3), dims, columns, stable_keys=True)
    assert rows(once) == rows(again)
    assert once.select("trip_sk").distinct().count() == 7


def test_only_needed_lookups(silver, dims, plan_of):
    plan = plan_of(build_fact(union_all_types(silver), dims, ("service_type_key", "vendor_key")))
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_unknown_service_type_is_dropped(silver, dims):
    unified = union_all_types(silver)
    odd = unified.withColumn("service_type", F.lit("boat"))
    assert build_fact(unified.union(odd), dims).count() == 7


def test_dimensions(dims):
    for name, dimension in dims.named().items():
        keys = [r[0] for r in dimension.frame.select(dimension.key).collect()]
        assert len(keys) == len(set(keys)), name
        if dimension.rows is not None:
            assert dimension.rows == len(keys), name
    assert rows(dims.zone.frame)[0] == fv.UNKNOWN_ZONE_ROW
    periods = dict(rows(dims.time.frame, "hour", "period_of_day"))
    assert [periods[h] for h in (0, 5, 6, 11, 12, 17, 18, 23)] == [
        "Madrugada", "Madrugada", "Manha", "Manha", "Tarde", "Tarde", "Noite", "Noite",
    ]
    assert dict(rows(dim_row_counts(dims))) == {
        "dim_service_type": 4,
        "dim_vendor": 3,
        "dim_rate_code": 7,
        "dim_payment_type": 7,
        "dim_hvfhs_license": 5,
        "dim_zone": 3,
        "dim_time": 24,
        "dim_date": 62,
    }


def test_calendar(dims):
    days = {r.date_key: r for r in dims.date.frame.collect()}
    assert (min(days), max(days)) == (20230430, 20230630)
    sunday, monday = days[20230430], days[20230501]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (1, "Sunday", True)
    assert (monday.day_of_week, monday.week_of_year, monday.is_weekend) == (2, 18, False)
    assert (monday.year, monday.month, monday.day, monday.quarter) == (2023, 5, 1, 2)
    assert monday.full_date == dt.date(2023, 5, 1)


def without_calendar(dims):
    return type(dims)(**{**vars(dims), "date": None})


def test_revenue(fact, dims):
    got = {r[:3]: r[3:] for r in rows(marts.agg_revenue_monthly(fact, dims))}
    assert got[("yellow", 2023, 5)] == (2, 8.5, 17.0, 2.25, 6.0, 1.0)
    assert got[("yellow", 2023, 4)] == (1, None, None, None, None, 1.0)
    assert got[("fhv", 2023, 5)] == (1, None, None, None, 1.0, None)
    assert got[("fhvhv", 2023, 6)] == (1, 0.0, 0.0, 1.0, 60.0, None)
    assert len(got) == 6
    derived = marts.agg_revenue_monthly(fact, without_calendar(dims))
    assert {r[:3]: r[3:] for r in rows(derived)} == got


def test_no_pickup_date_no_mart_row(fact, dims):
    undated = fact.withColumn("pickup_date_key", F.lit(None).cast("int"))
    for d in (dims, without_calendar(dims)):
        assert marts.agg_revenue_monthly(undated, d).count() == 0


def test_by_hour_and_zone(fact, dims):
    by_hour = rows(marts.agg_trips_by_hour(fact, dims))
    assert ("yellow", 2023, 5, 8, "Manha", 1, 2.0, 12.0) in by_hour and len(by_hour) == 7
    by_zone = rows(marts.agg_trips_by_zone(fact, dims))
    assert ("yellow", "Northside", "North Field", 1, 12.0, 3.5, 1) in by_zone
    assert ("yellow", "Unknown", "Unknown", 2, 5.0, 1.0, 0) in by_zone
    assert ("fhv", "Midtown", "Mill Lane", 1, None, None, None) in by_zone


def _brute_force_cube(fact, dims):
    zone = {r.zone_key: r.borough for r in dims.zone.frame.collect()}
    payment = {r.payment_type_key: r.payment_type_name for r in dims.payment_type.frame.collect()}
    service = {r.service_type_key: r.service_type for r in dims.service_type.frame.collect()}
    groups = defaultdict(list)
    for r in fact.collect():
        labels = (
            service[r.service_type_key],
            r.pickup_date_key // 10000,
            r.pickup_date_key // 100 % 100,
            r.pickup_time_key,
            zone.get(r.pickup_zone_key),
            payment.get(r.payment_type_key),
        )
        for rolled_up in product((False, True), repeat=6):
            grouping_id = int("".join("1" if up else "0" for up in rolled_up), 2)
            key = tuple(None if up else label for up, label in zip(rolled_up, labels))
            groups[key + (grouping_id,)].append(r)

    def mean(values):
        known = [v for v in values if v is not None]
        return sum(known) / len(known) if known else None

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    return {
        key: (
            len(members),
            mean(r.total_amount for r in members),
            total(r.total_amount for r in members),
            mean(r.passenger_count for r in members),
            mean(r.trip_distance for r in members),
            mean(r.trip_duration_min for r in members),
            mean(r.tip_amount for r in members),
        )
        for key, members in groups.items()
    }


def test_cube_against_brute_force(fact, dims):
    # a payment key the dimension lacks: a NULL label that is not a roll-up
    odd = fact.withColumn(
        "payment_type_key", F.expr("CASE WHEN vendor_id = 9 THEN 77 ELSE payment_type_key END")
    )
    cube = marts.cube_trips(odd, dims).collect()
    expected = _brute_force_cube(odd, dims)
    got = {tuple(r[:7]): tuple(r[7:]) for r in cube}
    assert len(cube) == len(got) and got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values, nan_ok=True), key
    assert {r.grouping_id for r in cube} == set(range(64))
    grand = next(r for r in cube if r.grouping_id == 63)
    assert grand.trips == sum(r.trips for r in cube if r.grouping_id == 0) == 7


def test_questions(fact, dims):
    revenue = marts.agg_revenue_monthly(fact, dims)
    assert [tuple(r) for r in questions.monthly_average(revenue).collect()] == [
        (2023, 4, 1, None, None),
        (2023, 5, 2, 8.5, 17.0),
    ]
    assert rows(questions.average_of_months(revenue)) == [(17.0, 8.5)]
    assert rows(questions.average_of_months(revenue, "fhvhv")) == [(8.63, 8.63)]
    expected = [(8, "Manha", 2.0, 1), (12, "Tarde", 4.0, 1), (18, "Noite", None, 0), (23, "Noite", None, 0)]
    for d in (dims, without_calendar(dims)):
        assert [tuple(r) for r in questions.passengers_by_hour(fact, d).collect()] == expected


def test_silver_questions(silver):
    yellow = silver["yellow"].withColumns(
        {
            "pickup_year": F.year("tpep_pickup_datetime"),
            "pickup_month": F.month("tpep_pickup_datetime"),
        }
    )
    assert [tuple(r) for r in questions.silver_monthly(yellow).collect()] == [
        (2023, 4, 1, None, None),
        (2023, 5, 2, 8.5, 17.0),
    ]
    assert rows(questions.silver_overall(yellow)) == [(8.5,)]
    assert [tuple(r) for r in questions.silver_by_hour(yellow).collect()] == [(8, 1, 2.0), (23, 1, None)]


def test_dashboard(fact, dims):
    airport = [tuple(r) for r in dashboard.airport_share(fact, dims).collect()]
    assert sorted((d, n, float(p)) for d, n, p in airport) == [
        ("Green Taxi", 1, 50.0),
        ("Yellow Taxi", 1, 50.0),
    ]
    zones = dashboard.zone_share(fact, dims)
    assert sorted((z, n, float(p)) for z, _, n, p in zones.collect()) == [
        ("Mill Lane", 3, 42.86),
        ("North Field", 2, 28.57),
        ("Unknown", 2, 28.57),
    ]
    hourly = dashboard.hourly_by_type(fact, dims)
    assert [r.service_type for r in hourly.collect()] == sorted(r.service_type for r in hourly.collect())
    assert dict(rows(dashboard.chart_total(hourly, "pickup_hour", "trip_count")))[8] == 2
    assert dict(rows(dashboard.filter_options(hourly, "service_type", F.expr("pickup_hour < 12"))))["Yellow Taxi"] == 2
    assert dashboard.select_values(hourly, "service_type", ["Green Taxi"]).count() == 1
    assert dashboard.select_values(hourly, "service_type", None).count() == hourly.count()
    assert rows(dashboard.metric_count(fact)) == [(7,)]
    assert dict(rows(dashboard.metric_count(fact, "service_type_key")))[1] == 3
    assert dict(rows(marts.count_by_type(fact, dims))) == {"yellow": 3, "fhvhv": 2, "green": 1, "fhv": 1}


def test_contract(fact):
    assert rows(quality.column_contract(fact)) == [(fv.CONTRACT_OK,)]
    upper = fact.withColumnRenamed("vendor_id", "VENDOR_ID")
    assert rows(quality.column_contract(upper)) == [(fv.CONTRACT_OK,)]
    broken = quality.column_contract(fact.drop("vendor_id", "total_amount", "pickup_datetime"))
    with pytest.raises(Exception, match="fact_trips -> pickup_datetime, total_amount, vendor_id"):
        broken.collect()
