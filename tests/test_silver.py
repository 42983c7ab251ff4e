import datetime as dt

import pytest

from tests.conftest import rows
from waybill.operators.lookup import Dimension
from waybill.operators.silver import filter_valid_dates, standardize_silver
from waybill.operators.zones import enrich_with_zones, zone_lookup

METERED = (
    "VendorID bigint, passenger_count double, total_amount double,"
    " tpep_pickup_datetime string, tpep_dropoff_datetime string,"
    " PULocationID bigint, DOLocationID bigint"
)


def metered(spark, *trips):
    """Trips as (pickup, dropoff, pickup zone, dropoff zone)."""
    data = [(1, 2.0, 10.0, up, off, pu, do) for up, off, pu, do in trips]
    return spark.createDataFrame(data, METERED)


@pytest.fixture
def zones(spark):
    data = [
        (61, "Northside", "North Field", "Airports"),
        (57, "Midtown", "Mill Lane", "Yellow Zone"),
        (1, "EWR", "Newark Airport", "EWR"),
    ]
    return spark.createDataFrame(data, ["LocationID", "Borough", "Zone", "service_zone"])


NOON, LATER = "2023-05-20 12:00:00", "2023-05-20 12:30:00"


def test_names_and_types(spark):
    out = standardize_silver(metered(spark, (NOON, LATER, 1, 2)))
    assert dict(out.dtypes) == {
        "vendor_id": "bigint",
        "passenger_count": "double",
        "total_amount": "double",
        "tpep_pickup_datetime": "timestamp",
        "tpep_dropoff_datetime": "timestamp",
        "pu_location_id": "int",
        "do_location_id": "int",
        "pickup_year": "int",
        "pickup_month": "int",
    }
    (row,) = out.collect()
    assert row.tpep_pickup_datetime == dt.datetime(2023, 5, 20, 12)
    assert (row.pickup_year, row.pickup_month) == (2023, 5)


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame(
        [("soon", "later", "N/A", "7")],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID string, DOLocationID string",
    )
    (row,) = standardize_silver(df).collect()
    assert row.tpep_pickup_datetime is None and row.tpep_dropoff_datetime is None
    assert (row.pu_location_id, row.do_location_id) == (None, 7)


DATED = [
    ("2023-01-01 00:00:00", "2023-01-01 00:10:00", True),  # first moment
    ("2023-05-31 23:59:59", "2023-06-01 00:20:00", True),
    ("2023-06-01 00:00:00", "2023-06-01 00:10:00", False),  # end is exclusive
    ("2022-12-31 23:59:59", "2023-01-01 00:10:00", False),
    ("2140-01-01 10:00:00", "2140-01-01 10:30:00", False),
    ("1987-05-01 10:00:00", "1987-05-01 10:30:00", False),
    ("2023-03-01 10:00:00", "2023-03-01 09:59:59", False),  # arrives before it starts
    ("2023-03-01 10:00:00", "2023-03-01 10:00:00", True),
    ("2023-03-01 10:00:00", None, True),
    (None, "2023-03-01 10:00:00", False),
]


def test_valid_dates(spark):
    df = metered(spark, *[(up, off, 1, 2) for up, off, _ in DATED])
    assert standardize_silver(df).count() == len(DATED)
    assert standardize_silver(df, valid_start="2023-01-01").count() == len(DATED)
    kept = standardize_silver(df, valid_start="2023-01-01", valid_end="2023-06-01")
    assert kept.count() == sum(valid for *_, valid in DATED)
    assert filter_valid_dates(df, "2023-01-01", "2023-06-01").count() == kept.count()


def test_without_a_pickup_column_nothing_is_dropped(spark):
    df = spark.range(3)
    assert filter_valid_dates(df, "2023-01-01", "2023-06-01").count() == 3
    assert standardize_silver(df, valid_start="2023-01-01", valid_end="2023-06-01").columns == ["id"]


@pytest.mark.parametrize(
    "pickup, dropoff, boroughs, airport",
    [
        (61, 57, ("Northside", "Midtown"), True),
        (57, 61, ("Midtown", "Northside"), True),
        (57, 57, ("Midtown", "Midtown"), False),
        (999, 57, (None, "Midtown"), False),
        (None, None, (None, None), False),
        (1, 57, ("EWR", "Midtown"), False),  # Newark has a service zone of its own
    ],
)
def test_zones(spark, zones, pickup, dropoff, boroughs, airport):
    df = metered(spark, (NOON, LATER, pickup, dropoff))
    (row,) = standardize_silver(df, zone_df=zones).collect()
    assert (row.pickup_borough, row.dropoff_borough) == boroughs
    assert row.is_airport_trip is airport


def test_zones_keep_the_column_order(spark, zones):
    df = spark.createDataFrame([(1, 61, "x")], "a int, pu_location_id int, b string")
    assert enrich_with_zones(df, zones).columns == [
        "a",
        "pu_location_id",
        "b",
        "pickup_borough",
        "pickup_zone",
        "pickup_service_zone",
        "is_airport_trip",
    ]
    assert enrich_with_zones(spark.range(1), zones).columns == ["id"]


def test_repeated_zone_ids_are_refused(spark, zones):
    with pytest.raises(ValueError, match="location_id"):
        zone_lookup(zones.union(zones))


def test_small_zones_are_broadcast_and_large_or_uncounted_ones_are_not(spark, zones, plan_of):
    df = spark.createDataFrame([(61,)], "pu_location_id int")
    counted = zone_lookup(zones)
    assert counted.rows == 3
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(enrich_with_zones(df, counted))
        for rows_known in (None, 10**8):
            big = Dimension(counted.frame, counted.key, rows_known)
            enriched = enrich_with_zones(df, big)
            assert "SortMergeJoin" in plan_of(enriched)
            assert rows(enriched, "pickup_borough") == [("Northside",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_green_labels_and_flag(spark):
    df = spark.createDataFrame(
        [
            (2, 2.0, 1.0, "Y"),
            (9, 2.5, 0.0, " n "),
            (None, 99.0, None, "?"),
        ],
        "VendorID bigint, RatecodeID double, payment_type double, store_and_fwd_flag string",
    )
    out = standardize_silver(df, taxi_type="green")
    columns = ("vendor_name", "ratecode_name", "payment_type_name", "store_and_fwd_flag")
    assert rows(out, *columns) == rows(
        spark.createDataFrame(
            [
                ("VeriFone Inc.", "JFK", "Cartao de credito", True),
                (None, None, None, False),
                (None, None, None, None),
            ],
            "a string, b string, c string, d boolean",
        )
    )
    assert {"vendor_id", "ratecode_id", "payment_type"} <= set(out.columns)


def test_codes_as_text(spark):
    df = spark.createDataFrame([("1",), ("x",)], "VendorID string")
    out = standardize_silver(df, taxi_type="yellow")
    assert rows(out) == [("1", "Creative Mobile Technologies"), ("x", None)]


def test_high_volume_license_and_flag(spark):
    df = spark.createDataFrame(
        [("HV0003", "N"), ("HV0005", "y"), ("HV9999", None)],
        "hvfhs_license_num string, shared_request_flag string",
    )
    out = standardize_silver(df, taxi_type="fhvhv")
    assert rows(out) == [
        ("HV0003", False, "Uber"),
        ("HV0005", True, "Lyft"),
        ("HV9999", None, None),
    ]


def test_dispatched_trips_get_no_labels(spark):
    df = spark.createDataFrame(
        [("B1", NOON, LATER, 61.0, None, 1)],
        "dispatching_base_num string, pickup_datetime string, dropOff_datetime string,"
        " PUlocationID double, DOlocationID double, SR_Flag bigint",
    )
    out = standardize_silver(df, taxi_type="fhv")
    assert dict(out.dtypes) == {
        "dispatching_base_num": "string",
        "pickup_datetime": "timestamp",
        "drop_off_datetime": "timestamp",
        "pu_location_id": "int",
        "do_location_id": "int",
        "sr_flag": "bigint",
        "pickup_year": "int",
        "pickup_month": "int",
    }
    (row,) = out.collect()
    assert (row.pu_location_id, row.do_location_id) == (61, None)
