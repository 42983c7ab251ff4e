"""Names, months and descriptions: driver-side helpers."""

import pytest

from waybill import fixed_values as fv
from waybill.functions.dates import month_list, valid_window
from waybill.functions.names import (
    comments_for,
    detect_dropoff_col,
    detect_pickup_col,
    silver_comments_for,
    to_snake_case,
)
from waybill.operators.sinks import comment_statements


@pytest.mark.parametrize(
    "published, standard",
    [
        ("VendorID", "vendor_id"),
        ("RatecodeID", "ratecode_id"),
        ("PULocationID", "pu_location_id"),
        ("DOLocationID", "do_location_id"),
        ("PUlocationID", "pu_location_id"),
        ("DOlocationID", "do_location_id"),
        ("dropOff_datetime", "drop_off_datetime"),
        ("SR_Flag", "sr_flag"),
        ("Affiliated_base_number", "affiliated_base_number"),
        ("Airport_fee", "airport_fee"),
        ("tpep_pickup_datetime", "tpep_pickup_datetime"),
        ("HTMLPage2Text", "html_page2_text"),
        ("__Odd__Name_", "odd_name"),
        ("ABcDEf", "a_bc_d_ef"),
    ],
)
def test_snake_case(published, standard):
    assert to_snake_case(published) == standard


@pytest.mark.parametrize(
    "start, stop, months",
    [
        ("2023-01-01", "2023-03-01", ["2023-01", "2023-02", "2023-03"]),
        ("2023-03-05", "2023-03-28", ["2023-03"]),
        ("2022-12-31", "2023-01-01", ["2022-12", "2023-01"]),
        ("2023-05-01", "2023-04-30", []),
    ],
)
def test_months(start, stop, months):
    assert month_list(start, stop) == months


def test_window_ends_after_the_last_month():
    assert valid_window("2023-01-01", "2023-05-01") == ("2023-01-01", "2023-06-01")
    assert valid_window("2022-07-15", "2022-12-31") == ("2022-07-15", "2023-01-01")


def test_first_present_time_column():
    assert detect_pickup_col(["pickup_datetime", "tpep_pickup_datetime"]) == "tpep_pickup_datetime"
    assert detect_pickup_col(["x", "lpep_pickup_datetime"]) == "lpep_pickup_datetime"
    assert detect_pickup_col(["PICKUP_DATETIME"]) is None
    assert detect_pickup_col(["when"], ["when"]) == "when"
    assert detect_dropoff_col(["drop_off_datetime"]) == "drop_off_datetime"


def test_descriptions_by_layer():
    assert list(comments_for("fhv"))[:2] == ["dispatching_base_num", "pickup_datetime"]
    assert comments_for("none") == {}
    described = silver_comments_for("green")
    assert described["vendor_id"] == fv.GREEN_COMMENTS["VendorID"]
    assert described["store_and_fwd_flag"] == fv.SILVER_FLAG_COMMENTS["store_and_fwd_flag"]
    assert "pickup_borough" in described and "vendor_name" in described
    assert silver_comments_for("none").keys() == (
        fv.SILVER_DERIVED_COMMENTS.keys()
        | fv.SILVER_LABEL_COMMENTS.keys()
        | fv.SILVER_FLAG_COMMENTS.keys()
    )


def test_comment_ddl():
    made = comment_statements("s.t", {"b": "it's", "gone": "x", "a": "plain"}, ["a", "b"])
    assert made == [
        "ALTER TABLE s.t ALTER COLUMN b COMMENT 'it''s'",
        "ALTER TABLE s.t ALTER COLUMN a COMMENT 'plain'",
    ]


def test_command_line():
    from waybill.__main__ import parse
    from waybill.plans.medallion import Medallion

    plan, stages = parse(["--landing", "/in", "--taxi-types", "fhv, yellow", "--no-dedup", "--stages", "silver,gold"])
    assert plan == Medallion(landing="/in", taxi_types=("fhv", "yellow"), dedup=False)
    assert stages == ("silver", "gold")
    with pytest.raises(SystemExit):
        parse(["--landing", "/in", "--stages", "platinum"])
