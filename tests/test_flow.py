"""Files, sinks and the whole flow, on files written by the tests themselves."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from waybill import fixed_values as fv
from waybill.operators.quality import landing_completeness, missing_months
from waybill.operators.sinks import apply_comments, create_schema, preview, write_table
from waybill.plans.medallion import Medallion, landing_report, run
from waybill.sources.calendars import date_bounds, days_of, months
from waybill.sources.files import landed_months, monthly_paths, optional_table, read_monthly, read_zone_csv
from waybill.sources.inline import inline_values

CSV = 'LocationID,Borough,Zone,service_zone\n61,Northside,North Field,Airports\n57,Midtown,"Mill, Lane",Yellow Zone\nx,?,?,?\n'


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Two months per type; the schema drifts between them as published files do."""
    root = tmp_path_factory.mktemp("landing")

    def put(taxi_type, month, schema, *data):
        df = spark.createDataFrame(data, schema).coalesce(1)
        df.write.parquet(str(root / f"{taxi_type}_tripdata_{month}.parquet"))

    when = dt.datetime.fromisoformat
    for taxi_type, prefix in (("yellow", "tpep"), ("green", "lpep")):
        common = (
            f"VendorID bigint, {prefix}_pickup_datetime timestamp_ntz, {prefix}_dropoff_datetime timestamp_ntz,"
            " passenger_count {n}, trip_distance double, RatecodeID {n}, store_and_fwd_flag string,"
            " PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double,"
            " tip_amount double, tolls_amount double, total_amount double, {fee} {n}"
        )
        trip = lambda day, vendor=1: (
            vendor, when(f"{day} 10:00:00"), when(f"{day} 10:20:00"), 1, 2.5, 1, "N", 61, 57, 1, 9.0, 1.0, 0.0, 10.0, 0,
        )
        put(taxi_type, "2023-01", common.format(n="bigint", fee="airport_fee"), trip("2023-01-05"), trip("2023-01-05"), trip("2140-01-01"))
        later = tuple(float(v) if i in (3, 5, 14) else v for i, v in enumerate(trip("2023-02-05", 2)))
        put(taxi_type, "2023-02", common.format(n="double", fee="Airport_fee"), later)
    for month in ("2023-01", "2023-02"):
        put(
            "fhv",
            month,
            "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz,"
            " PUlocationID double, DOlocationID double, SR_Flag int, Affiliated_base_number string",
            ("B1", when(f"{month}-10 08:00:00"), when(f"{month}-10 08:30:00"), None, 57.0, None, "B1"),
        )
        put(
            "fhvhv",
            month,
            "hvfhs_license_num string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz,"
            " PULocationID bigint, DOLocationID bigint, trip_miles double, base_passenger_fare double,"
            " tolls double, bcf double, sales_tax double, congestion_surcharge double, airport_fee double,"
            " tips double, shared_request_flag string",
            ("HV0003", when(f"{month}-10 09:00:00"), when(f"{month}-10 09:30:00"), 57, 61, 4.0, 20.0, 0.0, 0.5, 1.5, 2.75, None, 3.0, "N"),
        )
    (root / "zones.csv").write_text(CSV)
    return str(root)


def test_paths(landing):
    assert monthly_paths("/r", "fhv", "2022-12-05", "2023-01-09") == [
        "/r/fhv_tripdata_2022-12.parquet",
        "/r/fhv_tripdata_2023-01.parquet",
    ]


def test_drifting_months_are_one_frame(spark, landing, plan_of):
    paths = monthly_paths(landing, "yellow", "2023-01-01", "2023-02-01")
    df = read_monthly(spark, paths)
    assert dict(df.dtypes)["airport_fee"] == "double" and "Airport_fee" not in df.columns
    assert df.count() == 4
    same = read_monthly(spark, monthly_paths(landing, "fhv", "2023-01-01", "2023-02-01"))
    assert plan_of(same).count("FileScan") == 1 and same.count() == 2
    with pytest.raises(ValueError):
        read_monthly(spark, [])


def test_zone_csv(spark, landing):
    zones = read_zone_csv(spark, f"{landing}/zones.csv")
    assert zones.dtypes == [(c, "int" if c == "location_id" else "string") for c in fv.ZONE_COMMENTS]
    assert rows(zones, "location_id", "zone") == [(57, "Mill, Lane"), (61, "North Field"), (None, "?")]


def test_landed_months(spark, tmp_path):
    for name, size in (("yellow_tripdata_2023-01", 3), ("yellow_tripdata_2023-02", 0), ("green_tripdata_2023-03", 3)):
        (tmp_path / f"{name}.parquet").write_bytes(b"x" * size)
    landed = landed_months(spark, str(tmp_path), "yellow")
    assert rows(landed) == [("2023-01",)]
    expected = months(spark, "2023-01-15", "2023-03-01")
    assert rows(landing_completeness(expected, landed)) == [
        ("2023-01", "ingested"),
        ("2023-02", "missing"),
        ("2023-03", "missing"),
    ]
    assert rows(missing_months(expected, landed)) == [("2023-02",), ("2023-03",)]


def test_landing_report(spark, tmp_path):
    (tmp_path / "fhv_tripdata_2023-02.parquet").write_bytes(b"x")
    plan = Medallion(landing=str(tmp_path), date_start="2023-01-01", date_stop="2023-02-01")
    assert rows(landing_report(spark, plan, "fhv")) == [("2023-01", "missing"), ("2023-02", "ingested")]


def test_generated_rows(spark):
    assert rows(months(spark, "2022-11-30", "2023-02-01")) == [("2022-11",), ("2022-12",), ("2023-01",), ("2023-02",)]
    assert rows(months(spark, "2023-05-01", "2023-04-30")) == []
    dates = spark.createDataFrame([("2024-02-28",), (None,), ("2024-03-01",)], "d string")
    bounds = date_bounds([(dates.selectExpr("CAST(d AS DATE) AS d"), "d")])
    assert days_of(bounds).count() == 3
    assert days_of(date_bounds([(dates.selectExpr("CAST(NULL AS DATE) AS d"), "d")])).count() == 0


def test_literals(spark, plan_of):
    df = inline_values(spark, ("k", "v"), [(1, "it's"), (2, "a\\b"), (3, None)])
    assert rows(df) == [(1, "it's"), (2, "a\\b"), (3, None)]
    assert "LocalTableScan" in plan_of(df)


def test_sinks(spark):
    create_schema(spark, "sinks")
    df = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2)], "v int, pickup_year int, pickup_month int")
    write_table(
        df,
        "sinks.t",
        partition_by=("pickup_year", "pickup_month", "absent"),
        comments={"v": "o 'valor'", "absent": "x"},
        table_comment="it's a table",
        rebalance=True,
        max_records_per_file=10,
    )
    assert rows(spark.table("sinks.t"), "v", "pickup_month") == [(1, 1), (2, 2)]
    columns = {c.name: c for c in spark.catalog.listColumns("sinks.t")}
    assert columns["v"].description == "o 'valor'"
    assert columns["pickup_year"].isPartition and columns["pickup_month"].isPartition
    assert spark.catalog.getTable("sinks.t").description == "it's a table"

    write_table(df.selectExpr("CAST(v AS STRING) AS other"), "sinks.t")  # another schema
    assert spark.table("sinks.t").dtypes == [("other", "string")]
    apply_comments(spark, "sinks.t", {"other": "a 'quoted' text", "absent": "x"})
    assert spark.catalog.listColumns("sinks.t")[0].description == "a 'quoted' text"
    assert optional_table(spark, "sinks.t").count() == 2
    broken = df.selectExpr("CAST(raise_error('no') AS STRING) AS other")
    with pytest.raises(Exception, match="no"):
        write_table(broken, "sinks.t")
    assert rows(spark.table("sinks.t")) == [("1",), ("2",)]  # the old rows, readable as before
    assert optional_table(spark, "sinks.nothing") is None
    assert preview(spark.range(50)).count() == 20


def test_whole_flow(spark, landing):
    plan = Medallion(
        landing=landing,
        zone_csv=f"{landing}/zones.csv",
        date_start="2023-01-01",
        date_stop="2023-02-01",
        bronze="flow_bronze",
        silver="flow_silver",
        gold="flow_gold",
    )
    with pytest.raises(FileNotFoundError, match="yellow: 2023-03"):
        run(spark, Medallion(**{**vars(plan), "date_stop": "2023-03-01"}))
    assert not spark.catalog.tableExists("flow_bronze.yellow_trips")  # nothing was touched
    # the unknown id in the CSV is a NULL key, which is no key at all
    run(spark, plan)
    assert spark.table("flow_bronze.yellow_trips").count() == 3  # one exact copy removed
    silver = spark.table("flow_silver.yellow_trips")
    assert rows(silver, "vendor_id", "pickup_year", "pickup_month", "pickup_borough") == [
        (1, 2023, 1, "Northside"),
        (2, 2023, 2, "Northside"),
    ]
    partitions = {c.name for c in spark.catalog.listColumns("flow_silver.yellow_trips") if c.isPartition}
    assert partitions == {"pickup_year", "pickup_month"}
    described = {c.name: c.description for c in spark.catalog.listColumns("flow_silver.fhvhv_trips")}
    assert described["shared_request_flag"] == fv.SILVER_FLAG_COMMENTS["shared_request_flag"]

    fact = spark.table("flow_gold.fact_trips")
    assert dict(rows(fact.groupBy("service_type_key").count())) == {1: 2, 2: 2, 3: 2, 4: 2}
    assert rows(fact.filter("service_type_key = 3"), "pickup_zone_key", "dropoff_zone_key") == [(-1, 57)] * 2
    assert spark.catalog.getTable("flow_gold.fact_trips").description == fv.TABLE_COMMENTS["fact_trips"]
    revenue = spark.table("flow_gold.agg_revenue_monthly")
    assert rows(revenue.filter("service_type = 'fhvhv'"), "month", "trips", "sum_total_amount") == [
        (1, 1, 27.75),
        (2, 1, 27.75),
    ]
    cube = spark.table("flow_gold.cube_trips")
    assert cube.filter("grouping_id = 63").first()["trips"] == 8
    assert cube.select(F.count_distinct("grouping_id")).first()[0] == 64
    assert spark.table("flow_gold.dim_date").count() == 37
    run(spark, plan)  # replaces every table
    assert spark.table("flow_gold.fact_trips").count() == 8


def test_one_month_landed_again(spark, landing, tmp_path, plan_of):
    """Only its silver partition is written and only its states are computed; the marts equal a build from
    the trips. Needs nothing of the flow above."""
    import shutil

    from waybill.operators import marts, states
    from waybill.operators.dimensions import stored_dimensions
    from waybill.plans import medallion

    folder = str(tmp_path / "landing")
    shutil.copytree(landing, folder)
    plan = Medallion(
        landing=folder,
        zone_csv=f"{folder}/zones.csv",
        date_start="2023-01-01",
        date_stop="2023-02-01",
        bronze="again_bronze",
        silver="again_silver",
        gold="again_gold",
    )
    run(spark, plan)

    def files(name):
        found = spark.table(name).select("_metadata.file_path", "_metadata.file_modification_time").distinct()
        return {tuple(r) for r in found.collect()}

    def marts_and_trips():
        dims = replace(stored_dimensions(spark, "again_gold"), date=None)
        fact = spark.table("again_gold.fact_trips")
        for name in ("agg_revenue_monthly", "agg_trips_by_hour", "agg_trips_by_zone", "cube_trips"):
            stored, direct = spark.table(f"again_gold.{name}"), getattr(marts, name)(fact, dims)
            assert stored.columns == direct.columns and rows(stored) == rows(direct)

    marts_and_trips()
    tables = [f"again_silver.{t}_trips" for t in plan.taxi_types] + ["again_gold.month_states"]
    before = {name: files(name) for name in tables}
    run(spark, plan)
    assert {name: files(name) for name in tables} == before  # nothing changed, nothing is written

    path = f"{folder}/yellow_tripdata_2023-02.parquet"
    landed = spark.read.parquet(path)
    amount = next(c for c in landed.columns if c.lower() == "total_amount")
    raised = landed.withColumn(amount, F.col(amount) + 100)
    spark.createDataFrame(raised.collect(), raised.schema).write.mode("overwrite").parquet(path)
    by_dimension, by_type = run(spark, plan)
    for name in tables:
        same = files(name) & before[name]
        if name in ("again_silver.yellow_trips", "again_gold.month_states"):
            # one path for each partition that stayed: January's
            assert same and all("month=1/" in f for f, _ in same) and not any("month=1/" in f for f, _ in before[name] - same)
        else:
            assert same == before[name]
    marts_and_trips()

    # the report is that of the stored tables, without a scan of them
    expected = medallion.gold_report(spark, plan)
    assert rows(by_dimension) == rows(expected[0]) and rows(by_type) == rows(expected[1])
    assert [by_dimension.dtypes, by_type.dtypes] == [e.dtypes for e in expected]
    assert "FileScan" not in plan_of(by_dimension) and "fact" not in plan_of(by_type)

    # a run over fewer types rebuilds gold from these; one over all types again has all
    run(spark, Medallion(**{**vars(plan), "taxi_types": ("yellow",)}))
    assert states.trips_of(spark.table("again_gold.month_states")) == {1: 2}
    run(spark, plan)
    marts_and_trips()
    assert set(states.trips_of(spark.table("again_gold.month_states"))) == {1, 2, 3, 4}


def test_silver_filter_prunes_partitions_and_columns(spark, landing, plan_of):
    """Needs the tables of the flow above."""
    from waybill.operators.questions import silver_by_hour

    plan = plan_of(silver_by_hour(spark.table("flow_silver.yellow_trips"), month=1))
    scan = plan[plan.index("FileScan") :]
    assert "PartitionFilters: [isnotnull(pickup_month" in scan
    assert "ReadSchema: struct<tpep_pickup_datetime:timestamp,passenger_count:double>" in scan
