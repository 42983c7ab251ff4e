"""Plans and skew: what keeps the operators usable on data a thousand times larger."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from waybill.operators import bronze, lattice, marts
from waybill.operators.dimensions import star_dimensions
from waybill.operators.fact import FACT_COLUMNS, build_fact, union_all_types
from waybill.operators.lookup import Dimension, lookup
from waybill.operators.silver import standardize_silver
from waybill.operators.sinks import write_table
from waybill.operators.staging import Shelf
from waybill.session import shuffles_sized_for
from waybill.sources.files import stored_bytes
from waybill.spec import CONFORMED_SCHEMA


@contextlib.contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("hot", ["7", "CAST(NULL AS BIGINT)"])
def test_hot_lookup_key_is_split(spark, plan_of, hot):
    """A third of all rows share one key, or have none, and the dimension is too large to
    broadcast."""
    with settings(spark, **SMALL_SKEW):
        facts = spark.range(0, 300_000, 1, 8).selectExpr(
            f"CASE WHEN id % 3 = 0 THEN {hot} ELSE id % 5000 END AS k", "uuid() AS payload"
        )
        big = Dimension(spark.range(5000).selectExpr("id", "id * 2 AS twice"), "id", 10**9)
        found = lookup(facts, big, "k", {"twice": "twice"})
        counted = found.groupBy("twice").agg(F.expr("count(payload) AS n"))
        result = dict(rows(counted))
        assert "SortMergeJoin(skew=true)" in plan_of(counted, executed=True)
    assert sum(result.values()) == 300_000
    assert result[14 if hot == "7" else None] >= 100_000
    assert len(result) == 5000 + (hot != "7")


def test_copies_collapse_before_the_shuffle(spark, plan_of):
    copies = spark.range(90_000).selectExpr("CASE WHEN id % 3 > 0 THEN 1 ELSE id END AS a", "concat('x', id % 2) AS b")
    once = bronze.deduplicate(copies)
    plan = plan_of(once)
    assert plan.count("HashAggregate") == 2 and plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")
    assert once.count() == 30_002
    first = bronze.deduplicate_first(copies, ["b"], [F.desc("a")])
    plan = plan_of(first)
    assert plan.index("1, Final") < plan.index("Exchange") < plan.index("1, Partial")
    assert rows(first) == [(89_994, "x0"), (89_997, "x1")]


def test_record_shuffles_are_sized(spark, plan_of, tmp_path):
    path = str(tmp_path / "files.parquet")
    spark.range(1000).write.parquet(path)
    assert 0 < stored_bytes(spark, [path]) < 100_000
    df = bronze.deduplicate(spark.read.parquet(path))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffles_sized_for(spark, 10 * 2**30) as partitions:
        assert partitions == 160
        assert "hashpartitioning(id" in plan_of(df) and ", 160)" in plan_of(df)
        assert df.count() == 1000
    again = bronze.deduplicate(spark.read.parquet(path))
    assert f", {usual})" in plan_of(again)


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(
        [(k, f"B{k % 5}", f"Z{k}", "Airports" if k == 3 else "Boro Zone") for k in range(20)],
        "LocationID int, Borough string, Zone string, service_zone string",
    )


@pytest.fixture(scope="module")
def stored_fact(spark, zones, tmp_path_factory):
    """A stored fact where a third of the trips are in one zone."""
    path = str(tmp_path_factory.mktemp("fact") / "fact.parquet")
    unified = spark.range(30_000).selectExpr(
        "CASE id % 4 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' WHEN 2 THEN 'fhv' ELSE 'fhvhv' END AS service_type",
        "id % 3 AS vendor_id",
        "CAST(id % 8 AS DOUBLE) AS ratecode_id",
        "CAST(id % 7 AS DOUBLE) AS payment_type",
        "CAST(NULL AS STRING) AS hvfhs_license_num",
        "timestamp_seconds(1672531200 + id * 400) AS pickup_datetime",
        "timestamp_seconds(1672531200 + id * 400 + id % 5000) AS dropoff_datetime",
        "CAST(CASE WHEN id % 3 = 0 THEN 7 ELSE id % 23 END AS INT) AS pu_location_id",
        "CAST(id % 23 AS INT) AS do_location_id",
        "CAST(id % 5 AS INT) AS passenger_count",
        "id % 1000 / 100D AS trip_distance",
        "id % 997 / 10D AS fare_amount",
        "id % 31 / 3D AS tip_amount",
        "0D AS tolls_amount",
        "id % 9973 / 100D AS total_amount",
        "id % 11 = 0 AS is_airport_trip",
    )
    assert unified.columns == list(CONFORMED_SCHEMA)
    build_fact(unified, star_dimensions(spark, zones)).write.parquet(path)
    return spark.read.parquet(path)


def test_marts_aggregate_before_they_join(spark, zones, stored_fact, plan_of):
    dims = star_dimensions(spark, zones)
    plan = plan_of(marts.agg_trips_by_zone(stored_fact, dims))
    scan = plan[plan.rindex("HashAggregate") :]  # lowest aggregate and below
    assert "Join" not in scan and "ReadSchema: struct<pickup_zone_key:int,service_type_key:int" in scan
    assert "vendor_id" not in scan


def test_cuboids_come_from_their_smallest_parents(spark, zones, stored_fact):
    finest, labels, merge = marts.finest_groups(stored_fact, star_dimensions(spark, zones))
    shelf = Shelf(spark, "test-lattice")
    tables = lattice.cuboids(finest, labels, merge, shelf.put)
    sizes = [t.count() for t in tables]
    assert sorted(r[0] for t in tables for r in t.select("grouping_id").distinct().collect()) == list(range(64))
    read = sum(sum(sizes[:i]) for i in range(1, len(sizes)))  # each step reads all tables before it
    assert read < 64 * sizes[0] / 6
    values = {label: tables[0].select(label).distinct().count() for label in labels}
    order = lattice.rolling_order(tables[0], labels)
    assert [values[label] for label in order] == sorted(values.values(), reverse=True)


def test_cube_equals_direct_cube(spark, zones, stored_fact):
    dims = star_dimensions(spark, zones)
    cube = marts.cube_trips(stored_fact, dims)
    labelled = (
        stored_fact.join(dims.service_type.frame, "service_type_key")
        .join(dims.time.frame, F.expr("pickup_time_key = time_key"))
        .join(dims.zone.frame, F.expr("pickup_zone_key = zone_key"), "left")
        .join(dims.payment_type.frame, "payment_type_key", "left")
        .selectExpr(
            "service_type",
            "year(pickup_datetime) AS year",
            "month(pickup_datetime) AS month",
            "hour",
            "borough AS pickup_borough",
            "payment_type_name",
            "CAST(total_amount AS DECIMAL(12, 2)) AS total_amount",
            "passenger_count",
        )
    )
    labels = labelled.columns[:6]
    direct = labelled.cube(*labels).agg(
        F.grouping_id().alias("grouping_id"),
        F.expr("count(1) AS trips"),
        F.expr("CAST(sum(total_amount) AS DOUBLE) AS sum_total_amount"),
        F.expr("avg(passenger_count) AS avg_passenger_count"),
    )
    assert rows(cube, *direct.columns) == rows(direct)


def test_sums_do_not_depend_on_partitioning(spark, zones, stored_fact):
    dims = star_dimensions(spark, zones)
    expected = rows(marts.agg_revenue_monthly(stored_fact, dims))
    for n, key in ((3, "passenger_count"), (13, "pickup_datetime")):
        shuffled = stored_fact.repartition(n, key)
        assert rows(marts.agg_revenue_monthly(shuffled, dims)) == expected


def test_silver_and_fact_do_not_shuffle_records(spark, zones, tmp_path, plan_of):
    path = str(tmp_path / "trips.parquet")
    spark.range(10).selectExpr(
        "id AS VendorID",
        "CAST(timestamp_seconds(1672531200 + id) AS TIMESTAMP_NTZ) AS tpep_pickup_datetime",
        "CAST(timestamp_seconds(1672531200 + id) AS TIMESTAMP_NTZ) AS tpep_dropoff_datetime",
        "id AS PULocationID",
        "id AS DOLocationID",
        "1D AS RatecodeID",
        "1 AS payment_type",
        "1D AS passenger_count",
        "1D AS trip_distance",
        "1D AS fare_amount",
        "1D AS tip_amount",
        "1D AS tolls_amount",
        "1D AS total_amount",
        "'Y' AS store_and_fwd_flag",
    ).write.parquet(path)
    silver = standardize_silver(
        spark.read.parquet(path), zones, "yellow", "2023-01-01", "2023-02-01"
    )
    plan = plan_of(silver)
    assert "PushedFilters: [IsNotNull(tpep_pickup_datetime), GreaterThanOrEqual(tpep_pickup_datetime,2023-01-01T00:00)" in plan
    fact = build_fact(union_all_types({"yellow": silver}), star_dimensions(spark, zones))
    for text in (plan, plan_of(fact)):
        # a zone dimension may need a small exchange of its own; records never move
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert tuple(fact.columns) == FACT_COLUMNS and fact.count() == 10


def test_hot_partition_is_written_by_many_tasks(spark):
    """Two thirds of the rows in one month; still no file holds much more than its share."""
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__shuffle__partitions="8",
    ):
        df = spark.range(0, 200_000, 1, 8).selectExpr(
            "uuid() AS payload", "CASE WHEN id % 3 > 0 THEN 1 ELSE id % 12 + 1 END AS pickup_month"
        )
        spark.sql("CREATE DATABASE IF NOT EXISTS scale")
        write_table(df, "scale.t", ("pickup_month",), rebalance=True)
    written = spark.table("scale.t")
    hot = written.filter("pickup_month = 1").groupBy(F.input_file_name().alias("f")).count()
    assert hot.count() == 8  # one slice per upstream task
    assert written.count() == 200_000
