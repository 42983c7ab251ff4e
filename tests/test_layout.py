"""Files that filters skip, partitions that joins prune, and deliveries compared with what is stored."""

import glob
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from waybill.operators import deliveries, marts
from waybill.operators.deliveries import key_sketch, may_be_in, new_records
from waybill.operators.dimensions import star_dimensions, stored_dimensions
from waybill.operators.layout import clustered, interleaved
from waybill.operators.sinks import create_schema, write_table


def files_that_may_hold(path, column, values):
    """Files whose statistics do not rule the values out, of all files."""
    found, files = 0, glob.glob(f"{path}/*.parquet")
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        ranges = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found += any(r.min <= v <= r.max for r in ranges for v in values)
    return found, len(files)


@pytest.fixture(scope="module")
def trips(spark):
    """A third of all trips start in one zone."""
    return spark.range(60_000).selectExpr(
        "CAST(20230101 + id % 28 AS INT) AS pickup_date_key",
        "CAST(CASE WHEN hash(id) % 3 = 0 THEN 132 ELSE pmod(hash(id, 1), 265) END AS INT) AS pickup_zone_key",
        "id % 97 / 10D AS total_amount",
    )


def test_filters_skip_files(spark, trips, tmp_path):
    before, after, by_date = (str(tmp_path / n) for n in ("before", "after", "by_date"))
    columns = ["pickup_date_key", "pickup_zone_key"]
    trips.repartition(64).write.parquet(before)
    trips.repartitionByRange(64, "pickup_date_key", "total_amount").write.parquet(by_date)
    clustered(trips, columns, 64).write.parquet(after)
    assert Counter(map(tuple, spark.read.parquet(after).collect())) == Counter(map(tuple, trips.collect()))
    zones, days = [3, 250], [20230107]
    read = {p: files_that_may_hold(p, "pickup_zone_key", zones)[0] for p in (before, by_date, after)}
    # two of 265 zones: all files as they come or by date, a third of them when clustered
    assert read[before] >= 60 and read[by_date] >= 55 and read[after] <= 64 // 3
    found, all_files = files_that_may_hold(after, "pickup_date_key", days)
    assert all_files <= 64 and found <= 64 // 3 and files_that_may_hold(before, "pickup_date_key", days)[0] >= 60
    rows = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{after}/*.parquet")]
    assert max(rows) < 4 * 60_000 / 64  # the hot zone is cut


def test_order_of_few_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (1, 5), (NULL, 5) AS t(a, b)")
    assert clustered(df, ["a", "b"], 3).count() == 3
    assert clustered(df.filter("false"), ["a", "b"], 3).count() == 0
    places = [F.lit(0b101), F.lit(0b011)]
    assert spark.range(1).select(interleaved(places, 3)).first()[0] == 0b100111


def test_star_join_prunes_partitions(spark, plan_of):
    """A filter on a dimension reaches the fact's partitions at run time."""
    zones = spark.createDataFrame([(1, "B", "Z", "Yellow Zone")], "LocationID int, Borough string, Zone string, service_zone string")
    create_schema(spark, "pruned")
    for name, dimension in star_dimensions(spark, zones).named().items():
        write_table(dimension.frame, f"pruned.{name}")
    write_table(spark.sql("SELECT 20230101 AS date_key, 2023 AS year, 1 AS month"), "pruned.dim_date")
    fact = spark.range(400).selectExpr(
        "CAST(1 + id % 4 AS INT) AS service_type_key", "20230101 AS pickup_date_key", "CAST(id AS DOUBLE) AS total_amount"
    )
    write_table(fact, "pruned.fact", ("service_type_key",))
    dims = stored_dimensions(spark, "pruned")
    stored = spark.table("pruned.fact")
    green = marts.Axis("service_type_key", "service_type", {"service_type": "service_type"}, where="service_type = 'green'")
    found = marts.star_rollup(stored, dims, (green,), (marts.TOTAL,))
    plan = plan_of(found, executed=True)
    assert "dynamicpruning" in plan.lower()
    assert [tuple(r)[:2] for r in found.collect()] == [("green", 100)]
    everything = marts.star_rollup(stored, dims, (marts.SERVICE_TYPE,), (marts.TOTAL,))
    assert found.collect()[0] in everything.collect() and "dynamicpruning" not in plan_of(everything, executed=True).lower()


@pytest.mark.parametrize("bits", [deliveries.SKETCH_BITS, 1 << 15, 8])
@pytest.mark.parametrize("keys", [None, ["a"], ["a", "b"]])
def test_new_records_are_exact(spark, bits, keys):
    stored = spark.sql("SELECT CAST(id % 50 AS INT) AS a, if(id % 7 = 0, NULL, 'x' || id % 7) AS b, id % 3 / 2D AS c FROM range(200)")
    delivery = spark.sql(
        "SELECT CAST(if(id % 11 = 0, NULL, id % 70) AS INT) AS a, if(id % 5 = 0, NULL, 'x' || id % 7) AS b, id % 3 / 2D AS c FROM range(300)"
    )
    at = {"a": 0, "b": 1, "c": 2}
    key = lambda r: tuple(r[at[k]] for k in keys or at)
    known = {key(r) for r in stored.collect()}
    expected = Counter({key(r) for r in delivery.collect()} - known)
    got = new_records(delivery, stored, keys, bits).collect()
    assert Counter(map(key, got)) == expected
    assert set(map(tuple, got)) <= set(map(tuple, delivery.collect()))


def test_few_stored_rows_are_shuffled(spark, plan_of):
    stored = spark.range(200_000).selectExpr("id AS a", "'p' || id AS b")
    delivery = spark.range(199_000, 203_000).selectExpr("id AS a", "'p' || id AS b")
    sketch = key_sketch(delivery, ["a", "b"])
    passed = may_be_in(stored, ["a", "b"], sketch)
    assert 1000 <= passed.count() <= 1010  # of 200,000: the thousand that match, and what shares a bit with them
    plan = plan_of(passed)
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # the sketch's own
    assert new_records(delivery, stored).count() == 3000
    assert new_records(delivery.filter("false"), stored).count() == 0 and new_records(delivery, stored.filter("false")).count() == 4000
