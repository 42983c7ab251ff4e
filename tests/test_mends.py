"""Sums, broadcasts, keys, literals, and files under awkward inputs."""

import glob
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from waybill.functions.dates import duration_minutes
from waybill.functions.keys import natural_key
from waybill.functions.labels import code_label
from waybill.functions.measures import Measure
from waybill.operators import bronze
from waybill.operators.lookup import lookup, measured
from waybill.operators.sinks import create_schema, write_table

AMOUNT = Measure("x", average="mean", total="total")


def summed(df):
    merged = df.groupBy("g").agg(*map(F.expr, AMOUNT.partial())).groupBy("g").agg(*map(F.expr, AMOUNT.merged()))
    return {r.g: (r.mean, r.total) for r in merged.selectExpr("g", *AMOUNT.finished()).collect()}


def test_sums_are_not_rounded_and_hold_what_no_decimal_holds(spark):
    values = {"cents": [0.004] * 250 + [12.3456789], "odd": [1.5, float("nan")], "endless": [1.0, float("inf")],
              "huge": [1e300, 2.5], "none": [None, None], "some": [None, -3.25]}
    df = spark.createDataFrame([(g, x) for g, xs in values.items() for x in xs], "g string, x double")
    plain = {r.g: (r.mean, r.total) for r in df.groupBy("g").agg(F.avg("x").alias("mean"), F.sum("x").alias("total")).collect()}
    for g, pair in summed(df).items():
        for got, expected in zip(pair, plain[g]):
            if expected is None or math.isnan(expected):
                assert got is None if expected is None else math.isnan(got)
            else:
                assert got == pytest.approx(expected, rel=1e-9)
    one = df.filter("g = 'cents'").selectExpr(f"{AMOUNT.total_in_one()} AS t").first().t
    assert one == pytest.approx(13.3456789, rel=1e-12)


def test_wide_texts_are_not_broadcast(spark, plan_of):
    wide = spark.range(1000).selectExpr("CAST(id AS INT) AS k", "repeat('x', 100000) AS label")
    facts = spark.range(20).selectExpr("CAST(id AS INT) AS f")
    found = measured(wide, "k")
    assert not found.broadcastable and found.size > 100_000_000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = lookup(facts, found, "f", {"label": "label"})
        assert "SortMergeJoin" in plan_of(joined)
        assert joined.filter("length(label) = 100000").count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert measured(wide.selectExpr("k", "'x' AS label"), "k").broadcastable
    assert not measured(wide.selectExpr("k", "array(k) AS label"), "k").broadcastable


def test_key_deduplication_keeps_whole_records_without_sorted_aggregates(spark, plan_of):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, None, "z"), (2, None, "z"), (None, "n", "n")], "k int, a string, b string")
    once = bronze.deduplicate(df, ["k"])
    assert "SortAggregate" not in plan_of(once)
    assert once.count() == 3 and {tuple(r) for r in once.collect()} <= {tuple(r) for r in df.collect()}


def test_natural_keys_hash_missing_parts(spark):
    df = spark.sql(
        """SELECT 'yellow' AS service_type, 1 AS vendor_id, 2 AS pu_location_id, 3 AS do_location_id,
                  TIMESTAMP'2024-01-01' AS pickup_datetime,
                  CASE WHEN id > 0 THEN timestamp_seconds(id) END AS dropoff_datetime FROM range(6)"""
    )
    assert df.selectExpr(f"{natural_key()} AS sk").filter("sk IS NOT NULL").distinct().count() == 6


def test_texts_in_sql_are_escaped(spark):
    df = spark.createDataFrame([(1,), (2,)], "code int")
    label = code_label("code", {1: "it's", 2: "back\\slash"})
    assert rows(df.selectExpr(f"{label} AS label")) == [("back\\slash",), ("it's",)]


def test_absurd_durations_are_null(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01' AS a, TIMESTAMP'9999-01-01' AS b UNION ALL SELECT TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-01 00:01:59'")
    assert sorted(str(r[0]) for r in df.selectExpr(duration_minutes("a", "b")).collect()) == ["1", "None"]


def test_rebalanced_months_are_few_files(spark, tmp_path):
    create_schema(spark, "mends")
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "CAST(id % 5 AS INT) AS pickup_month")
    counts = {}
    for even in (False, True):
        write_table(df, "mends.t", ("pickup_month",), rebalance=even)
        folder = spark.sql("DESCRIBE EXTENDED mends.t").filter("col_name = 'Location'").first().data_type
        counts[even] = len(glob.glob(folder.removeprefix("file:") + "/*/*.parquet"))
        assert spark.table("mends.t").count() == 4000
    assert counts == {False: 80, True: 5}


def test_windows_follow_the_tables(spark, tmp_path):
    """The stand-ins' windows come off the rows, so none is lost to a period of other tables."""
    from checks import standins

    folder = str(tmp_path)
    spark.sql(
        "SELECT * FROM VALUES (1, 1, TIMESTAMP_NTZ'1971-02-03'), (2, 47, TIMESTAMP_NTZ'2033-11-30'), (3, 5, NULL)"
        " AS t(o_orderkey, o_custkey, o_orderdate)"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01' AS ts WHERE false").write.parquet(f"{folder}/events.parquet")
    for taxi_type in ("yellow", "green", "fhv"):
        assert standins.window(spark, folder, taxi_type) == ("1971-02-03", "2033-12-01")
    assert standins.window(spark, folder, "fhvhv") == (None, None)
