"""Hot keys in joins, and numbers from prefix sums."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waybill.operators.fact import with_stable_keys
from waybill.operators.numbering import with_row_numbers, with_running_sums
from waybill.operators.skew import hot_parts, rows_per_key, split_join
from waybill.operators.staging import Shelf, cleared_afterwards


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """A third of the left rows have one key; a null key never matches."""
    folder = str(tmp_path_factory.mktemp("skew"))
    spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 1000 = 1 THEN NULL ELSE id END AS k", "id % 5 AS s", "id AS v"
    ).write.parquet(f"{folder}/left")
    spark.range(10_000).selectExpr("id AS k", "id % 5 AS s", "id * 2 AS w").union(
        spark.sql("SELECT 7L, s, 1L FROM range(5) AS t(s) UNION ALL SELECT NULL, 0L, 0L")
    ).write.parquet(f"{folder}/right")
    return spark.read.parquet(f"{folder}/left"), spark.read.parquet(f"{folder}/right")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", [["k"], ["k", "s"]])
def test_split_joins_give_what_joins_give(sides, how, on):
    left, right = sides
    right = right if len(on) > 1 else right.drop("s")
    expected = left.join(right, on, how)
    got = split_join(left, right, on, how)
    assert got.columns == expected.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_hot_key_goes_to_several_tasks(spark, sides, plan_of):
    left, right = sides
    per_task = lambda df: sorted(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        once = right.groupBy("k").agg(F.max("w").alias("w"))
        plain = per_task(left.join(once.hint("merge"), "k"))
        dealt = split_join(left, once, ["k"], deal_by=F.col("v"))
        assert "hashpartitioning(k" in plan_of(dealt) and "__hot_part" in plan_of(dealt)
        assert max(plain) >= 10_000 and max(per_task(dealt)) < 5_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_never_more_hot_keys_than_partitions(spark, sides):
    left, _ = sides
    counts = rows_per_key(left, ["s"])
    assert hot_parts(counts, ["s"], "n", left.count(), 4).count() == 0  # five keys of a fifth each
    assert hot_parts(counts, ["s"], "n", left.count(), 8).count() == 5
    assert hot_parts(rows_per_key(left, ["k"]), ["k"], "n", left.count(), 100).collect()[0]["__hot_parts"] == 134
    empty = left.filter("false")
    assert split_join(empty, left, ["k"]).collect() == [] and split_join(left, empty, ["k"], "left_anti").count() == 30_000


def test_numbers_have_no_gaps(spark):
    shelf = Shelf(spark, "test-numbers")
    values = [random.Random(1).randrange(500) if i % 3 else 7 for i in range(5000)] + [None] * 3
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").repartition(5)
    got = with_row_numbers(df, [F.col("v").desc_nulls_last()], "n", lambda d: shelf.put(d, "kept"), first=1)
    assert got.columns == ["v", "i", "n"]
    rows = sorted(got.collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == list(range(1, len(values) + 1))
    assert [r["v"] for r in rows] == sorted(values[:-3], reverse=True) + [None] * 3
    assert with_row_numbers(df.filter("false"), [F.col("v")], "n", lambda d: shelf.put(d, "empty")).collect() == []


def test_running_sums(spark):
    shelf = Shelf(spark, "test-sums")
    df = spark.range(2000).selectExpr("pmod(hash(id), 50) AS v", "id", "id % 7 AS n").repartition(6)
    got = with_running_sums(df, [F.col("v"), F.col("id")], "n", "before", lambda d: shelf.put(d, "kept")).collect()
    total = 0
    for r in sorted(got, key=lambda r: (r["v"], r["id"])):
        assert r["before"] == total
        total += r["n"]
    assert len(got) == 2000


def test_stable_keys_of_a_hot_natural_key(spark):
    """A third of the trips share their natural key: their range is cut, their numbers are not."""
    df = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE md5(CAST(id DIV 2 AS STRING)) END AS trip_sk", "CAST(id % 7 AS DOUBLE) AS total_amount"
    )
    natural = Counter(r["trip_sk"] for r in df.collect())
    expected = {f"{k}-{i}" for k, n in natural.items() for i in range(1, n + 1)}
    keyed = with_stable_keys(df)
    assert keyed.columns == df.columns
    assert Counter(r["trip_sk"] for r in keyed.collect()) == Counter(expected)
    assert {r["trip_sk"] for r in with_stable_keys(df.repartition(7)).collect()} == expected


def test_shelves_are_cleared(spark):
    """A block's shelves go with it, also when it fails; others stay."""
    kept = Shelf(spark, "kept")
    outside = kept.put(spark.range(3), "t")
    with cleared_afterwards():
        inner = Shelf(spark, "inner")
        copied = kept.put(inner.put(spark.range(5), "t"), "copy")
        with pytest.raises(ValueError), cleared_afterwards():
            lost = Shelf(spark, "lost").put(spark.range(1), "t")
            raise ValueError
        with pytest.raises(Exception):
            lost.count()
    assert outside.count() == 3 and copied.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(f"{inner.root}/t").count()
