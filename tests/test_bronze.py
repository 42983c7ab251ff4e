import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from waybill.operators.bronze import build_bronze, deduplicate, deduplicate_first
from waybill.operators.schema import promote_type, reconcile, snake_case_columns, unify_schemas

LINES = [
    (1, "2023-01-05 07:00:00", 7, 10.0),
    (1, "2023-01-05 07:00:00", 7, 10.0),
    (2, "2023-01-05 07:00:00", 7, 99.0),
    (3, "2023-02-01 00:00:00", 8, 5.0),
]
COLUMNS = ["VendorID", "tpep_pickup_datetime", "PULocationID", "fare_amount"]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(LINES, COLUMNS)


def test_full_rows(lines):
    assert rows(build_bronze(lines), *COLUMNS) == sorted(set(LINES))


def test_switched_off(lines):
    assert build_bronze(lines, dedup=False).count() == len(LINES)


def test_by_key(lines):
    kept = build_bronze(lines, dedup_keys=["tpep_pickup_datetime", "PULocationID"])
    assert kept.count() == 2


def test_absent_keys_are_ignored_loudly(lines):
    with pytest.warns(UserWarning, match="nowhere"):
        assert build_bronze(lines, dedup_keys=["nowhere"]).count() == 3
    with pytest.warns(UserWarning):
        assert deduplicate(lines, ["nowhere", "PULocationID"]).count() == 2
    with pytest.raises(ValueError, match="nowhere"):
        deduplicate(lines, ["nowhere"], strict=True)


def test_first_by_order_is_reproducible(lines):
    kept = deduplicate_first(lines, ["PULocationID"], [F.desc("fare_amount")])
    assert rows(kept, "VendorID") == [(2,), (3,)]


def test_only_the_ingestion_time_is_added(lines):
    out = build_bronze(lines)
    assert out.columns == COLUMNS + ["dt_ingestion"]
    stamp = out.first()["dt_ingestion"]
    assert abs(stamp - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(days=1)


BYTE, SHORT, INT, LONG = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
FLOAT, DOUBLE, TEXT = T.FloatType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize(
    "types, common",
    [
        ([INT, INT], INT),
        ([BYTE, SHORT], SHORT),
        ([INT, LONG], LONG),
        ([LONG, DOUBLE], DOUBLE),
        ([INT, FLOAT], FLOAT),
        ([LONG, FLOAT], FLOAT),
        ([FLOAT, DOUBLE, BYTE], DOUBLE),
        ([T.DecimalType(10, 2), T.DecimalType(10, 2)], T.DecimalType(10, 2)),
        ([T.DecimalType(10, 2), T.DecimalType(12, 2)], DOUBLE),
        ([T.DecimalType(10, 2), INT], DOUBLE),
        ([LONG, TEXT], TEXT),
        ([T.BooleanType(), INT], TEXT),
        ([T.DateType(), T.TimestampType()], TEXT),
        ([T.TimestampNTZType(), T.TimestampType()], TEXT),
    ],
)
def test_promotion(types, common):
    assert promote_type(types) == common
    assert promote_type(types[::-1]) == common


def test_promotion_is_applied_to_values(spark):
    whole = spark.createDataFrame([(1, 3)], "VendorID long, fee long")
    broken = spark.createDataFrame([(2, 1.75)], "VendorID long, fee double")
    out = unify_schemas([whole, broken])
    assert out.dtypes == [("VendorID", "bigint"), ("fee", "double")]
    assert rows(out) == [(1, 3.0), (2, 1.75)]


def test_missing_column_is_null(spark):
    old = spark.createDataFrame([(1,)], "VendorID long")
    new = spark.createDataFrame([(2.5, 2)], "surcharge double, VendorID long")
    out = unify_schemas([old, new])
    assert out.columns == ["VendorID", "surcharge"]
    assert rows(out) == [(1, None), (2, 2.5)]


def test_spellings_share_a_column(spark):
    a = spark.createDataFrame([(1, 1.25)], "id long, airport_fee double")
    b = spark.createDataFrame([(2, 1.75)], "ID long, Airport_fee double")
    out = unify_schemas([a, b])
    assert out.columns == ["id", "airport_fee"]
    assert rows(out) == [(1, 1.25), (2, 1.75)]


def test_both_spellings_in_one_frame(spark):
    both = spark.createDataFrame([(1.0, 9)], ["fee", "Fee"])
    other = spark.createDataFrame([(2,)], "FEE int")
    out = unify_schemas([both, other])
    assert out.dtypes == [("fee", "double")]
    assert rows(out) == [(1.0,), (2.0,)]


def test_nothing_to_unify():
    with pytest.raises(ValueError):
        unify_schemas([])


def test_first_seen_order():
    first = T.StructType().add("b", INT).add("A", INT)
    second = T.StructType().add("a", LONG).add("c", TEXT)
    assert [name for name, _ in reconcile([first, second]).values()] == ["b", "A", "c"]


def test_many_files_make_a_shallow_plan(spark):
    frames = [spark.range(i, i + 1).toDF(f"{'x' if i % 2 else 'X'}") for i in range(64)]
    out = unify_schemas(frames)
    assert out.agg(F.sum("X")).first()[0] == sum(range(64))


def test_renames_all_at_once(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["VendorID", "dropOff_datetime", "x"])
    assert snake_case_columns(df).columns == ["vendor_id", "drop_off_datetime", "x"]
    with pytest.raises(ValueError, match="vendor_id"):
        snake_case_columns(spark.createDataFrame([(1, 2)], ["VendorID", "vendor_id"]))
