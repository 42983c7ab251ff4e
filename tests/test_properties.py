"""Random inputs against plain Python."""

import datetime as dt
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from waybill.functions.dates import month_list, valid_window
from waybill.functions.names import to_snake_case
from waybill.operators.bronze import deduplicate, deduplicate_first
from waybill.operators.schema import promote_type, reconcile
from waybill.operators.silver import filter_valid_dates

TYPES = st.sampled_from(
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
     T.DecimalType(9, 2), T.DecimalType(20, 4), T.StringType(), T.DateType(), T.BooleanType()]
)


@given(st.lists(TYPES, min_size=1, max_size=6), st.randoms())
def test_promotion_ignores_order_and_repetition(types, rng):
    shuffled = types + types[:2]
    rng.shuffle(shuffled)
    assert promote_type(shuffled) == promote_type(types)


@given(st.lists(st.lists(st.sampled_from(["a", "A", "b", "B", "c"]), max_size=4), min_size=1, max_size=4))
def test_reconciled_columns(files):
    schemas = [T.StructType([T.StructField(n, T.LongType()) for n in names]) for names in files]
    spellings = [name for name, _ in reconcile(schemas).values()]
    seen = [n for names in files for n in names]
    assert [s.lower() for s in spellings] == list(dict.fromkeys(n.lower() for n in seen))
    assert all(s == next(n for n in seen if n.lower() == s.lower()) for s in spellings)


@given(st.text(alphabet="abXYZ09_", max_size=12))
def test_standard_names_are_stable(name):
    standard = to_snake_case(name)
    assert standard == standard.lower() and to_snake_case(standard) == standard
    assert standard.replace("_", "") == name.replace("_", "").lower()


DAYS = st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31))


@given(DAYS, DAYS)
def test_months_cover_the_window(start, stop):
    listed = month_list(str(start), str(stop))
    days = (stop - start).days
    expected = sorted({str(start + dt.timedelta(n))[:7] for n in range(days + 1)})
    assert listed == (expected if days >= 0 else listed)
    _, end = valid_window(str(start), str(stop))
    last = dt.date.fromisoformat(end) - dt.timedelta(1)
    assert (last.year, last.month) == (stop.year, stop.month)


def _moment(rng):
    return None if rng.random() < 0.1 else dt.datetime(2023, 1, 1) + dt.timedelta(hours=rng.randint(-200, 400))


def test_date_filter_against_python(spark):
    rng = random.Random(7)
    trips = [(i, _moment(rng), _moment(rng)) for i in range(2000)]
    start, end = dt.datetime(2023, 1, 2), dt.datetime(2023, 1, 12)
    expected = [
        (i,)
        for i, up, off in trips
        if up is not None and start <= up < end and (off is None or off >= up)
    ]
    df = spark.createDataFrame(trips, "id int, pickup_datetime timestamp, dropoff_datetime timestamp")
    kept = filter_valid_dates(df, "2023-01-02", "2023-01-12")
    assert sorted(rows(kept, "id")) == expected


def test_deduplication_against_python(spark):
    rng = random.Random(11)
    data = [(rng.randint(0, 40), rng.choice("xyz"), rng.randint(0, 3)) for _ in range(3000)]
    df = spark.createDataFrame(data, "k int, s string, v int").repartition(7)
    assert sorted(map(tuple, deduplicate(df).collect())) == sorted(set(data))
    by_key = sorted(map(tuple, deduplicate(df, ["k", "s"]).collect()))
    assert [r[:2] for r in by_key] == sorted({r[:2] for r in data}) and set(by_key) <= set(data)
    first = sorted(map(tuple, deduplicate_first(df, ["k"], [F.col("v"), F.col("s")]).collect()))
    assert first == sorted(min((r for r in data if r[0] == k), key=lambda r: (r[2], r[1])) for k in {r[0] for r in data})
