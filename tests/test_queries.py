"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.plans import parts_of
from checks.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def other_engine():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, other_engine, plan_of, name):
    df = QUERIES[name](spark, SF_DIR)
    parts = parts_of(plan_of(df))
    assert parts["python"] == parts["cartesian"] == 0
    assert difference(df, other_engine, ORACLE[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["service_type", "year", "month", "trips"]
    assert df.count() > 0
