"""Queries against their SQL on given tables, and the contract of the entry."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from waybill.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def other_engine():
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, other_engine, name):
    assert difference(QUERIES[name](spark, SF), other_engine, ORACLE[name]) is None


def test_all_ten_and_the_pipeline_are_registered():
    found = contract.queries()
    assert [n for n in range(1, 11) if sum(q.startswith(f"op{n}_") for q in found) != 1] == []
    assert "pipeline" in found and ORACLE.keys() <= contract.oracle_sql().keys()


def test_keys_and_urls_against_sql(spark, tmp_path):
    line, short = "Ab3+" * 16, "xYz="
    head, foot = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    texts = [
        f"{head}\n{line}\n{line}\n{foot} after",
        f"a {head}\\n{line}\\n{foot}",
        f"{head}\nProc-Type: 4,ENCRYPTED\n\n{line}\n{short}\n  ",
        f"{head}\n{line}\nplain words follow",
        f"{head} {head}\n{line}",
        f"{head}\n--{line}-\n-- {foot}{foot}",
        f"{head}{line}-----",
        "see https://user:tok%20en@host and ftp://a:bcd@x or ://u:p\x0bqrst@y",
        None,
        "",
    ]
    rows = [(i, t, "en", f"s{i % 4}") for i, t in enumerate(texts * 2)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    df = QUERIES["op5_secret_scan"](spark, str(tmp_path))
    assert difference(df, connection, ORACLE["op5_secret_scan"]) is None
