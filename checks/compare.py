"""Run registered queries next to their SQL and compare all rows.

    python -m checks.compare SF_DIR [QUERY ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from checks.registry import ORACLE, QUERIES
from waybill.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


# fixed values: Spark type -> type name of the other engine
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if isinstance(value, bool) or value is None else str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and the same rows, else what differs."""
    result = connection.sql(sql)
    columns = result.columns
    expected = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {c: str(t) for c, t in zip(columns, result.types)}
    retyped = {c: (t, types[c]) for c, t in df.dtypes if SAME_TYPE.get(t) != types[c]}
    if retyped:
        return f"types {retyped}"
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if not expected:
        return "no rows"
    if actual == expected:
        return None
    extra, lacking = actual - expected, expected - actual
    return f"{extra.total()} extra, {lacking.total()} missing: {list(extra)[:2]} / {list(lacking)[:2]}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), connection, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
