import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from waybill.session import local_session

    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """Physical plan of a frame as text."""

    def text(df, executed=False):
        if executed:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple(str(v) for v in r))
