"""Literal relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from waybill.functions.literals import literal


def inline_values(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """``VALUES`` rows. Unlike ``createDataFrame`` on a Python list this is a local relation
    with exact statistics: no Python worker, and Catalyst knows how small it is."""
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
