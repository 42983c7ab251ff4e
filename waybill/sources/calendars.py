"""Generated rows: hours, days, months."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from waybill.functions.dates import days_between, months_between
from waybill.functions.literals import literal


def hours(spark: SparkSession) -> DataFrame:
    return spark.range(24).selectExpr("CAST(id AS INT) AS hour")


def months(spark: SparkSession, date_start: str, date_stop: str) -> DataFrame:
    """One row per month, ``year_month`` as YYYY-MM; none when the bounds are reversed."""
    bounds = spark.range(1).selectExpr(f"CAST({literal(date_start)} AS DATE) AS low", f"CAST({literal(date_stop)} AS DATE) AS high")
    return months_of(bounds)


def months_of(bounds: DataFrame) -> DataFrame:
    """Months of a one-row frame (low, high)."""
    month = bounds.selectExpr(f"explode({months_between('low', 'high')}) AS month")
    return month.selectExpr("date_format(month, 'yyyy-MM') AS year_month")


def date_bounds(inputs: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One row (low, high): first and last date of a column over several inputs.

    Each input is reduced to its own minimum and maximum first, so what is combined is
    one row per input. A distinct union of all dates would shuffle for nothing."""
    per_input = [
        df.selectExpr(
            f"CAST(min({column}) AS DATE) AS low", f"CAST(max({column}) AS DATE) AS high"
        )
        for df, column in inputs
    ]
    stacked = reduce(DataFrame.unionByName, per_input)
    return stacked.selectExpr("min(low) AS low", "max(high) AS high")


def days_of(bounds: DataFrame) -> DataFrame:
    """Days of a one-row frame (low, high), both included. The bounds are a row of the
    plan, so no driver round trip and no join is needed."""
    return bounds.selectExpr(f"explode({days_between('low', 'high')}) AS full_date")
