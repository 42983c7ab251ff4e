"""Contracts and completeness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import fixed_values as fv
from waybill.sources.inline import inline_values


def column_names(df: DataFrame) -> DataFrame:
    """Columns of a frame as rows, in lower case."""
    return inline_values(df.sparkSession, ("col",), [(c.lower(),) for c in df.columns])


def catalog_columns(spark: SparkSession, full_table: str) -> DataFrame:
    """Columns of a stored table as the catalog has them, in lower case."""
    return inline_values(spark, ("col",), [(c.name.lower(),) for c in spark.catalog.listColumns(full_table)])


def missing_columns(df: DataFrame, required: Sequence[str] = fv.CONTRACT_COLUMNS) -> DataFrame:
    return _missing_of(column_names(df), required)


def _missing_of(names: DataFrame, required: Sequence[str]) -> DataFrame:
    return inline_values(names.sparkSession, ("col",), [(c,) for c in required]).subtract(names)


def sorted_list(df: DataFrame, column: str) -> DataFrame:
    """All values of a small frame as one sorted, comma-separated text."""
    values = F.sort_array(F.collect_list(column))
    return df.agg(F.count(F.lit(1)).alias("n"), F.concat_ws(", ", values).alias("names"))


def column_contract(df: DataFrame, required: Sequence[str] = fv.CONTRACT_COLUMNS) -> DataFrame:
    """One row saying that every required column is there; fails when run if one is not."""
    return _verdict(missing_columns(df, required))


def stored_contract(spark: SparkSession, full_table: str, required: Sequence[str] = fv.CONTRACT_COLUMNS) -> DataFrame:
    """The same for a table as the catalog describes it, whatever its files hold."""
    return _verdict(_missing_of(catalog_columns(spark, full_table), required))


def _verdict(missing: DataFrame) -> DataFrame:
    broken = F.raise_error(F.concat(F.lit(fv.CONTRACT_BROKEN), F.col("names"))).cast("string")
    verdict = F.when(F.col("n") > 0, broken).otherwise(fv.CONTRACT_OK)
    return sorted_list(missing, "col").select(
        verdict.alias("consumption_contract")
    )


def landing_completeness(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Every expected month with its status, ``ingested`` or ``missing``.

    Both sides have one row per month."""
    here = landed.select("year_month").distinct().withColumn("here", F.lit(True))
    status = F.when(F.col("here"), "ingested").otherwise("missing").alias("status")
    return expected.join(here, "year_month", "left").select("year_month", status)


def missing_months(expected: DataFrame, landed: DataFrame) -> DataFrame:
    return expected.join(landed.select("year_month"), "year_month", "left_anti")
