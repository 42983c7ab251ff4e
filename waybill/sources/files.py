"""Monthly source files and the zone CSV."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.dates import month_list
from waybill.operators.schema import align, balanced_union, reconcile, snake_case_columns

_SCHEMA_READERS = 16


def monthly_paths(root: str, taxi_type: str, date_start: str, date_stop: str) -> list[str]:
    return [
        f"{root}/{taxi_type}_tripdata_{month}.parquet" for month in month_list(date_start, date_stop)
    ]


def read_monthly(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read files whose schemas drift, as one frame.

    Same result as reading every file alone and unifying them, but files that share a
    schema become one scan: the plan grows with the number of distinct schemas, not with
    the number of months, and Spark packs small files into common tasks. Only schemas
    (Parquet footers) are looked at on the driver, several at a time.
    """
    if not paths:
        raise ValueError("read_monthly needs at least one path")
    with ThreadPoolExecutor(_SCHEMA_READERS) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    target = reconcile(schemas)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in zip(paths, schemas):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    scans = [
        align(spark.read.schema(schema).parquet(*members), target)
        for schema, members in groups.values()
    ]
    return balanced_union(scans)


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Size of the files, from the file listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select(F.sum("length")).first()[0] or 0


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header: every column as text, snake_case names, then the id
    as an int (text that is no number becomes NULL)."""
    zones = snake_case_columns(spark.read.csv(path, header=True, inferSchema=False))
    return zones.withColumn("location_id", F.expr("try_cast(location_id AS INT)"))


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table if the catalog has it, else None."""
    return spark.read.table(name) if spark.catalog.tableExists(name) else None


def landed_months(spark: SparkSession, root: str, taxi_type: str) -> DataFrame:
    """Months with a non-empty file in the landing folder, or a folder of files by that name.
    The listing reads names and lengths only; the ``content`` column is pruned away."""
    pattern = rf"/{taxi_type}_tripdata_(\d{{4}}-\d{{2}})\.parquet(?:/[^/]*)?$"
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return (
        files.filter(F.col("length") > 0)
        .select(F.regexp_extract("path", pattern, 1).alias("year_month"))
        .filter(F.col("year_month") != "")
        .distinct()
    )
