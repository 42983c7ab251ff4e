"""Writing tables and their descriptions."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterable, Mapping, Sequence
from functools import reduce
from typing import Any
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.literals import literal


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")


def comment_statements(
    full_table: str, comments: Mapping[str, str], existing_columns: Iterable[str]
) -> list[str]:
    """DDL that describes the columns the table has, in the order of the descriptions."""
    available = set(existing_columns)
    quoted = {c: text.replace("'", "''") for c, text in comments.items() if c in available}
    return [
        f"ALTER TABLE {full_table} ALTER COLUMN {column} COMMENT '{text}'"
        for column, text in quoted.items()
    ]


def apply_comments(spark: SparkSession, full_table: str, comments: Mapping[str, str]) -> None:
    """Describe the columns of a stored table."""
    columns = spark.read.table(full_table).columns
    for statement in comment_statements(full_table, comments, columns):
        spark.sql(statement)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Carry descriptions in the schema, so that one write stores them all and no DDL per
    column is needed."""
    return df.select(
        *[
            F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, "comment": comments[f.name]})
            if f.name in comments
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def write_table(
    df: DataFrame,
    full_table: str,
    partition_by: Sequence[str] = (),
    comments: Mapping[str, str] | None = None,
    table_comment: str | None = None,
    rebalance: bool = False,
    max_records_per_file: int | None = None,
    observe: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Replace a table and its schema; partitioned by those of ``partition_by`` that exist.

    The rows go to a new folder beside the old one, and only when all are written does the
    catalog switch over: a write that fails leaves the table as it was, and its folder goes. Renaming a
    finished table instead would lose track of its partitions. With the schema it had, a table
    never leaves the catalog: its location, or the location of each partition, is set anew. Only a
    changed schema needs the entry dropped and created.

    Tasks write the partitions they meet, with no shuffle; that suits inputs in which months lie
    together. ``rebalance`` shuffles into evenly sized files first. Adaptive execution then
    splits a partition that holds a large part of the rows over many tasks, where a plain
    ``repartition`` on the partition columns would give it to one.

    ``observe`` names aggregates over the rows; they are computed by the write itself and returned.
    """
    spark = df.sparkSession
    layout = [c for c in partition_by if c in df.columns]
    described = with_comments(df, comments) if comments else df
    schema, _, table = full_table.rpartition(".")
    database = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase())
    folder = f"{database.locationUri.rstrip('/')}/{table}-{uuid.uuid4().hex}"
    found = _stage(described, folder, layout, rebalance, max_records_per_file, observe)
    before = table_folder(spark, full_table)
    if before and same_layout(spark, full_table, described.schema, layout):
        _switch_folder(spark, full_table, folder, layout)
        _describe_anew(spark, full_table, described.schema, table_comment)
    else:
        _create_anew(spark, full_table, described.schema, layout, folder, table_comment)
    if before:
        delete_folder(spark, before)
    return found


def replace_partitions(
    df: DataFrame,
    full_table: str,
    gone: Iterable[Mapping[str, Any]] = (),
    rebalance: bool = False,
    max_records_per_file: int | None = None,
) -> list[str]:
    """Replace those partitions of a stored table that ``df`` has rows of, and drop those in ``gone``;
    all other files stay as they are. Returns the partitions that were replaced.

    The rows go to a folder of their own inside the table's. Then one partition after the other is
    pointed to its new files, so whatever fails, every partition is either the old or the new one, and
    the same call again completes the work. Old files are deleted last."""
    spark = df.sparkSession
    layout = [c.name for c in spark.catalog.listColumns(full_table) if c.isPartition]
    stored = spark.read.table(full_table)
    if not layout or set(df.columns) != set(stored.columns):
        raise ValueError(f"{full_table} is not partitioned, or its columns differ")
    folder = f"{table_folder(spark, full_table)}/_{uuid.uuid4().hex}"
    typed = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in stored.schema])
    _stage(typed, folder, layout, rebalance, max_records_per_file, None)
    before = partition_folders(spark, full_table)
    new = staged_partitions(spark, folder, layout)
    for name, place in new.items():
        _point_partition(spark, full_table, name, place, name in before)
    wanted = {_partition_name(layout, spec) for spec in gone} - new.keys()
    for name in wanted & before.keys():
        run_step(spark, f"ALTER TABLE {full_table} DROP IF EXISTS PARTITION ({_partition_spec(name)})")
    spark.catalog.refreshTable(full_table)
    for name in before.keys() & (new.keys() | wanted):
        delete_folder(spark, before[name])
    return sorted(new)


def _stage(
    df: DataFrame,
    folder: str,
    layout: Sequence[str],
    rebalance: bool,
    max_records_per_file: int | None,
    observe: Mapping[str, Column] | None,
) -> dict[str, Any]:
    """Write rows to a folder; a write that fails leaves none. Returns what was observed."""
    observation = Observation() if observe else None
    if observation:
        df = df.observe(observation, *[column.alias(name) for name, column in observe.items()])
    if rebalance:
        df = df.hint("rebalance", *layout)
    writer = df.write
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if layout:
        writer = writer.partitionBy(*layout)
    try:
        writer.parquet(folder)
    except Exception:
        delete_folder(df.sparkSession, folder)
        raise
    return dict(observation.get) if observation else {}


def run_step(spark: SparkSession, statement: str) -> DataFrame:
    """One statement of a switch."""
    return spark.sql(statement)


def same_layout(spark: SparkSession, full_table: str, schema: T.StructType, layout: Sequence[str]) -> bool:
    """Whether a stored table has these columns, in this order and partitioned alike."""
    ordered = [f for f in schema if f.name not in layout] + [schema[name] for name in layout]
    stored = spark.read.table(full_table).schema
    parted = [c.name for c in spark.catalog.listColumns(full_table) if c.isPartition]
    return parted == list(layout) and [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in ordered]


def _switch_folder(spark: SparkSession, full_table: str, folder: str, layout: Sequence[str]) -> None:
    """Point a table to new files. Without partitions this is one step; with them, one per partition,
    and the table's own folder last, so that a run cut short can be repeated."""
    if layout:
        before = partition_folders(spark, full_table)
        new = staged_partitions(spark, folder, layout)
        for name, place in new.items():
            _point_partition(spark, full_table, name, place, name in before)
        for name in before.keys() - new.keys():
            run_step(spark, f"ALTER TABLE {full_table} DROP IF EXISTS PARTITION ({_partition_spec(name)})")
    run_step(spark, f"ALTER TABLE {full_table} SET LOCATION {literal(folder)}")
    spark.catalog.refreshTable(full_table)


def _create_anew(
    spark: SparkSession, full_table: str, schema: T.StructType, layout: Sequence[str], folder: str, comment: str | None
) -> None:
    """Drop and create the catalog entry. If creating it fails, the old entry comes back."""
    exists = spark.catalog.tableExists(full_table)
    old = run_step(spark, f"SHOW CREATE TABLE {full_table}").first()[0] if exists else None
    run_step(spark, f"DROP TABLE IF EXISTS {full_table}")
    try:
        run_step(spark, create_statement(full_table, schema, layout, folder, comment))
        if layout:
            run_step(spark, f"ALTER TABLE {full_table} RECOVER PARTITIONS")
    except Exception:
        if old:
            spark.sql(f"DROP TABLE IF EXISTS {full_table}")
            spark.sql(old)
            if "PARTITIONED BY" in old:
                spark.sql(f"ALTER TABLE {full_table} RECOVER PARTITIONS")
        raise


def _describe_anew(spark: SparkSession, full_table: str, schema: T.StructType, comment: str | None) -> None:
    """Descriptions that differ from the stored ones."""
    stored = {f.name: f.metadata.get("comment", "") for f in spark.read.table(full_table).schema}
    new = {f.name: f.metadata["comment"] for f in schema if "comment" in f.metadata}
    for column, text in new.items():
        if stored[column] != text:
            run_step(spark, f"ALTER TABLE {full_table} ALTER COLUMN `{column}` COMMENT {literal(text)}")
    if comment and spark.catalog.getTable(full_table).description != comment:
        run_step(spark, f"COMMENT ON TABLE {full_table} IS {literal(comment)}")


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _partition_name(layout: Sequence[str], spec: Mapping[str, Any]) -> str:
    """A partition as the catalog shows it: column=value/column=value."""
    return "/".join(f"{c}={NULL_PARTITION if spec[c] is None else quote(str(spec[c]), safe='')}" for c in layout)


def _partition_spec(name: str) -> str:
    """The same as it stands in a statement."""
    pairs = (part.split("=", 1) for part in name.split("/"))
    return ", ".join(f"`{c}` = {'NULL' if v == NULL_PARTITION else literal(unquote(v))}" for c, v in pairs)


def _point_partition(spark: SparkSession, full_table: str, name: str, place: str, exists: bool) -> None:
    spec = f"PARTITION ({_partition_spec(name)})"
    if exists:
        run_step(spark, f"ALTER TABLE {full_table} {spec} SET LOCATION {literal(place)}")
    else:
        run_step(spark, f"ALTER TABLE {full_table} ADD IF NOT EXISTS {spec} LOCATION {literal(place)}")


def staged_partitions(spark: SparkSession, folder: str, layout: Sequence[str]) -> dict[str, str]:
    """Partitions below a folder with their places, by listing one level of folders per column."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {"": folder}
    for column in layout:
        deeper = {}
        for name, place in found.items():
            path = hadoop.Path(place)
            for status in path.getFileSystem(conf).listStatus(path):
                last = status.getPath().getName()
                if status.isDirectory() and last.startswith(f"{column}="):
                    deeper[f"{name}/{last}".lstrip("/")] = status.getPath().toString()
        found = deeper
    return found


def partition_folders(spark: SparkSession, full_table: str) -> dict[str, str]:
    """The partitions of a stored table and where each is."""
    found = {}
    for (name,) in spark.sql(f"SHOW PARTITIONS {full_table}").collect():
        described = spark.sql(f"DESCRIBE EXTENDED {full_table} PARTITION ({_partition_spec(name)})")
        found[name] = described.filter("col_name = 'Location'").first()["data_type"]
    return found


def fingerprints(df: DataFrame, by: Sequence[str], ignore: Collection[str] = ()) -> DataFrame:
    """Rows per group with a sum of two hashes of all other columns, whatever their order."""
    content = sorted(c for c in df.columns if c not in ignore and c not in by)
    hashes = [
        F.sum(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in content]).cast("decimal(20, 0)")).alias(f"hash_{seed}")
        for seed in (0, 1)
    ]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *hashes)


def changed_groups(
    old: DataFrame, new: DataFrame, by: Sequence[str], ignore: Collection[str] = ()
) -> tuple[list[dict], list[dict]]:
    """Groups of ``new`` whose rows are not those of ``old``, and groups that only ``old`` has.

    Meant for partitions: the driver gets one row per group that differs."""
    before, after = (fingerprints(df, by, ignore) for df in (old, new))
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in by]
    equal = reduce(Column.__and__, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("n", "hash_0", "hash_1")])
    joined = before.alias("o").join(after.alias("n"), reduce(Column.__and__, same), "full").filter(~equal)
    there = F.col("n.n").isNotNull()
    rows = joined.select(*[F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in by], there.alias("__there"))
    changed, gone = [], []
    for row in rows.collect():
        (changed if row["__there"] else gone).append({c: row[c] for c in by})
    return changed, gone


def of_groups(df: DataFrame, groups: Sequence[Mapping[str, Any]]) -> DataFrame:
    """The rows of the given groups; values may be null."""
    if not groups:
        return df.limit(0)
    tests = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in group.items()]) for group in groups]
    return df.filter(reduce(Column.__or__, tests))


def write_changed(
    df: DataFrame,
    full_table: str,
    partition_by: Sequence[str],
    comments: Mapping[str, str] | None = None,
    ignore: Collection[str] = (),
    rebalance: bool = False,
) -> list[dict] | None:
    """Bring a partitioned table to the rows of ``df``, writing only partitions that differ from the
    stored ones, not counting columns in ``ignore``. None means the table was written whole, as it
    was not there or had another schema."""
    spark = df.sparkSession
    layout = [c for c in partition_by if c in df.columns]
    described = with_comments(df, comments) if comments else df
    if not layout or not table_folder(spark, full_table) or not same_layout(spark, full_table, described.schema, layout):
        write_table(df, full_table, partition_by, comments, rebalance=rebalance)
        return None
    changed, gone = changed_groups(spark.read.table(full_table), df, layout, ignore)
    if changed or gone:
        replace_partitions(of_groups(df, changed), full_table, gone, rebalance)
    _describe_anew(spark, full_table, described.schema, None)
    return changed + gone


def create_statement(
    full_table: str, schema: T.StructType, layout: Sequence[str], folder: str, comment: str | None
) -> str:
    """DDL of a table over a folder, partition columns last."""
    ordered = [f for f in schema if f.name not in layout] + [schema[name] for name in layout]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {literal(f.metadata['comment'])}" if "comment" in f.metadata else "")
        for f in ordered
    )
    parted = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in layout)})" if layout else ""
    described = f" COMMENT {literal(comment)}" if comment else ""
    return f"CREATE TABLE {full_table} ({columns}) USING parquet{parted} LOCATION {literal(folder)}{described}"


def table_folder(spark: SparkSession, full_table: str) -> str | None:
    """Where a table's files are; None without such a table."""
    if not spark.catalog.tableExists(full_table):
        return None
    rows = spark.sql(f"DESCRIBE EXTENDED {full_table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)
