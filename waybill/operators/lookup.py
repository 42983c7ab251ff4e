"""Looking up dimension rows by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.sources.inline import inline_values

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
_FIXED_BYTES = 8


@dataclass(frozen=True)
class Dimension:
    """A frame with one row per ``key``. ``rows`` and ``size`` are its counted rows and bytes;
    None means nobody counted, and then it is never broadcast by hint."""

    frame: DataFrame
    key: str
    rows: int | None = None
    size: int | None = None

    @property
    def broadcastable(self) -> bool:
        if self.rows is None or self.size is None:
            return False
        return self.rows <= BROADCAST_ROWS and self.size <= BROADCAST_BYTES

    def keyed_by(self, key: str) -> Dimension:
        """The same rows, looked up by another column."""
        return replace(self, key=key)


def row_bytes(schema: T.StructType) -> str | None:
    """The bytes of a row as an expression; None if a column can hold any number of values."""
    sizes = [str(_FIXED_BYTES * len(schema))]
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(f"COALESCE(octet_length(`{field.name}`), 0)")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return None
    return " + ".join(sizes)


def literal_dimension(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple], key: str) -> Dimension:
    size = sum(_FIXED_BYTES + len(str(value).encode()) for row in rows for value in row)
    return Dimension(inline_values(spark, columns, rows), key, len(rows), size)


def measured(frame: DataFrame, key: str) -> Dimension:
    """Count a frame's rows and bytes and make sure its key is unique.

    One job, aggregated on the executors; the driver gets one row. A repeated key would
    multiply the rows that look it up, so it is refused."""
    width = row_bytes(frame.schema)
    bytes_of_rows = F.expr(f"sum(CAST({width} AS BIGINT))") if width else F.lit(None).cast("long")
    per_key = frame.groupBy(key).agg(F.count(F.lit(1)).alias("n"), bytes_of_rows.alias("bytes"))
    found = per_key.agg(
        F.sum("n").alias("rows"),
        F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("most"),
        F.sum("bytes").alias("bytes"),
    ).first()
    if (found["most"] or 0) > 1:
        raise ValueError(f"dimension key {key} is not unique")
    return Dimension(frame, key, found["rows"] or 0, (found["bytes"] or 0) if width else None)


def lookup(
    df: DataFrame,
    dimension: Dimension,
    on: str,
    take: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Add ``take`` (dimension column -> new name) from the row whose key equals the
    expression ``on``.

    A dimension of proven small size is broadcast: the facts are not shuffled, so a key
    that holds a large part of them costs nothing extra. A larger one is joined by
    shuffling, where adaptive execution splits hot partitions of the fact side (the other
    side has one row per key and cannot be skewed). ``left`` keeps rows without a match."""
    key = "__lookup_key"
    side = dimension.frame.selectExpr(
        f"{dimension.key} AS {key}", *[f"{c} AS {name}" for c, name in take.items()]
    )
    if dimension.broadcastable:
        side = F.broadcast(side)
    return df.join(side, F.expr(f"{on} = {key}"), how).drop(key)
