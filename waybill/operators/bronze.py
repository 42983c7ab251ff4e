"""Bronze: a replica of the source, optionally deduplicated, plus the ingestion time."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _usable_keys(df: DataFrame, keys: Sequence[str] | None, strict: bool) -> list[str]:
    wanted = list(keys or ())
    present = [k for k in wanted if k in df.columns]
    if len(present) < len(wanted):
        absent = ", ".join(k for k in wanted if k not in df.columns)
        if strict:
            raise ValueError(f"deduplication keys not in the data: {absent}")
        warnings.warn(f"deduplication ignores absent keys: {absent}", stacklevel=3)
    return present


def deduplicate(df: DataFrame, subset: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """One row per key, or per full row without (existing) keys.

    Full rows go through a hash aggregate on all columns; copies collapse inside each map
    task before the shuffle, so a group holding a large part of all rows leaves at most one
    row per task. By key, a rank filter keeps one whole record and drops the others before the
    shuffle; an aggregate would carry every column with a flag of its own through two sorts.
    Which row of a key survives is arbitrary. Keys the data lacks are ignored with a warning,
    or refused with ``strict``.
    """
    keys = _usable_keys(df, subset, strict)
    return deduplicate_first(df, keys, [F.col(f"`{k}`") for k in keys]) if keys else df.dropDuplicates()


def deduplicate_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, always the first in the given order: reproducible across runs.

    A rank filter of one is pushed below the shuffle (window group limit), so every map
    task forwards at most one row per key, however hot the key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def add_ingestion_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("dt_ingestion", F.current_timestamp())


def build_bronze(
    df: DataFrame, dedup: bool = True, dedup_keys: Sequence[str] | None = None, strict: bool = False
) -> DataFrame:
    """All source columns and ``dt_ingestion``. ``dedup=False`` avoids the only shuffle."""
    if dedup:
        df = deduplicate(df, dedup_keys, strict)
    return add_ingestion_ts(df)
