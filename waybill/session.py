"""Session settings the operators rely on.

Only runtime SQL settings are touched, so they can be applied to a session somebody else
created. Executor sizes, dynamic allocation and the like stay with the cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SQL_SETTINGS: dict[str, str] = {
    # Source times are local wall-clock times; one fixed zone keeps the cast from
    # timestamp_ntz a no-op and lets date filters reach the Parquet reader.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: merges small shuffle partitions, switches to broadcast when a
    # side turns out small, splits hot join partitions and hot write partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


#: Stored bytes; decoded rows take about four times as much, and an aggregation is never split.
BYTES_PER_PARTITION = 64 * 1024 * 1024
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def shuffles_sized_for(spark: SparkSession, stored_bytes: int) -> Iterator[int]:
    """Within the block, shuffles start from enough partitions to move this many bytes.

    Adaptive execution merges and splits partitions but never starts from more than it is
    told, and a fixed number that suits an aggregation is far too small for whole records.
    Meant for one stage that shuffles records; results that aggregate to little should not
    pay for as many partitions."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = max(usual, math.ceil(stored_bytes / BYTES_PER_PARTITION))
    before = spark.conf.get(_INITIAL_PARTITIONS, None)
    spark.conf.set(_INITIAL_PARTITIONS, needed)
    try:
        yield needed
    finally:
        if before is None:
            spark.conf.unset(_INITIAL_PARTITIONS)
        else:
            spark.conf.set(_INITIAL_PARTITIONS, before)


def local_session(cores: int | str = "*", app: str = "waybill", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
