"""Joins on keys that may hold a large part of all rows.

Adaptive execution splits a hot partition only where both sides of the join come out of a shuffle of
their own, and only above its size threshold. Here the split is in the plan: the rows of a hot key are
dealt over several parts, and the few rows it matches are repeated once per part. A row of the left side
is in exactly one part and meets all its matches there, so inner, left, semi and anti joins keep their
meaning. What is repeated is the right side's rows of hot keys, so that side should have few per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY, PARTS, PART = "__hot_key", "__hot_parts", "__hot_part"
#: Parts of a hot key per fair share of rows: several, as some of them meet in one task by chance.
PARTS_PER_SHARE = 4


def _key(on: Sequence[str]) -> Column:
    """A hash stands for the key: keys that collide are split alike, which changes no result."""
    return F.xxhash64(*on)


def rows_per_key(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The key columns and `n`, their rows; combined on the map side."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def hot_parts(counts: DataFrame, on: Sequence[str], n: str, rows: int, partitions: int) -> DataFrame:
    """Keys above a fair share of `rows` and the number of parts for each.

    There cannot be more of them than `partitions`, so they may be broadcast whatever the input."""
    share = max(1, -(-rows // partitions))
    return (
        counts.filter(F.col(n) > share)
        .groupBy(_key(on).alias(KEY))
        .agg(F.ceil(F.sum(n) * PARTS_PER_SHARE / F.lit(share)).cast("int").alias(PARTS))
    )


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    n: str = "n",
    rows: int | None = None,
    deal_by: Column | None = None,
) -> DataFrame:
    """`left` joined to `right` on equal columns, hot keys of `left` split.

    `counts` has the key columns and in `n` how many rows of `left` they have, about; it should be
    a stored table, as should `left` if it is to be counted here. `rows` is the number of rows
    of `left`. Hot rows are dealt by `deal_by`, a number that a repeated task finds again; by default
    a hash of all columns, which keeps rows that are equal throughout together."""
    on = list(on)
    spark = left.sparkSession
    counts = rows_per_key(left, on) if counts is None else counts
    if rows is None:
        rows = counts.agg(F.sum(n)).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_parts(counts, on, n, rows, partitions))
    cold = F.coalesce(F.col(PARTS), F.lit(1))
    dealt = (
        left.withColumn(KEY, _key(on))
        .join(hot, KEY, "left")
        .withColumn(PART, F.pmod(F.xxhash64(*left.columns) if deal_by is None else deal_by, cold).cast("int"))
        .drop(KEY, PARTS)
    )
    repeated = (
        right.withColumn(KEY, _key(on))
        .join(hot, KEY, "left")
        .withColumn(PART, F.explode(F.sequence(F.lit(0), cold - 1)))
        .drop(KEY, PARTS)
    )
    return dealt.join(repeated.hint("merge"), [*on, PART], how).drop(PART)
