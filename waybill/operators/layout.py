"""Rows laid out so that the statistics of Parquet files let readers skip most of them.

Sorting by one column narrows that column's range per file and leaves all others as wide as the table. A
space-filling order interleaves the bits of several columns, so each file covers a small box in all of
them, and a filter on any one column rules out most files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8


def place_in_range(column: str, low, high, bits: int = BITS) -> Column:
    """The value as a whole number of `bits` bits, evenly from `low` to `high`; NULL comes first."""
    if low is None or low == high:
        return F.lit(0)
    share = (F.col(column).cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.coalesce(F.least(F.floor(share * (1 << bits)), F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def interleaved(places: Sequence[Column], bits: int = BITS) -> Column:
    """One number whose bits are taken from the places in turn, the highest first."""
    n = len(places)
    value = F.lit(0).cast("long")
    for bit in range(bits):
        for i, place in enumerate(places):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long")
            value = value.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - i))
    return value


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The rows in `files` partitions along a space-filling order over numeric columns.

    One small job finds the columns' ranges. Rows that fall on one place are told apart by the columns
    themselves and a hash of the row, so a place that holds a large part of the rows is cut, too."""
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]).first()
    order = interleaved([place_in_range(c, ends[f"min_{c}"], ends[f"max_{c}"]) for c in columns])
    keys = [order, *[F.col(c) for c in columns], F.xxhash64(*df.columns)]
    return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
