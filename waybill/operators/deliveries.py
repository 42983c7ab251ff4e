"""Adding a delivery to what is stored, without the records that are there already."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators.bronze import deduplicate

#: Bits of the sketch: 16 MB, whatever the delivery. Bitmaps come in pieces of 4 KB.
SKETCH_BITS = 1 << 27
BUCKET, BITMAP, POSITION = "__bucket", "__bitmap", "__position"


def _position(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(bits))


def key_sketch(df: DataFrame, keys: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """A Bloom filter of one hash function, as bitmaps: which positions the keys of ``df`` take. At most
    ``bits`` / 32768 rows of 4 KB, so it may be broadcast."""
    position = _position(keys, bits)
    return df.groupBy(F.bitmap_bucket_number(position).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias(BITMAP)
    )


def may_be_in(df: DataFrame, keys: Sequence[str], sketch: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """The rows of ``df`` whose key the sketch may hold: all that it does hold, and a few others. ``df`` is
    not shuffled."""
    position = _position(keys, bits)
    byte = f"CAST(conv(hex(substring({BITMAP}, CAST({POSITION} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return (
        df.withColumns({BUCKET: F.bitmap_bucket_number(position), POSITION: F.bitmap_bit_position(position)})
        .join(F.broadcast(sketch), BUCKET)
        .filter(f"shiftright({byte}, CAST({POSITION} % 8 AS INT)) & 1 = 1")
        .select(*[f"`{c}`" for c in df.columns])
    )


def new_records(
    delivery: DataFrame, stored: DataFrame, keys: Sequence[str] | None = None, bits: int = SKETCH_BITS
) -> DataFrame:
    """Records of the delivery, once each, that are not stored: by ``keys``, or as full rows.

    The exact comparison is an anti-join on all key columns, nulls being equal. Of the stored table, which
    grows with every delivery, only rows that a sketch of the delivery lets through are shuffled for it."""
    compared = list(keys or delivery.columns)
    once = deduplicate(delivery, keys)
    known = stored.select(*[f"`{c}`" for c in compared])
    candidates = may_be_in(known, compared, key_sketch(delivery, compared, bits), bits)
    same = [F.col(f"new.`{c}`").eqNullSafe(F.col(f"old.`{c}`")) for c in compared]
    return once.alias("new").join(candidates.alias("old"), reduce(Column.__and__, same), "left_anti")
