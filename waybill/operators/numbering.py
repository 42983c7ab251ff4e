"""Numbers without gaps over any number of rows, from prefix sums of partitions.

The rows are range-partitioned and sorted, so a row's number is its place in its partition plus
the rows of all partitions before. Only one count per partition is summed up in one place."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE, BEFORE, TASK = "__place", "__before", "__task"
#: monotonically_increasing_id keeps the row's place in the lower bits, its partition in the upper.
PLACE_BITS = 33


def with_running_sums(
    df: DataFrame,
    order_by: Sequence[Column],
    value: str,
    name: str,
    keep: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Adds `name`: the sum of `value` over all rows before this one in the given order, which should tell
    all rows apart. Each range's own sums are one task's, so a range should hold no more than a task does."""
    stored = keep(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn(PLACE, F.monotonically_increasing_id())
    ).withColumn(TASK, F.shiftright(PLACE, PLACE_BITS))
    earlier = Window.orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        stored.groupBy(TASK)
        .agg(F.sum(value).alias("rows"))
        .select(TASK, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(BEFORE))
    )
    within = Window.partitionBy(TASK).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.withColumn(name, F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(F.broadcast(before), TASK)  # one row per partition
        .withColumn(name, F.col(BEFORE) + F.col(name))
        .drop(TASK, BEFORE, PLACE)
    )


def with_row_numbers(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str,
    keep: Callable[[DataFrame], DataFrame],
    first: int = 0,
) -> DataFrame:
    """Adds `name`: the row's number in the given order, from `first` on.

    `keep` stores a frame and reads it back: the numbers rest on one partitioning, which must not be
    computed twice. Rows equal in the order are told apart by their place in the input, so that a
    range can be cut inside a group of them, however large; so `df` should come off stored tables without
    a shuffle, where a repeated task finds every row in its place again."""
    within = "__arrival"
    ordered = [*order_by, F.col(within)]
    stored = keep(
        df.withColumn(within, F.monotonically_increasing_id())
        .repartitionByRange(*ordered)
        .sortWithinPartitions(*ordered)
        .drop(within)
        .withColumn(PLACE, F.monotonically_increasing_id())
    )
    task = F.shiftright(PLACE, PLACE_BITS)
    earlier = Window.orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        stored.groupBy(task.alias(TASK))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(TASK, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(BEFORE))
    )
    place = F.col(PLACE).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        stored.withColumn(TASK, task)
        .join(F.broadcast(before), TASK)  # one row per partition
        .withColumn(name, F.col(BEFORE) + place + F.lit(first))
        .drop(TASK, BEFORE, PLACE)
    )
