"""All subtotals of a set of labels, each from its smallest parent.

A cuboid is one choice of labels that are rolled up. Rolling up one more label only needs the sums of the
cuboid before it, so of 2^n cuboids none but the first reads the finest groups. Labels are rolled up one
after the other, those with most values first. A cuboid then comes from the one that still has its
last label, which is the one of its rolled-up labels with the fewest values: the smallest of its
possible parents. An expansion, in contrast, sends every finest group to all 2^n cuboids.

Every step is a stored table, so a lost executor costs the step it worked on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL = "grouping_id"


def rolling_order(finest: DataFrame, labels: Sequence[str]) -> list[str]:
    """Labels by falling number of values, counted in one job; the count only steers the work."""
    found = finest.agg(*[F.approx_count_distinct(label).alias(label) for label in labels]).first()
    return sorted(labels, key=lambda label: (-found[label], labels.index(label)))


def cuboids(
    finest: DataFrame, labels: Sequence[str], merge: Sequence[Column], keep: Callable[[DataFrame, str], DataFrame]
) -> list[DataFrame]:
    """Tables that hold all cuboids between them: `finest` with `grouping_id` 0, then one table per label with
    the cuboids of all tables before, this label rolled up. Bits of `grouping_id` are as GROUPING_ID
    gives them, the first label's the highest. `keep` stores a frame under a name and reads it back."""
    stored = keep(finest.withColumn(LEVEL, F.lit(0).cast("long")), "finest")
    tables, columns = [stored], stored.columns
    for label in rolling_order(stored, labels):
        others = [other for other in labels if other != label]
        bit = 1 << (len(labels) - 1 - list(labels).index(label))
        rolled = (
            reduce(DataFrame.unionAll, tables)
            .groupBy(*others, LEVEL)
            .agg(*merge)
            .withColumns(
                {label: F.lit(None).cast(stored.schema[label].dataType), LEVEL: (F.col(LEVEL) + bit).cast("long")}
            )
        )
        tables.append(keep(rolled.select(*columns), f"without-{label}"))
    return tables


def cube(
    finest: DataFrame, labels: Sequence[str], merge: Sequence[Column], keep: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """The rows that GROUP BY CUBE over `finest` gives, with `grouping_id`."""
    return reduce(DataFrame.unionAll, cuboids(finest, labels, merge, keep))
