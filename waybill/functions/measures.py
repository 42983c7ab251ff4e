"""Additive measures.

A measure is kept as sums and a non-null count until the very end, so partial results can be
merged in any order and an average is never an average of averages.

Sums of doubles depend on the order in which partitions arrive, which changes from run to run
on a cluster and whenever a task is retried. Values are therefore added as decimals, with more
digits behind the point than amounts have, and no row is rounded to cents. What a decimal
cannot hold (NaN, infinities, absurd sizes) is added up beside them and joins at the end, so
such rows give what a plain sum gives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

#: digits behind the point; 18 before it, and 10^10 times as much in a sum
SCALE = 10


def as_decimal(value: str) -> str:
    return f"try_cast({value} AS DECIMAL(28, {SCALE}))"


def not_decimal(value: str) -> str:
    """The value if a decimal cannot hold it, else NULL."""
    return f"CASE WHEN {as_decimal(value)} IS NULL THEN CAST({value} AS DOUBLE) END"


def both(exact: str, beside: str) -> str:
    """The double that a decimal sum and a sum of what does not fit make together."""
    return (
        f"CASE WHEN {beside} IS NULL THEN CAST({exact} AS DOUBLE) "
        f"ELSE COALESCE(CAST({exact} AS DOUBLE), 0D) + {beside} END"
    )


@dataclass(frozen=True)
class Measure:
    """A column to average and/or add up. ``whole`` marks integers and booleans, whose
    sums are exact as they are."""

    column: str
    average: str | None = None
    total: str | None = None
    whole: bool = False

    @property
    def sum_name(self) -> str:
        return f"`{self.column}__sum`"

    @property
    def beside_name(self) -> str:
        return f"`{self.column}__beside`"

    @property
    def count_name(self) -> str:
        return f"`{self.column}__count`"

    def _sums_of_rows(self) -> dict[str, str]:
        value = f"`{self.column}`"
        if self.whole:
            return {self.sum_name: f"sum(CAST(CAST({value} AS INT) AS BIGINT))"}
        return {self.sum_name: f"sum({as_decimal(value)})", self.beside_name: f"sum({not_decimal(value)})"}

    def count_of_rows(self) -> str:
        return f"count(`{self.column}`)"

    def partial(self) -> list[str]:
        """Aggregates over rows."""
        sums = [f"{sql} AS {name}" for name, sql in self._sums_of_rows().items()]
        return [*sums, f"{self.count_of_rows()} AS {self.count_name}"]

    def merged(self) -> list[str]:
        """Aggregates over partial aggregates."""
        return [f"sum({name}) AS {name}" for name in (*self._sums_of_rows(), self.count_name)]

    def _value(self, sums: Sequence[str]) -> str:
        return sums[0] if self.whole else both(*sums)

    def finished(self) -> list[str]:
        """Output columns from merged aggregates."""
        summed = self._value(list(self._sums_of_rows()))
        out = []
        if self.average:
            parts = f"CAST({summed} AS DOUBLE), CAST({self.count_name} AS DOUBLE)"
            out.append(f"try_divide({parts}) AS `{self.average}`")
        if self.total:
            out.append(f"{summed} AS `{self.total}`")
        return out

    def total_in_one(self) -> str:
        """The total as a single aggregate expression."""
        return self._value(list(self._sums_of_rows().values()))

    def average_in_one(self) -> str:
        """The average as a single aggregate expression."""
        return (
            f"try_divide(CAST({self.total_in_one()} AS DOUBLE), "
            f"CAST({self.count_of_rows()} AS DOUBLE))"
        )


def coalesced_sum(columns: Sequence[str]) -> str:
    """Sum of several columns, a missing component counting as zero."""
    return " + ".join(f"COALESCE(`{column}`, 0)" for column in columns)


def share_of_total(count: str, total: str) -> str:
    """Percentage with two decimals, in decimal arithmetic."""
    return f"ROUND(100.0 * {count} / {total}, 2)"
