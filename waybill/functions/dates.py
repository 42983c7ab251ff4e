"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waybill import fixed_values as fv
from waybill.functions.literals import literal


def _month_number(day: str) -> int:
    parsed = dt.date.fromisoformat(day)
    return parsed.year * 12 + parsed.month - 1


def month_list(date_start: str, date_stop: str) -> list[str]:
    """Months ``YYYY-MM`` from start to stop, both included; reversed bounds give none."""
    return [
        f"{n // 12:04d}-{n % 12 + 1:02d}"
        for n in range(_month_number(date_start), _month_number(date_stop) + 1)
    ]


def valid_window(date_start: str, date_stop: str) -> tuple[str, str]:
    """Validity window of an ingested period: the end is the first day of the month after
    the last ingested one, and is exclusive."""
    n = _month_number(date_stop) + 1
    return date_start, f"{n // 12:04d}-{n % 12 + 1:02d}-01"


def as_timestamp(df: DataFrame, name: str) -> str:
    """The column as a timestamp. Text that is no timestamp becomes NULL. A column that
    already holds times gets a plain cast, so filters on it still reach the scan."""
    temporal = isinstance(
        df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)
    )
    return f"{'cast' if temporal else 'try_cast'}(`{name}` AS TIMESTAMP)"


def date_key(when: str) -> str:
    """``yyyyMMdd`` as an int; NULL stays NULL. Integer arithmetic, no text formatting."""
    return f"CAST(year({when}) * 10000 + month({when}) * 100 + day({when}) AS INT)"


def duration_minutes(start: str, stop: str) -> str:
    """Whole minutes between two times, truncated toward zero; NULL beyond an int."""
    return f"try_cast((unix_timestamp({stop}) - unix_timestamp({start})) / 60 AS INT)"


def period_of_day(hour: str) -> str:
    *earlier, (_, last) = fv.DAY_PERIODS
    tests = " ".join(f"WHEN {hour} <= {high} THEN {literal(label)}" for high, label in earlier)
    return f"CASE {tests} ELSE {literal(last)} END"


def _steps(low: str, high: str, step: str) -> str:
    # sequence() fails on reversed bounds; those give no rows here
    return f"CASE WHEN {low} <= {high} THEN sequence({low}, {high}, INTERVAL 1 {step}) ELSE array() END"


def months_between(start: str, stop: str) -> str:
    """Array of first-of-month dates, both months included."""
    return _steps(f"trunc({start}, 'MM')", f"trunc({stop}, 'MM')", "MONTH")


def days_between(start: str, stop: str) -> str:
    """Array of dates, both days included."""
    return _steps(start, stop, "DAY")


def window_end(last_day: str) -> str:
    """Exclusive end of a validity window, as an expression over the last ingested day."""
    return f"add_months(trunc({last_day}, 'MM'), 1)"
