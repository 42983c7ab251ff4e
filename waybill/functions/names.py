"""Column-name helpers. They run once on the driver, over names only."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from waybill import fixed_values as fv
from waybill.spec import RECORD_TYPES

# A word starts at an upper-case letter that follows a lower-case letter or digit, or at
# an upper-case letter that is itself followed by a lower-case one (end of an acronym).
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])")


def to_snake_case(name: str) -> str:
    """``VendorID`` -> ``vendor_id``, ``dropOff_datetime`` -> ``drop_off_datetime``."""
    if name in fv.NAME_OVERRIDES:
        return fv.NAME_OVERRIDES[name]
    words = _WORD_START.sub("_", name).split("_")
    return "_".join(word for word in words if word).lower()


def first_present(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column (exact case), or None."""
    available = set(columns)
    for candidate in candidates:
        if candidate in available:
            return candidate
    return None


def detect_pickup_col(columns: Iterable[str], candidates: Sequence[str] | None = None) -> str | None:
    return first_present(columns, candidates or fv.PICKUP_COLUMNS)


def detect_dropoff_col(columns: Iterable[str], candidates: Sequence[str] | None = None) -> str | None:
    return first_present(columns, candidates or fv.DROPOFF_COLUMNS)


def comments_for(taxi_type: str) -> dict[str, str]:
    """Descriptions of the published columns of a record type; unknown type -> none."""
    record_type = RECORD_TYPES.get(taxi_type)
    return dict(record_type.comments) if record_type else {}


def silver_comments_for(taxi_type: str) -> dict[str, str]:
    """Descriptions of the silver columns: published ones under their snake_case name,
    then derived columns, labels and flags, where the later description wins."""
    published = {to_snake_case(c): text for c, text in comments_for(taxi_type).items()}
    return (
        published
        | fv.SILVER_DERIVED_COMMENTS
        | fv.SILVER_LABEL_COMMENTS
        | fv.SILVER_FLAG_COMMENTS
    )
