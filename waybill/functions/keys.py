"""Keys of the fact rows."""

from __future__ import annotations

# fixed values: the approximate natural key of a trip, in hashing order
NATURAL_KEY = ("service_type", "vendor_id", "pu_location_id", "do_location_id")
NATURAL_KEY_TIMES = ("pickup_datetime", "dropoff_datetime")


def unknown_member(key: str, unknown: int) -> str:
    return f"CAST(COALESCE({key}, {unknown}) AS INT)"


def sequential_key() -> str:
    """Unique within one write, not stable across runs; costs no shuffle."""
    return "monotonically_increasing_id()"


def natural_key() -> str:
    """128-bit hash of the natural key. A missing part hashes as empty text in its own place."""
    parts = [f"CAST({c} AS STRING)" for c in NATURAL_KEY]
    parts += [f"CAST(unix_micros({c}) AS STRING)" for c in NATURAL_KEY_TIMES]
    return "md5(concat_ws('|', " + ", ".join(f"COALESCE({p}, '')" for p in parts) + "))"
