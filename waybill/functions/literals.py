"""Values as SQL text."""

from __future__ import annotations


def literal(value) -> str:
    """A value that SQL reads back unchanged."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)
