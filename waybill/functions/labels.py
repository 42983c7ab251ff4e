"""Code labels and flags."""

from __future__ import annotations

from collections.abc import Mapping

from waybill.functions.literals import literal


def code_label(column: str, names: Mapping) -> str:
    """The label of a code; NULL for an unknown or missing code.

    Numeric codes compare as numbers, so 2, 2.0 and '2' share a label while 2.5 and 'x'
    have none. A literal CASE stays inside generated code; no join is needed."""
    if not names:
        return "CAST(NULL AS STRING)"
    if isinstance(next(iter(names)), str):
        value, keys = f"CAST(`{column}` AS STRING)", [literal(key) for key in names]
    else:
        value, keys = f"try_cast(`{column}` AS DOUBLE)", [f"{key}D" for key in names]
    known = " ".join(f"WHEN {key} THEN {literal(name)}" for key, name in zip(keys, names.values()))
    return f"CASE {value} {known} END"


def yes_no(column: str) -> str:
    """Y -> true, N -> false (any case, surrounding blanks ignored), anything else NULL."""
    letter = f"upper(trim(CAST(`{column}` AS STRING)))"
    return f"CASE {letter} WHEN 'Y' THEN true WHEN 'N' THEN false END"
