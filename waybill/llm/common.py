"""What the operators share: column choice, the shared folder, chunking, worker caches."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators.staging import Shelf, shared_folder  # noqa: F401

#: ASCII white space, as a character class for Java and Python patterns alike.
SPACES = r"[\x20\x09-\x0D]"
NON_SPACES = r"[^\x20\x09-\x0D]"
WORD = re.compile(NON_SPACES + "+")
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others.

    Other columns may repeat a name or differ from it in case only; the first column of
    exactly this name counts."""
    at = {name: df.columns.index(name) for name in names}
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return plain.select(*(plain[f"_c{i}"].alias(name) for name, i in at.items()))


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def id_remainder(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo `modulus`; a null id counts as empty text."""
    as_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % modulus


def worker_cache(name: str) -> dict:
    """A dict that lives as long as this Python process, whatever task runs in it. Functions
    shipped by value have fresh module globals in every task, so those cannot serve."""
    return sys.__dict__.setdefault("_waybill_cache", {}).setdefault(name, {})


def text_chunks(batch: pa.RecordBatch, column: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes of text each, one row at least."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n + 1
    if batch.num_rows > start:
        yield batch.slice(start)
