"""Reconciling schemas that drift from file to file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.names import to_snake_case

# fixed values: what holds the values of what; a type's supertypes are the rest of its row
_CHAIN = ("tinyint", "smallint", "int", "bigint", "float", "double", "string")


def _supertypes(name: str) -> tuple[str, ...]:
    """A type and all that can stand in for it, nearest first."""
    if name in _CHAIN:
        return _CHAIN[_CHAIN.index(name) :]
    return (name, "double", "string") if name.startswith("decimal") else (name, "string")


def common_type(one: str, other: str) -> str:
    """The nearest supertype of two types: their join in the lattice."""
    shared = set(_supertypes(other))
    return next(name for name in _supertypes(one) if name in shared)


def promote_type(types: Sequence[T.DataType]) -> T.DataType:
    """The one type of a column that several files type differently: the join of them all, in
    whatever order. Spark's own union coercion answers some of these differently (for instance
    long + float), so it is decided here and applied by cast."""
    known = {t.simpleString(): t for t in types} | {"double": T.DoubleType(), "string": T.StringType()}
    return known[reduce(common_type, (t.simpleString() for t in types))]


def reconcile(schemas: Sequence[T.StructType]) -> dict[str, tuple[str, T.DataType]]:
    """Common columns of several schemas: lower-case name -> (spelling, type), where the
    first spelling seen wins and columns keep the order in which they first appear."""
    spelling: dict[str, str] = {}
    seen: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for column in schema:
            spelling.setdefault(column.name.lower(), column.name)
            seen.setdefault(column.name.lower(), []).append(column.dataType)
    return {key: (name, promote_type(seen[key])) for key, name in spelling.items()}


def align(df: DataFrame, target: dict[str, tuple[str, T.DataType]]) -> DataFrame:
    """Project a frame onto the common columns; a column it lacks is a typed NULL.

    Columns are addressed by position, because a frame may hold two spellings of one name,
    which Spark could not tell apart; the first of them is used."""
    position: dict[str, str] = {}
    for index, name in enumerate(df.columns):
        position.setdefault(name.lower(), f"_{index}")
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])

    def source(key: str, data_type: T.DataType):
        column = F.col(position[key]) if key in position else F.lit(None)
        return column.cast(data_type)

    return numbered.select(*[source(k, t).alias(name) for k, (name, t) in target.items()])


def balanced_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of equally shaped frames as a balanced tree. A left-deep chain over hundreds
    of files makes a plan deep enough to overflow the analyzer's stack."""
    level = list(frames)
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2])
        level = [a.unionByName(b) for a, b in pairs] + (level[-1:] if len(level) % 2 else [])
    return level[0]


def unify_schemas(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose schemas differ in types, in missing columns or in the case of
    column names."""
    if not dfs:
        raise ValueError("unify_schemas needs at least one DataFrame")
    target = reconcile([df.schema for df in dfs])
    return balanced_union([align(df, target) for df in dfs])


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case and drop none, in one positional rename."""
    names = [to_snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a snake_case name: {', '.join(clashes)}")
    return df if names == df.columns else df.toDF(*names)
