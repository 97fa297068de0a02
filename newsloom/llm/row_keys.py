"""Telling rows of a table apart whose ids may be missing or repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

#: Columns of a key: the id and a hash of the whole row, and the same under other names.
ID, ROW = "_key_id", "_key_row"
#: The row itself, in one column, so that no other name of an operator can be one of its columns.
DOC = "_doc"


def unused(name: str, columns: Sequence[str]) -> str:
    """``name``, or longer, so that no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_row(columns: Sequence[str]) -> Column:
    """The columns as one, without their names."""
    return F.struct(F.lit(True).alias("row"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def from_row(columns: Sequence[str]) -> list[Column]:
    """The columns that ``as_row`` took in as ``DOC``."""
    return [F.col(DOC)[f"c{i}"].alias(c) for i, c in enumerate(columns)]


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, StructType) or all(_hashable(f.dataType) for f in kind.fields)


def _plain(df: DataFrame, name: str) -> Column:
    """A column, or its JSON where Spark has no hash for its type."""
    column = F.col(f"`{name}`")
    return column if _hashable(df.schema[name].dataType) else F.to_json(F.struct(column))


def packed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``df`` as ``DOC``, their keys, and ``_text``; no other columns. Only rows equal in every column share a key."""
    return df.select(
        as_row(df.columns).alias(DOC),
        F.col(f"`{doc_id}`").alias(ID),
        F.xxhash64(*[_plain(df, c) for c in df.columns]).alias(ROW),
        F.col(f"`{text}`").cast("string").alias("_text"),
    )


def renamed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({ID: f"{ID}2", ROW: f"{ROW}2"})


def same_key() -> Column:
    """Join condition between keyed rows and a ``renamed`` table."""
    return F.col(ID).eqNullSafe(F.col(f"{ID}2")) & (F.col(ROW) == F.col(f"{ROW}2"))
