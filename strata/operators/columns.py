"""Small helpers for columns addressed by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """The column with exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def named_all(names: Iterable[str]) -> list[Column]:
    return [named(name) for name in names]


def holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(holds_map(field.dataType) for field in kind.fields)
    return False


def comparable(df: DataFrame, name: str) -> Column:
    """The column in a form Spark can order and compare. Maps have neither, so they turn
    into their JSON text."""
    column = named(name)
    if holds_map(df.schema[name].dataType):
        return F.to_json(F.struct(column))
    return column
