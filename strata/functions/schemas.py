"""Schemas that grow."""

from __future__ import annotations

from pyspark.sql import types as T


def merged(known: T.DataType, found: T.DataType) -> T.DataType:
    """`known` with the fields, at any depth, that `found` has besides, as the last ones; else types stay as known."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        more = {f.name.lower(): f for f in found.fields}
        fields = []
        for f in known.fields:
            other = more.pop(f.name.lower(), None)
            fields.append(T.StructField(f.name, merged(f.dataType, other.dataType) if other else f.dataType, f.nullable, f.metadata))
        return T.StructType([*fields, *more.values()])
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merged(known.elementType, found.elementType), known.containsNull)
    if isinstance(known, T.MapType) and isinstance(found, T.MapType):
        return T.MapType(known.keyType, merged(known.valueType, found.valueType), known.valueContainsNull)
    return known
