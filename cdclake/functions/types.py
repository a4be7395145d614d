"""Column types of stored tables: what holds both old and new values, and values brought to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDER = [
    {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3},
    {T.FloatType: 0, T.DoubleType: 1},
]


class SchemaConflict(TypeError):
    """New values do not fit into a stored column."""


def nullable(kind: T.DataType) -> T.DataType:
    """The type with everything in it nullable."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind


def _fits(narrow: T.DataType, wide: T.DataType) -> bool:
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        return narrow.scale <= wide.scale and narrow.precision - narrow.scale <= wide.precision - wide.scale
    return any(rank.get(type(narrow), 9) < rank.get(type(wide), -1) for rank in _WIDER)


def merged_type(stored: T.DataType, added: T.DataType, name: str) -> T.DataType:
    """The stored type with the fields that structs in it have gained; refuses values it cannot hold."""
    stored, added = nullable(stored), nullable(added)
    if stored == added or _fits(added, stored):
        return stored
    if isinstance(stored, T.StructType) and isinstance(added, T.StructType):
        known = {f.name: f.dataType for f in added.fields}
        fields = [
            T.StructField(f.name, merged_type(f.dataType, known[f.name], f"{name}.{f.name}") if f.name in known else f.dataType)
            for f in stored.fields
        ]
        return T.StructType([*fields, *[f for f in added.fields if f.name not in stored.names]])
    if isinstance(stored, T.ArrayType) and isinstance(added, T.ArrayType):
        return T.ArrayType(merged_type(stored.elementType, added.elementType, f"{name}.element"))
    if isinstance(stored, T.MapType) and isinstance(added, T.MapType):
        return T.MapType(
            merged_type(stored.keyType, added.keyType, f"{name}.key"), merged_type(stored.valueType, added.valueType, f"{name}.value"))
    raise SchemaConflict(f"Column {name} is {added.simpleString()}, stored as {stored.simpleString()}")


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Values of one type as another that :func:`merged_type` gave for it."""
    have, want = nullable(have), nullable(want)
    if have == want:
        return value
    if isinstance(want, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [
            (conform(value.getField(f.name), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: conform(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: conform(v, have.valueType, want.valueType))
    return value.cast(want)
