"""Small column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by its exact name, also if the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_null(names) -> Column:
    return any_of([quoted(n).isNull() for n in names])


def row_digest(df: DataFrame) -> Column:
    """Hash of a row, to break ties the same way when a lost task is run again."""
    hashable = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(*[quoted(n) for n in hashable]) if hashable else F.lit(0)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return False


def recode(column: Column, codes: dict[str, str]) -> Column:
    """Replace some codes by others, keep the rest."""
    replaced = column
    for old, new in reversed(codes.items()):
        replaced = F.when(column == old, F.lit(new)).otherwise(replaced)
    return replaced


def check_tolerance(absolute: int, relative: float) -> None:
    if absolute < 0:
        raise ValueError(f"Absolute tolerance must not be negative: {absolute}")
    if math.isnan(relative) or not 0 <= relative <= 1:
        raise ValueError(f"Relative tolerance must be between 0.0 and 1.0: {relative}")


def equal_within(a: Column, b: Column, absolute: int = 0, relative: float = 0.0) -> Column:
    """Do two counts differ by no more than the larger of both tolerances?

    The relative tolerance is a share of the larger count. A negative count is an error.
    """
    check_tolerance(absolute, relative)
    allowed = F.greatest(F.lit(float(absolute)), F.greatest(a, b) * F.lit(float(relative)))
    return F.when(
        (a < 0) | (b < 0), F.raise_error(F.lit("Counts must not be negative")).cast("boolean")
    ).otherwise(F.abs(a - b) <= allowed)
