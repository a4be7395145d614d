"""Shape of rows written to the relational mirror."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import OP, SEQUENCE, TIMESTAMP
from cdclake.functions.columns import quoted


def mirror_shape(df: DataFrame, keep_op: bool = False) -> DataFrame:
    """Lower-case names, no U+0000 in text, no metadata columns (a merge keeps ``op``)."""
    dropped = {TIMESTAMP.lower(), SEQUENCE.lower()}
    if not keep_op:
        dropped.add(OP.lower())
    columns = []
    for field in df.schema.fields:
        name = field.name.lower()
        if name in dropped:
            continue
        value = quoted(field.name)
        if isinstance(field.dataType, T.StringType):
            value = F.translate(value, "\0", "")
        columns.append(value.alias(name))
    return df.select(*columns)
