"""Adding newly declared columns to archived rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.contracts import DEFAULT, TableContract


class BackfillError(Exception):
    """The archive cannot be brought to the contract."""


def backfill(df: DataFrame, contract: TableContract) -> DataFrame:
    """Add absent columns: null if nullable, else the contract's default.

    An absent required column without a default is an error. The caller checks for empty results
    (see :func:`cdclake.plans.jobs.archive_backfill`).
    """
    absent = [f for f in contract.schema.fields if f.name not in df.columns]
    lacking = [f.name for f in absent if not f.nullable and DEFAULT not in (f.metadata or {})]
    if lacking:
        raise BackfillError(
            f"Mandatory columns {lacking} of {contract.full_name} do not exist in the archived data"
        )
    added = {}
    for field in absent:
        value = None if field.nullable else field.metadata[DEFAULT]
        if value is not None and not isinstance(value, str):
            raise BackfillError(f"Default of {contract.full_name}.{field.name} is not text: {value!r}")
        added[field.name] = F.lit(value).cast(field.dataType)
    return df.withColumns(added) if added else df
