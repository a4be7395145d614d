"""Row and schema checks of a batch of change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import (
    DELETE, ERROR, OP, VALIDATION_TYPE, TableContract, schemas_match, with_metadata,
)
from cdclake.functions.columns import any_of, quoted

# Text formats by validation type, and the messages of failed checks.
FORMATS = {"time": r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"}
NO_KEY = "Record does not have a primary key"
NO_OP = f"Missing {OP} column"
NO_VALUE = "Required column is null"
BAD_FORMAT = "{} must have format HH:mm:ss"
BAD_SCHEMA = "Record does not match schema version {}"


def _format_errors(contract: TableContract, present: set[str]) -> list[Column]:
    checks = []
    for field in contract.schema.fields:
        kind = (field.metadata or {}).get(VALIDATION_TYPE)
        if kind is None or not isinstance(field.dataType, T.StringType):
            continue
        if kind not in FORMATS:
            raise ValueError(f"Invalid validation type {kind}. Allowed values are: {sorted(FORMATS)}")
        if field.name in present:
            broken = quoted(field.name).isNotNull() & ~quoted(field.name).rlike(FORMATS[kind])
            checks.append(F.when(broken, F.lit(BAD_FORMAT.format(field.name))))
    return checks


def _row_error(contract: TableContract, present: set[str]) -> Column:
    def null(name: str) -> Column:
        return quoted(name).isNull() if name in present else F.lit(True)

    required = [f.name for f in with_metadata(contract.schema).fields if not f.nullable]
    return (
        F.when(any_of([null(k) for k in contract.keys]), F.lit(NO_KEY))
        .when(null(OP), F.lit(NO_OP))
        .when((quoted(OP) != DELETE) & any_of([null(n) for n in required]), F.lit(NO_VALUE))
    )


def validate(df: DataFrame, contract: TableContract, inferred: T.StructType | None = None) -> DataFrame:
    """Add ``error``: null for a valid row, else every reason joined by ``"; "``.

    Format errors come first, in contract order. A batch whose schema (``inferred``, the schema of
    its files) does not fit the contract fails as a whole. Otherwise the first of missing key,
    missing operation and missing required value is added; deletes need no required values.
    """
    present = set(df.columns)
    errors = _format_errors(contract, present)
    if schemas_match(inferred if inferred is not None else df.schema, with_metadata(contract.schema)):
        errors.append(_row_error(contract, present))
    else:
        errors.append(F.lit(BAD_SCHEMA.format(contract.version)))
    return df.withColumn(ERROR, F.nullif(F.concat_ws("; ", *errors), F.lit("")))


def split_valid(validated: DataFrame, contract: TableContract | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the error column, invalid rows with it).

    Valid rows have no null keys. Given the contract this is spelled out as a filter as well, which
    tells Spark so: later joins then add no filter of their own and can share one shuffle.
    """
    valid = validated.where(F.col(ERROR).isNull()).drop(ERROR)
    for key in contract.keys if contract else ():
        if key in valid.columns:
            valid = valid.where(quoted(key).isNotNull())
    return valid, validated.where(F.col(ERROR).isNotNull())


def only_inserts(df: DataFrame) -> DataFrame:
    """Rows of a full load."""
    return df.where(F.col(OP) == "I")


def violation_rows(invalid: DataFrame) -> DataFrame:
    """``(error, raw)``: the reason and the rest of the row as JSON."""
    payload = [quoted(c) for c in invalid.columns if c != ERROR]
    return invalid.select(ERROR, F.to_json(F.struct(*payload)).alias("raw"))
