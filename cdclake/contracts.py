"""Table contracts: what a table must look like, and where contracts come from."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and codes every change file carries.
OP = "Op"
TIMESTAMP = "_timestamp"
SEQUENCE = "checkpoint_col"
ERROR = "error"
RAW = "raw"
INSERT, UPDATE, DELETE = "I", "U", "D"
VALIDATION_TYPE = "validationType"
SENSITIVE = "sensitive"
DEFAULT = "default"


@dataclass(frozen=True)
class TableContract:
    """Declared shape of one source table."""

    source: str
    table: str
    keys: tuple[str, ...]
    schema: T.StructType
    version: str = ""
    namespace: str = ""
    sensitive: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"No primary key in the contract of {self.source}.{self.table}")

    @property
    def full_name(self) -> str:
        return f"{self.source}.{self.table}"

    @property
    def flat_name(self) -> str:
        """Name of the table in catalogs and in the mirror database."""
        return f"{self.source}_{self.table}"

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.source}/{self.table}"


def with_metadata(schema: T.StructType) -> T.StructType:
    """Contract fields followed by the three change-data columns."""
    return T.StructType(
        [
            *schema.fields,
            T.StructField(OP, T.StringType(), False),
            T.StructField(TIMESTAMP, T.StringType(), False),
            T.StructField(SEQUENCE, T.StringType(), True),
        ]
    )


def schemas_match(inferred: T.StructType, declared: T.StructType) -> bool:
    """Does a batch's schema fit the declared one?

    Names are case-sensitive. The batch may lack nullable fields, never have fields of its own.
    Types are compared by class, an 8 or 16 bit integer may stand for a declared 32 bit one, and
    structs are compared field by field. Nullability and metadata do not count.
    """
    fields = {f.name: f for f in declared.fields}
    present = set(inferred.names)
    if len(present) != len(fields):
        absent = [f for name, f in fields.items() if name not in present]
        if len(present) > len(fields) or not all(f.nullable for f in absent):
            return False
    return all(
        f.name in fields and _types_match(f.dataType, fields[f.name].dataType)
        for f in inferred.fields
    )


def _types_match(inferred: T.DataType, declared: T.DataType) -> bool:
    if isinstance(inferred, T.StructType) and isinstance(declared, T.StructType):
        return schemas_match(inferred, declared)
    if isinstance(declared, T.IntegerType) and isinstance(inferred, (T.ByteType, T.ShortType)):
        return True
    return type(inferred) is type(declared)


# ---------------------------------------------------------------------------------------------
# Contract files
# ---------------------------------------------------------------------------------------------

_FIELD = (
    "name string, type string, nullable boolean, key string, metadata string, "
    "logicalType string, symbols string, items string, values string, fields string"
)
_CONTRACT = f"service string, namespace string, name string, version string, fields array<struct<{_FIELD}>>"


def load_contracts(spark: SparkSession, glob: str) -> DataFrame:
    """One row per declared field of every contract file matching ``glob``.

    Properties that are not part of the contract vocabulary are ignored. A nested type stays JSON
    text in ``type``. The table name is the lower-case record name without its first ``_<digits>``.
    """
    parsed = spark.read.text(glob, wholetext=True).select(
        F.from_json("value", _CONTRACT).alias("c"), F.col("_metadata.file_path").alias("path")
    )
    return parsed.select(
        "path",
        F.col("c.service").alias("source"),
        F.lower(F.regexp_replace("c.name", r"^(.*?)_\d+", "$1")).alias("table"),
        F.col("c.namespace").alias("namespace"),
        F.col("c.version").alias("version"),
        F.posexplode("c.fields").alias("position", "field"),
    ).select(
        "path", "source", "table", "namespace", "version", "position",
        F.col("field.name").alias("name"),
        F.col("field.type").alias("type"),
        F.coalesce("field.nullable", F.lit(False)).alias("nullable"),
        (F.coalesce("field.key", F.lit("")) == "primary").alias("is_key"),
        F.col("field.metadata").alias("metadata"),
    )


def contracts_by_table(rows: DataFrame, tables=None) -> dict[tuple[str, str], TableContract]:
    """Contracts keyed by (source, table), only the listed ``tables`` if given.

    Contracts are small metadata: one row per declared column is brought to the driver.
    """
    if tables is not None:
        wanted = reduce(
            lambda a, b: a | b,
            [(F.col("source") == s) & (F.col("table") == t) for s, t in tables],
            F.lit(False),
        )
        rows = rows.where(wanted)
    grouped: dict[tuple[str, str], list] = {}
    for row in rows.orderBy("path", "position").collect():
        grouped.setdefault((row.source, row.table), []).append(row)
    return {name: to_contract(fields) for name, fields in grouped.items()}


def to_contract(rows) -> TableContract:
    """Build one contract from its field rows, in declared order."""
    fields = []
    for row in rows:
        metadata = json.loads(row.metadata) if row.metadata else None
        fields.append(T.StructField(row.name, _spark_type(row.type), row.nullable, metadata))
    first = rows[0]
    return TableContract(
        source=first.source,
        table=first.table,
        keys=tuple(r.name for r in rows if r.is_key),
        schema=T.StructType(fields),
        version=first.version or "",
        namespace=first.namespace or "",
        sensitive=tuple(f.name for f in fields if (f.metadata or {}).get(SENSITIVE) is True),
    )


# Contract type names and their Spark types.
_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
    "enum": T.StringType(),
}
_LOGICAL = {
    "date": T.DateType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
    "time-millis": T.IntegerType(),
    "time-micros": T.LongType(),
}


def _spark_type(declared) -> T.DataType:
    """Spark type of a contract type, given as a name, JSON text or decoded JSON."""
    if isinstance(declared, str):
        if declared in _PRIMITIVES:
            return _PRIMITIVES[declared]
        if declared[:1] not in "{[":
            raise ValueError(f"Unknown contract type {declared}")
        return _spark_type(json.loads(declared))
    if isinstance(declared, list):
        return _union_type(declared)
    logical = declared.get("logicalType")
    if logical == "decimal":
        return T.DecimalType(declared["precision"], declared.get("scale", 0))
    if logical in _LOGICAL:
        return _LOGICAL[logical]
    kind = declared["type"]
    if kind == "array":
        return T.ArrayType(_spark_type(declared["items"]), _has_null(declared["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), _spark_type(declared["values"]), _has_null(declared["values"]))
    if kind == "record":
        return T.StructType(
            [T.StructField(f["name"], _spark_type(f["type"]), _has_null(f["type"])) for f in declared["fields"]]
        )
    if kind == "fixed":
        return T.BinaryType()
    return _spark_type(kind)


def _has_null(declared) -> bool:
    return isinstance(declared, list) and "null" in declared


def _union_type(branches: list) -> T.DataType:
    types = [_spark_type(b) for b in branches if b != "null"]
    if len(types) == 1:
        return types[0]
    names = {type(t) for t in types}
    if names == {T.IntegerType, T.LongType}:
        return T.LongType()
    if names == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    return T.StructType([T.StructField(f"member{i}", t, True) for i, t in enumerate(types)])
