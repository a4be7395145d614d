"""Relational databases: key and count reads, mirror writes. Rows move between executors and database."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.contracts import TableContract
from cdclake.functions.columns import quoted


@dataclass(frozen=True)
class Database:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    schema: str = ""
    upper_case: bool = False

    def table_name(self, table: str) -> str:
        name = f"{self.schema}.{table}" if self.schema else table
        return name.upper() if self.upper_case else name


def partition_options(column: str | None, lower, upper, partitions: int) -> dict:
    """Reader options for a parallel scan; without a column the scan is one partition."""
    if column is None:
        return {}
    return {"column": column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}


def read_jdbc(spark: SparkSession, db: Database, table: str, **options) -> DataFrame:
    return spark.read.jdbc(db.url, db.table_name(table), properties=db.properties, **options)


def read_jdbc_keys(spark: SparkSession, db: Database, contract: TableContract, *, column: str | None = None,
                   partitions: int = 1) -> DataFrame:
    """Primary keys of a source table; only key columns are requested from the database.

    With a numeric or date ``column`` the scan is split into ``partitions`` ranges between the
    column's own bounds, which the database is asked for first.
    """
    options = {}
    if column is not None and partitions > 1:
        bounds = read_jdbc(spark, db, contract.table).agg(F.min(column), F.max(column)).first()
        if bounds[0] is not None:
            options = partition_options(column, bounds[0], bounds[1], partitions)
    rows = read_jdbc(spark, db, contract.table, **options)
    return rows.select(*[quoted(k) for k in contract.keys])


def write_jdbc(df: DataFrame, db: Database, table: str, *, truncate: bool, batch_size: int = 1000) -> None:
    """Replace a table's rows; ``truncate`` keeps its definition, otherwise it is created anew."""
    (
        df.write.mode("overwrite")
        .option("truncate", truncate)
        .option("batchsize", batch_size)
        .jdbc(db.url, db.table_name(table), properties=db.properties)
    )


def merge_statement(contract: TableContract, loading: str, destination: str) -> str:
    """MERGE of a loading table (with ``op``) into the mirror table, run inside the database."""
    keys = [k.lower() for k in contract.keys]
    names = [n.lower() for n in contract.schema.names]
    values = [n for n in names if n not in keys]
    lines = [
        f"MERGE INTO {destination} destination",
        f"USING {loading} source",
        "ON " + " AND ".join(f"source.{k} = destination.{k}" for k in keys),
        "WHEN MATCHED AND source.op = 'D' THEN DELETE",
    ]
    if values:
        assignments = ", ".join(f"{v} = source.{v}" for v in values)
        lines.append(f"WHEN MATCHED AND source.op = 'U' THEN UPDATE SET {assignments}")
    inserted = ", ".join(f"source.{n}" for n in names)
    lines.append(
        f"WHEN NOT MATCHED AND source.op IN ('I', 'U') THEN INSERT ({', '.join(names)}) VALUES ({inserted})"
    )
    return "\n".join(lines)


def run_statement(spark: SparkSession, db: Database, *statements: str) -> None:
    """Run statements in the database itself; no rows pass through the driver."""
    properties = spark._jvm.java.util.Properties()
    for key, value in db.properties.items():
        properties.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(db.url, properties)
    try:
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
    finally:
        connection.close()


class MirrorTableMissing(Exception):
    """Mirror tables are created by their owner, never by a load."""


def overwrite_mirror(db: Database, managed: set[str], *, batch_size: int = 1000):
    """Mirror callback of a full load: replace the rows of managed tables, in the contract's namespace."""
    def write(df: DataFrame, contract: TableContract) -> None:
        if contract.full_name not in managed:
            return
        target = replace(db, schema=contract.namespace)
        try:
            read_jdbc(df.sparkSession, target, contract.flat_name)
        except Exception as error:
            raise MirrorTableMissing(f"{target.table_name(contract.flat_name)} does not exist or cannot be read") from error
        write_jdbc(df, target, contract.flat_name, truncate=True, batch_size=batch_size)

    return write


def merge_mirror(db: Database, managed: set[str], *, loading_schema: str = "loading", batch_size: int = 1000):
    """Mirror callback of a stream: fill a loading table and merge it inside the database."""
    def merge(df: DataFrame, contract: TableContract) -> None:
        if contract.full_name not in managed:
            return
        loading, target = replace(db, schema=loading_schema), replace(db, schema=contract.namespace)
        write_jdbc(df, loading, contract.flat_name, truncate=False, batch_size=batch_size)
        source = loading.table_name(contract.flat_name)
        statement = merge_statement(contract, source, target.table_name(contract.flat_name))
        run_statement(df.sparkSession, db, statement, f"TRUNCATE TABLE {source}")

    return merge
