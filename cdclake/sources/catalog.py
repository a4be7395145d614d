"""Publishing stored tables in catalog databases."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cdclake.contracts import OP, SEQUENCE, TIMESTAMP, TableContract, with_metadata
from cdclake.sources.tables import table_state, table_units, unit_path

# Fixed value: names the catalog accepts.
TABLE_NAME = r"[a-z_0-9]*"

_FAILURES = "source string, table string, reason string"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: T.StructType, keys) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (" COMMENT 'primary_key'" if f.name in keys else "")
        for f in schema.fields
    )


def archive_properties(contract: TableContract) -> dict[str, str]:
    """Properties by which consumers of the archive find change columns and sensitive columns."""
    sensitive = ",".join(f"'{c.lower()}'" for c in contract.sensitive)
    return {
        "classification": "parquet",
        "extraction_timestamp_column_name": TIMESTAMP.lower(),
        "extraction_operation_column_name": OP.lower(),
        "sensitive_columns": f"[{sensitive}]",
        "extraction_key": f"{TIMESTAMP.lower()},{SEQUENCE.lower()}",
        "source_primary_key": ",".join(k.lower() for k in contract.keys),
    }


def _listed(properties: dict[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def _drop(spark: SparkSession, name: str) -> None:
    kind = _kind(spark, name)
    if kind:
        spark.sql(f"DROP {kind} {name}")


def _kind(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    return "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"


def _replace(spark: SparkSession, database: str, contract: TableContract, schema: T.StructType,
             location: str, properties: dict[str, str]) -> None:
    name = f"`{database}`.`{contract.flat_name}`"
    _drop(spark, name)
    spark.sql(
        f"CREATE TABLE {name} ({_columns(schema, contract.keys)}) USING parquet "
        f"LOCATION {_text(location)} TBLPROPERTIES ({_listed(properties)})"
    )


# --- stored tables ----------------------------------------------------------------------------------
#
# A stored table is shown by a view. Below it are two partitioned tables: one has a partition for each folder
# of the version shown, the other of the one before. A new version is registered in the idle table, by the
# partitions that are new and those that are gone, then the view is pointed there: readers see one version or the
# other. Of folders that are not whole any more the files left are listed in a small table, which the view joins.
# Nothing grows with the number of folders but the catalog's own list of partitions.

_PARTS = (("_gen", "STRING"), ("_bucket", "INT"), ("_left", "STRING"))
_KEPT = "_gen STRING, _bucket INT, file STRING"
_SIDES = ("a", "b")
_SHOWN = "cdclake.side"
#: Folders that are whole, and those of which some files are left; partitions of one statement.
_WHOLE, _SOME, _AT_ONCE = "all", "some", 500


def _side(database: str, contract: TableContract, side: str) -> str:
    return f"`{database}`.`{contract.flat_name}__{side}`"


def _kept_files(side: str) -> str:
    return side.removesuffix("`") + "_files`"


def _show(spark: SparkSession, database: str, contract: TableContract, side: str, properties: dict[str, str]) -> None:
    columns = ", ".join(
        f"`{f.name}`" + (" COMMENT 'primary_key'" if f.name in contract.keys else "") for f in contract.schema.fields
    )
    chosen = ", ".join(f"t.`{f.name}`" for f in contract.schema.fields)
    table = _side(database, contract, side)
    same = "t._gen = k._gen AND t._bucket = k._bucket AND t._metadata.file_name = k.file"
    spark.sql(
        f"CREATE OR REPLACE VIEW `{database}`.`{contract.flat_name}` ({columns}) "
        f"TBLPROPERTIES ({_listed({**properties, _SHOWN: side})}) AS "
        f"SELECT {chosen} FROM {table} t WHERE t._left = '{_WHOLE}' UNION ALL "
        f"SELECT {chosen} FROM {table} t LEFT SEMI JOIN {_kept_files(table)} k ON {same} WHERE t._left = '{_SOME}'"
    )


def _register(spark: SparkSession, name: str, path: str) -> None:
    """Make the partitions of a table those of the current version of the stored table at ``path``."""
    state = table_state(spark, path)
    units = table_units(state) if state else []
    wanted = {(gen, str(b), _SOME if file else _WHOLE) for gen, b, file in units}
    found = (dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    there = {tuple(p[c] for c, _ in _PARTS) for p in found}

    def spec(part: tuple[str, str, str]) -> str:
        return f"PARTITION (_gen = {_text(part[0])}, _bucket = {part[1]}, _left = {_text(part[2])})"

    def location(part: tuple[str, str, str]) -> str:
        return unit_path(path, part[0], int(part[1]), "")

    for parts, statement in (
        (sorted(wanted - there), lambda ps: f"ADD IF NOT EXISTS {' '.join(f'{spec(p)} LOCATION {_text(location(p))}' for p in ps)}"),
        (sorted(there - wanted), lambda ps: f"DROP IF EXISTS {', '.join(spec(p) for p in ps)}"),
    ):
        for low in range(0, len(parts), _AT_ONCE):
            spark.sql(f"ALTER TABLE {name} {statement(parts[low:low + _AT_ONCE])}")
    kept, folder = [u for u in units if u[2]], f"{path}/_kept/none"
    if kept:
        folder = f"{path}/_kept/{uuid.uuid4().hex}"
        spark.createDataFrame(kept, _KEPT).coalesce(1).write.parquet(folder)
    spark.sql(f"ALTER TABLE {_kept_files(name)} SET LOCATION {_text(folder)}")
    for table in (name, _kept_files(name)):
        spark.catalog.refreshTable(table)


def _publish_stored(spark: SparkSession, database: str, contract: TableContract, path: str) -> None:
    name = f"`{database}`.`{contract.flat_name}`"
    _drop(spark, name)
    columns = ", ".join([_columns(contract.schema, contract.keys), *[f"{c} {kind}" for c, kind in _PARTS]])
    for side in _SIDES:
        table = _side(database, contract, side)
        _drop(spark, table)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(c for c, _ in _PARTS)}) "
            f"LOCATION {_text(f'{path}/data')} TBLPROPERTIES ({_listed({'classification': 'parquet'})})"
        )
        _drop(spark, _kept_files(table))
        spark.sql(f"CREATE TABLE {_kept_files(table)} ({_KEPT}) USING parquet LOCATION {_text(f'{path}/_kept/none')}")
    _register(spark, _side(database, contract, _SIDES[0]), path)
    _show(spark, database, contract, _SIDES[0], {"classification": "parquet"})


def _attempt_all(spark: SparkSession, contracts, action) -> DataFrame:
    failures = []
    for contract in contracts:
        try:
            if not re.fullmatch(TABLE_NAME, contract.flat_name):
                raise ValueError(f"Table name {contract.flat_name} is not supported. Use {TABLE_NAME}")
            action(contract)
        except Exception as error:
            failures.append((contract.source, contract.table, str(error)))
    return spark.createDataFrame(failures, _FAILURES)


def publish_tables(spark: SparkSession, contracts, roots: dict[str, str],
                   databases: dict[str, str]) -> DataFrame:
    """(Re)create the tables of all contracts in the archive, structured, curated and public databases.

    ``roots`` and ``databases`` are keyed by ``archive, structured, curated`` and, for databases,
    ``public``, which shows the curated zone. The archive table has the change columns as well.
    Returns the tables that failed; the others are published regardless. A stored table is shown as it
    is now: jobs given ``Zones.published`` move published tables on after every write. Its folders are registered as
    partitions of tables of their own (``<name>__a`` and ``<name>__b``), whose location never changes. Statements on
    partitions are as many as folders are new or gone.
    """
    def publish(contract: TableContract) -> None:
        _replace(spark, databases["archive"], contract, with_metadata(contract.schema),
                 contract.path(roots["archive"]), archive_properties(contract))
        for zone, database in (("structured", "structured"), ("curated", "curated"), ("curated", "public")):
            _publish_stored(spark, databases[database], contract, contract.path(roots[zone]))

    return _attempt_all(spark, contracts, publish)


def point_table(spark: SparkSession, database: str, contract: TableContract, path: str) -> None:
    """Show the current version of the stored table at ``path``, in one step."""
    name = f"`{database}`.`{contract.flat_name}`"
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if not r.key.startswith("view.")}
    shown = properties.pop(_SHOWN)
    idle = next(side for side in _SIDES if side != shown)
    _register(spark, _side(database, contract, idle), path)
    _show(spark, database, contract, idle, properties)


def switch_tables(spark: SparkSession, contracts, root: str, database: str) -> DataFrame:
    """Point the public tables of all contracts to the tables below another root."""
    return _attempt_all(spark, contracts, lambda c: point_table(spark, database, c, c.path(root)))
