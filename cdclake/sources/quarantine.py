"""Quarantine: rows set aside as ``(error, raw JSON)``, so any schema can share one folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cdclake.contracts import ERROR
from cdclake.operators.validate import violation_rows
from cdclake.sources import paths
from cdclake.sources.raw import IncompatibleSchemas, read_raw

_FOOTER_TASKS = 256

# Messages of tables, files and writes set aside as a whole.
NO_CONTRACT = "Schema does not exist for {}/{}"
BAD_FILES = "Violation - Incompatible schemas across multiple files for {}.{}"
BAD_TYPES = "Violation - some of the input data had incompatible types for column {}. Tried to use {} but found {}"
FAILED_WRITE = "Violation - Data storage service retries exceeded for {}/{} for {}"


def quarantine_path(root: str, zone: str, source: str, table: str) -> str:
    return f"{root.rstrip('/')}/{zone}/{source}/{table}"


def quarantine(invalid: DataFrame, path: str, run: str | None = None, *, few: bool = True) -> int:
    """Add rows that carry an ``error`` column; returns how many.

    Writing finds the rows and counts them in one pass; without any the folder is removed again.
    ``few`` rows out of many are brought together first, else every task would write a tiny file.
    Each call writes its own ``run=`` folder. A stream names the run after its batch, so a batch
    that is run again replaces its rows instead of repeating them.
    """
    seen = Observation()
    folder = f"{path}/run={run or uuid.uuid4().hex}"
    rows = violation_rows(invalid).observe(seen, F.count(F.lit(1)).alias("n"))
    if few:
        rows = rows.hint("rebalance")
    rows.write.mode("overwrite").parquet(folder)
    n = seen.get.get("n", 0)
    if n == 0:
        paths.delete(invalid.sparkSession, folder)
    return n


def quarantine_all(df: DataFrame, message: str, path: str, run: str | None = None) -> int:
    """Set a whole batch aside for one reason."""
    return quarantine(df.withColumn(ERROR, F.lit(message)), path, run, few=False)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("error string, raw string").parquet(path).select("error", "raw")


def quarantine_files(spark: SparkSession, files, message: str, path: str, run: str | None = None) -> int:
    """Set files aside that cannot be read together, each under the schema it was written with.

    One pass over the files' footers tells their schemas; files with one schema are written together, so there are as
    many writes as schemas, however the files alternate between them.
    """
    groups = readable_groups(spark, sorted(files))
    return sum(
        quarantine_all(read_raw(spark, group), message, path, f"{run or uuid.uuid4().hex}-{i}")
        for i, group in enumerate(groups)
    )


def readable_groups(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """Files in groups of one schema each, told from their footers by tasks."""
    if not files:
        return []

    def footer_schema(path: str) -> str | None:
        try:
            store, name = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")
            with store.open_input_file(name) as source:
                return str(pq.read_schema(source).remove_metadata())
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            # pyarrow does not know this store.
            return None

    def schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [footer_schema(name) for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], names=["path", "schema"])

    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(min(len(files), _FOOTER_TASKS))
    rows = listed.mapInArrow(schemas, "path string, schema string").collect()
    if any(r.schema is None for r in rows):
        # Files in a store that tasks do not reach this way are read, in halves, by Spark alone.
        return _halved(spark, files)
    groups: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: r.path):
        groups.setdefault(r.schema, []).append(r.path)
    return list(groups.values())


def _halved(spark: SparkSession, files: list[str]) -> list[list[str]]:
    try:
        read_raw(spark, files)
        return [files]
    except IncompatibleSchemas:
        middle = len(files) // 2
        return _halved(spark, files[:middle]) + _halved(spark, files[middle:])
