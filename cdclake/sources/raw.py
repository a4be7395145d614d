"""Raw zone: finding, reading and listing parquet files written by the replication tool."""

from __future__ import annotations

import re
from datetime import datetime
from urllib.parse import urlparse

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.sources import paths

# Default file name patterns.
LOAD_GLOB = "LOAD*parquet"
CDC_GLOB = "*-*.parquet"
PARQUET_FILE = r"(?i).+.parquet$"

_LISTING = "source string, table string, path string, modificationTime timestamp, length long"


class IncompatibleSchemas(Exception):
    """Files that cannot be read together."""


class NoSchemaNoData(Exception):
    """Neither a contract nor a file tells the schema of a table."""


def has_condition(error: Exception, *names: str) -> bool:
    """Is this an error of one of the named conditions, possibly wrapped by the JVM bridge?"""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    text = f"{condition or ''} {error}"
    return any(name in text for name in names)


def read_raw(spark: SparkSession, files) -> DataFrame:
    """Parquet files or folders with their schemas merged."""
    files = [files] if isinstance(files, str) else list(files)
    try:
        return spark.read.option("mergeSchema", True).parquet(*files)
    except Exception as error:
        if has_condition(error, "CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE"):
            raise IncompatibleSchemas(f"Cannot merge the schemas of {len(files)} paths") from error
        raise


_GONE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FILE_NOT_EXIST", "FileNotFoundException")


def infer_schema(spark: SparkSession, *places: str | list[str]) -> T.StructType:
    """Schema of the first place that has files: raw, then processed, then archived ones.

    A place is a folder, or a list of files. Lists hold the same files in the same order, and each file is taken
    from the first list in which it is there. Files that are nowhere raise :class:`NoSchemaNoData`, folders Spark's error.
    """
    lists = [p for p in places if not isinstance(p, str)]
    files = []
    for same in zip(*lists, strict=True):
        files += [f for f in same if paths.exists(spark, f)][:1]
    there = ([files] if files else []) + [p for p in places if isinstance(p, str)]
    if not there:
        raise NoSchemaNoData("None of the files is there")
    for place in there[:-1]:
        try:
            return read_raw(spark, place).schema
        except Exception as error:
            if not is_gone(error):
                raise
    return read_raw(spark, there[-1]).schema


def is_gone(error: Exception) -> bool:
    """Are the files to be read not there, or not there any more?"""
    return isinstance(error, NoSchemaNoData) or has_condition(error, *_GONE)


def configured_tables(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(source, table) pairs of a table list file, ``{"tables": ["source/table", ...]}``."""
    listed = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "tables array<string>")["tables"]).alias("name")
    )
    names = [r.name for r in listed.distinct().collect()]
    for name in names:
        if len(name.split("/")) != 2:
            raise ValueError(f"{name} does not have the form source/table")
    return sorted(tuple(name.split("/")) for name in names)


def _listing(spark: SparkSession, root: str, tables, glob: str | None, recursive: bool) -> DataFrame:
    # One listing job for all tables; the content column is never read.
    folders = [f"{root.rstrip('/')}/{s}/{t}" for s, t in tables]
    folders = [f for f in folders if paths.exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], _LISTING)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    base = re.escape(urlparse(root.rstrip("/")).path) + "/([^/]+)/([^/]+)/"
    return reader.load(folders).select(
        F.regexp_extract("path", base, 1).alias("source"),
        F.regexp_extract("path", base, 2).alias("table"),
        "path", "modificationTime", "length",
    )


def discover_files(spark: SparkSession, root: str, tables, glob: str = LOAD_GLOB) -> DataFrame:
    """Load files of the configured tables; a table without any has no rows."""
    return _listing(spark, root, tables, glob, recursive=False)


def table_sizes(spark: SparkSession, root: str, tables, glob: str = LOAD_GLOB) -> dict[tuple[str, str], int]:
    """Bytes of load files per configured table that has any."""
    files = discover_files(spark, root, tables, glob)
    sizes = files.groupBy("source", "table").agg(F.sum("length").alias("size")).orderBy("source", "table")
    return {(r.source, r.table): r["size"] for r in sizes.collect()}


def discover_tables(spark: SparkSession, root: str, tables, glob: str = LOAD_GLOB) -> list[tuple[str, str]]:
    """Configured tables that have load files."""
    return list(table_sizes(spark, root, tables, glob))


def file_inventory(spark: SparkSession, root: str, tables, regex: str = PARQUET_FILE,
                   older_than: datetime | None = None) -> DataFrame:
    """All files of the configured tables by name pattern and latest modification time."""
    listed = _listing(spark, root, tables, None, recursive=True)
    listed = listed.where(F.col("path").rlike(regex))
    return listed if older_than is None else listed.where(F.col("modificationTime") < F.lit(older_than))


def stream_raw(spark: SparkSession, glob: str, schema: T.StructType, *, max_files: int = 1000,
               archive_dir: str | None = None) -> DataFrame:
    """Stream of change files with a known schema; read files may be moved to ``archive_dir``.

    A file that has gone since it was listed is passed over: another job may archive raw files.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("ignoreMissingFiles", True)
    )
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.parquet(glob)


def stream_raw_inferred(spark: SparkSession, glob: str, **options) -> DataFrame:
    """Stream of change files of a table without a contract."""
    try:
        schema = spark.read.parquet(glob).schema
    except Exception as error:
        if has_condition(error, "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise NoSchemaNoData(f"No contract and no data under {glob}") from error
        raise
    return stream_raw(spark, glob, schema, **options)


_SOURCE_LOG = "path string, timestamp long, batchId long"


def committed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path, timestamp, batchId`` of the files a stream has taken in.

    The source log has one small file per batch and now and then a compact one that repeats all
    earlier entries, so only the newest compact file and those after it are read.
    """
    folder = f"{checkpoint.rstrip('/')}/sources/0"
    names = [n for n, is_folder, _ in paths.entries(spark, folder) if not is_folder]
    logs = {n: int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)(\.compact)?", n))}
    start = max((i for n, i in logs.items() if n.endswith(".compact")), default=-1)
    wanted = [f"{folder}/{n}" for n, i in logs.items()
              if i > start or (i == start and n.endswith(".compact"))]
    if not wanted:
        return spark.createDataFrame([], _SOURCE_LOG)
    lines = spark.read.text(wanted).where(F.col("value").startswith("{"))
    logged = lines.select(F.from_json("value", _SOURCE_LOG).alias("f")).select("f.*")
    return logged.withColumn("path", listed_path("path"))


def listed_path(column: str) -> Column:
    """A path from a stream's log or ``_metadata.file_path``, which are URL-encoded, as listings show it."""
    decoded = F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")
