"""Change-data streams: one streaming query per table, each micro-batch merged into all zones."""

from __future__ import annotations

import json
import logging
import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdclake.contracts import ERROR, TIMESTAMP, TableContract, with_metadata
from cdclake.operators.changes import latest_records
from cdclake.operators.metrics import observed_latency, observed_times
from cdclake.operators.mirror import mirror_shape
from cdclake.operators.validate import split_valid, validate
from cdclake.sources import catalog, paths, tables
from cdclake.sources.quarantine import (
    BAD_TYPES, FAILED_WRITE, NO_CONTRACT, quarantine, quarantine_all, quarantine_files, quarantine_path,
)
from cdclake.sources.raw import (
    CDC_GLOB, IncompatibleSchemas, NoSchemaNoData, committed_files, has_condition, infer_schema, is_gone,
    stream_raw, stream_raw_inferred,
)

log = logging.getLogger(__name__)

Mirror = Callable[[DataFrame, TableContract], None]


@dataclass(frozen=True)
class Zones:
    """Root folders of a lake, and how its streams run."""

    raw: str
    structured: str
    curated: str
    violations: str
    checkpoint: str
    metrics: str | None = None
    glob: str = CDC_GLOB
    max_files: int = 1000
    archive_dir: str | None = None
    buckets: int | None = None
    mirror: Mirror | None = None
    in_sequence: bool = True  # a late change never undoes a newer one, however the feed is cut
    attempts: int = 5  # of a write that another writer got in the way of
    published: dict[str, tuple[str, ...]] | None = None  # databases showing each zone

    def table_path(self, zone: str, contract: TableContract) -> str:
        return contract.path({"structured": self.structured, "curated": self.curated}[zone])

    def raw_glob(self, source: str, table: str) -> str:
        return f"{self.raw.rstrip('/')}/{source}/{table}/{self.glob}"

    def stream_checkpoint(self, source: str, table: str) -> str:
        return f"{self.checkpoint.rstrip('/')}/{query_name(source, table)}"


def query_name(source: str, table: str) -> str:
    return f"cdc_{source}.{table}"


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """Files of one micro-batch; their number is limited by the stream's files per trigger."""
    log_rows = committed_files(spark, checkpoint).where(F.col("batchId") == batch_id)
    return sorted(r.path for r in log_rows.select("path").collect())


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """What tells the batches of a stream from those of an earlier one: batch numbers begin anew with a checkpoint."""
    path = f"{checkpoint}/metadata"
    return json.loads(paths.read_text(spark, path))["id"][:8] if paths.exists(spark, path) else "none"


def batch_schema(spark: SparkSession, files: list[str], archive_dir: str | None, default: T.StructType) -> T.StructType:
    """Schema of a batch's files: where they were found, else where they have been archived, else the stream's.

    Another job, or the stream's own clean-up, may move a file between its listing and this look at it.
    """
    places = [files]
    if archive_dir:
        places.append([f"{archive_dir.rstrip('/')}{urlparse(f).path}" for f in files])
    try:
        return infer_schema(spark, *places)
    except Exception as error:
        if not is_gone(error):
            raise
        log.warning("Files of a batch have gone meanwhile, its schema is not checked", exc_info=True)
        return default


# --- one micro-batch --------------------------------------------------------------------------

def write_or_quarantine(zone: str, df: DataFrame, zones: Zones, contract: TableContract, run: str,
                        write: Callable[[DataFrame], object]) -> DataFrame:
    """Write to a zone, move its published tables on, and pass the rows on.

    If another writer got in the way, the newest version is loaded and the write repeated, a bounded
    number of times; compactions of the table wait for it. After that, or if a column cannot hold the new values, the rows go to quarantine
    and an empty frame is passed on.
    """
    try:
        target = df.sparkSession, zones.table_path(zone, contract)
        tables.with_retries(lambda: write(df), zones.attempts, table=target)
        for database in (zones.published or {}).get(zone, ()):
            catalog.point_table(df.sparkSession, database, contract, zones.table_path(zone, contract))
        return df
    except (tables.TableConflict, tables.SchemaConflict) as error:
        log.warning("Write to %s of %s failed", zone, contract.full_name, exc_info=True)
        message = FAILED_WRITE.format(contract.source, contract.table, zone)
        if isinstance(error, tables.SchemaConflict):
            message = str(error)
        path = quarantine_path(zones.violations, zone, contract.source, contract.table)
        quarantine_all(df, message, path, f"{run}-failed")
        return df.limit(0)


def process_cdc_batch(df: DataFrame, batch_id: int, contract: TableContract, zones: Zones) -> None:
    """Validate a micro-batch, keep the latest change per key and merge it into every zone.

    The input is read once: validated rows are persisted by the write of those set aside, which also
    brings up any unreadable column before a table is written. Counts and event times are observed on the way, so
    metrics cost no job. A batch that is run again changes nothing twice, since tables remember the
    last batch and quarantine and metrics folders are named after it.
    """
    spark = df.sparkSession
    started = time.time()
    source, table = contract.source, contract.table
    checkpoint = zones.stream_checkpoint(source, table)
    stream = stream_id(spark, checkpoint)
    run = f"cdc-{stream}-{batch_id}"
    files = batch_files(spark, checkpoint, batch_id)
    inferred = batch_schema(spark, files, zones.archive_dir, df.schema)
    read, taken = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    validated = validate(df, contract, inferred).observe(read, rows, F.count(ERROR).alias("invalid")).persist()
    latest = None
    try:
        valid, invalid = split_valid(validated, contract)
        quarantine(invalid, quarantine_path(zones.violations, "structured", source, table), run)
        counts = read.get
        if not counts["rows"]:
            return
        latest = latest_records(valid, contract.keys).observe(taken, rows, *observed_times(TIMESTAMP)).persist()
        mark = (f"{query_name(source, table)}/{stream}", batch_id)

        merged = []

        def merge_into(root: str) -> Callable[[DataFrame], object]:
            return lambda rows: merged.append(tables.merge(
                spark, contract.path(root), rows, contract.keys, batch=mark, buckets=zones.buckets, unique=True,
                in_sequence=zones.in_sequence))

        structured = write_or_quarantine("structured", latest, zones, contract, run, merge_into(zones.structured))
        curated = write_or_quarantine("curated", structured, zones, contract, run, merge_into(zones.curated))
        written = time.time()
        if zones.mirror is not None:
            zones.mirror(mirror_shape(curated, keep_op=True), contract)
        if zones.metrics is not None:
            if not any(merged):
                # Tables that know this batch have not looked at its rows; an observation waits until someone does.
                latest.count()
            row = batch_metrics(taken.get, structured is latest, curated is latest, written) | {
                "source": source, "table": table, "batch_id": batch_id, "rows_in": counts["rows"],
                "rows_invalid": counts["invalid"], "took_ms": int((time.time() - started) * 1000),
            }
            metrics = spark.createDataFrame([row], METRICS)
            metrics.write.mode("overwrite").parquet(f"{contract.path(zones.metrics)}/batch={stream}-{batch_id}")
    finally:
        if latest is not None:
            latest.unpersist()
        validated.unpersist()


METRICS = (
    "source string, table string, batch_id long, rows_in long, rows_invalid long, rows_structured long, "
    "rows_curated long, latency_minimum long, latency_maximum long, latency_sum long, "
    "latency_total_count long, took_ms long"
)


def batch_metrics(taken: dict, structured: bool, curated: bool, written: float) -> dict[str, int]:
    """Rows written per zone and the latency from event to curated zone; a zone whose write failed has none."""
    seen = taken if curated else dict.fromkeys(taken, 0)
    latency = observed_latency(seen, int(written * 1000))
    return {f"latency_{name}": value for name, value in latency.items()} | {
        "rows_structured": taken["rows"] if structured else 0, "rows_curated": seen["rows"],
    }


def _clash_message(error: Exception) -> str:
    found = re.search(r"column: (\[.*?\]), physicalType: (\S+), logicalType: ([^\s;]+)", str(error))
    column, physical, logical = found.groups() if found else ("?", "?", "?")
    return BAD_TYPES.format(column, logical, physical)


def with_type_clash_handling(process: Callable[[DataFrame, int], None], source: str, table: str,
                             zones: Zones) -> Callable[[DataFrame, int], None]:
    """Set a batch's files aside if they cannot be read with the stream's schema; the stream goes on.

    Any other error is passed on.
    """
    def guarded(df: DataFrame, batch_id: int) -> None:
        try:
            process(df, batch_id)
        except Exception as error:
            clash = has_condition(error, "PARQUET_COLUMN_DATA_TYPE_MISMATCH",
                                  "SchemaColumnConvertNotSupportedException")
            if not clash and not isinstance(error, IncompatibleSchemas):
                raise
            spark = df.sparkSession
            message = _clash_message(error)
            log.warning("%s", message)
            checkpoint = zones.stream_checkpoint(source, table)
            files = batch_files(spark, checkpoint, batch_id)
            path = quarantine_path(zones.violations, "structured", source, table)
            quarantine_files(spark, files, message, path, f"cdc-{stream_id(spark, checkpoint)}-{batch_id}")

    return guarded


# --- streams ----------------------------------------------------------------------------------

def start_cdc(df: DataFrame, process: Callable[[DataFrame, int], None], source: str, table: str,
              zones: Zones, *, seconds: int | None = 60) -> StreamingQuery:
    """Start a table's query: a micro-batch every ``seconds``, or all available files and stop."""
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return (
        df.writeStream.queryName(query_name(source, table))
        .foreachBatch(with_type_clash_handling(process, source, table, zones))
        .outputMode("update")
        .option("checkpointLocation", zones.stream_checkpoint(source, table))
        .trigger(**trigger)
        .start()
    )


def plan_stream(spark: SparkSession, source: str, table: str, contract: TableContract | None,
                zones: Zones) -> tuple[DataFrame, Callable[[DataFrame, int], None]]:
    """The stream of a table and what to do with its batches.

    With a contract batches are merged, without one they are set aside as a whole. A table with
    neither contract nor data raises :class:`NoSchemaNoData`.
    """
    glob = zones.raw_glob(source, table)
    options = {"max_files": zones.max_files, "archive_dir": zones.archive_dir}
    if contract is not None:
        stream = stream_raw(spark, glob, with_metadata(contract.schema), **options)
        return stream, lambda df, batch_id: process_cdc_batch(df, batch_id, contract, zones)
    stream = stream_raw_inferred(spark, glob, **options)
    path = quarantine_path(zones.violations, "structured", source, table)
    message = NO_CONTRACT.format(source, table)
    checkpoint = zones.stream_checkpoint(source, table)
    return stream, lambda df, batch_id: quarantine_all(
        df, message, path, f"cdc-{stream_id(spark, checkpoint)}-{batch_id}")


def cdc_stream(spark: SparkSession, table_names, contracts: dict[tuple[str, str], TableContract], zones: Zones,
               *, seconds: int | None = 60, reset_checkpoint: bool = False) -> list[StreamingQuery]:
    """Start one query per table; a table without contract and data is skipped."""
    if reset_checkpoint:
        paths.delete(spark, zones.checkpoint)
    queries = []
    for source, table in table_names:
        try:
            stream, process = plan_stream(spark, source, table, contracts.get((source, table)), zones)
        except NoSchemaNoData as error:
            log.error("Skipping %s.%s: %s", source, table, error)
            continue
        queries.append(start_cdc(stream, process, source, table, zones, seconds=seconds))
    return queries
