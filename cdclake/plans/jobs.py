"""Batch jobs over all configured tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cdclake.contracts import OP, TableContract
from cdclake.operators import reconcile as rec
from cdclake.operators.backfill import BackfillError, backfill
from cdclake.operators.files import archive_plan, unprocessed_files
from cdclake.operators.keys import in_differing_ranges, key_diff, key_projection, key_report, key_sample
from cdclake.operators.mirror import mirror_shape
from cdclake.operators.reload import (
    KIND, KINDS, changes_of_repeated_keys, compare_sides, reload_stamp, repeated_keys, side_changes,
)
from cdclake.operators.validate import only_inserts, split_valid, validate
from cdclake.session import sized_shuffles
from cdclake.sources import paths, tables
from cdclake.sources.quarantine import (
    BAD_FILES, NO_CONTRACT, quarantine, quarantine_all, quarantine_files, quarantine_path,
)
from cdclake.sources.raw import (
    LOAD_GLOB, PARQUET_FILE, IncompatibleSchemas, committed_files, discover_files, discover_tables,
    file_inventory, has_condition, read_raw, table_sizes,
)
from cdclake.streaming.cdc import Zones, write_or_quarantine

log = logging.getLogger(__name__)

Contracts = dict[tuple[str, str], TableContract]


def _glob(root: str, source: str, table: str, glob: str) -> str:
    return f"{root.rstrip('/')}/{source}/{table}/{glob}"


def for_each_table(action: Callable[..., object], items, parallel: int) -> list:
    """Run a job part per table, several at a time, so that small tables do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(action, items))


# --- full load --------------------------------------------------------------------------------

def full_load(spark: SparkSession, table_names, contracts: Contracts, zones: Zones, *,
              glob: str = LOAD_GLOB, parallel: int = 4) -> list[tuple[str, str]]:
    """Load snapshots into structured and curated tables and the mirror; returns the tables found.

    Tables without a contract and tables whose files do not fit together go to quarantine.
    """
    sizes = table_sizes(spark, zones.raw, table_names, glob)
    if not sizes:
        raise ValueError(f"No tables found under {zones.raw}")

    def load(name: tuple[str, str]) -> None:
        source, table = name
        contract = contracts.get(name)
        path = quarantine_path(zones.violations, "structured", source, table)
        try:
            raw = read_raw(spark, _glob(zones.raw, source, table, glob))
        except IncompatibleSchemas:
            # File names only; rows stay on the executors.
            listed = discover_files(spark, zones.raw, [name], glob).select("path").collect()
            quarantine_files(spark, [r.path for r in listed], BAD_FILES.format(source, table), path)
            return
        if contract is None:
            quarantine_all(raw, NO_CONTRACT.format(source, table), path)
        else:
            load_table(spark, raw, contract, zones)

    with sized_shuffles(spark, max(sizes.values())):
        for_each_table(load, sizes, parallel)
    return list(sizes)


def load_table(spark: SparkSession, raw: DataFrame, contract: TableContract, zones: Zones) -> None:
    """Validate the inserts of a snapshot and append those with new keys to both zones.

    Nothing is persisted: filters and validation run inside the scan, and reading a large snapshot
    again is cheaper than keeping a copy of it on the executors. On the first load the curated
    table takes its rows, already in buckets, from the structured one.
    """
    structured_path, curated_path = contract.path(zones.structured), contract.path(zones.curated)
    first = not (tables.table_exists(spark, structured_path) or tables.table_exists(spark, curated_path))
    loaded = only_inserts(raw)
    valid, invalid = split_valid(validate(loaded, contract, raw.schema), contract)
    quarantine(invalid, quarantine_path(zones.violations, "structured", contract.source, contract.table))

    def append_into(path: str) -> Callable[[DataFrame], object]:
        return lambda rows: tables.append_new(spark, path, rows, contract.keys, buckets=zones.buckets)

    def copy_structured(rows: DataFrame) -> None:
        tables.copy_table(spark, structured_path, curated_path)

    run = f"load-{uuid.uuid4().hex}"
    structured = write_or_quarantine("structured", valid, zones, contract, run, append_into(structured_path))
    into_curated = copy_structured if first and structured is valid else append_into(curated_path)
    curated = write_or_quarantine("curated", structured, zones, contract, run, into_curated)
    if zones.mirror is not None:
        zones.mirror(mirror_shape(curated), contract)


# --- reload and backfill ----------------------------------------------------------------------

def reload_diff_job(spark: SparkSession, table_names, contracts: Contracts, raw_root: str, archive_root: str,
                    output: str, moment: datetime, *, glob: str = LOAD_GLOB, gigabytes: float | None = None,
                    cores: int = 1, parallel: int = 4) -> None:
    """Write the differences between new snapshots and the archive, per table and kind."""
    stamp = reload_stamp(moment)
    new = table_sizes(spark, raw_root, table_names, glob)
    archived = table_sizes(spark, archive_root, list(new), glob)

    def write_diff(name: tuple[str, str]) -> None:
        source, table = name
        contract = contracts.get(name)
        if contract is None:
            raise LookupError(f"No contract for {source}.{table}")
        raw = read_raw(spark, _glob(raw_root, source, table, glob))
        if name in archived:
            archive = read_raw(spark, _glob(archive_root, source, table, glob))
        else:
            archive = spark.createDataFrame([], raw.schema)
        # Both sides are read once and shuffled once, and all kinds are written by the same job.
        sides = compare_sides(raw, archive, contract)
        seen, drafts = Observation(), _glob(output, f".drafts-{uuid.uuid4().hex[:12]}", source, table)
        counted = sides.observe(seen, F.count(F.when(repeated_keys(), 1)).alias("repeated"))
        changes = side_changes(counted, raw, archive, contract, stamp)
        changes = changes.hint("rebalance", KIND) if gigabytes is None else changes.repartition(tables.sized_files(gigabytes, cores))
        changes.write.partitionBy(KIND).parquet(drafts)
        if seen.get.get("repeated", 0):
            # A key that the snapshot has more than once is rare: its rows are looked up in the snapshot.
            changes_of_repeated_keys(sides, raw, archive, contract, stamp).write.mode("append").partitionBy(KIND).parquet(drafts)
        for kind in KINDS:
            target = _glob(output, kind, source, table)
            paths.delete(spark, target)
            if not paths.move_folder(spark, f"{drafts}/{KIND}={kind}", target):
                changes.drop(KIND).limit(0).write.parquet(target)
        paths.delete(spark, drafts.removesuffix(f"/{source}/{table}"))

    with sized_shuffles(spark, max([*new.values(), *archived.values()], default=0)):
        for_each_table(write_diff, new, parallel)


def archive_backfill(spark: SparkSession, contracts: Contracts, archive_root: str, output: str, *,
                     glob: str = LOAD_GLOB, gigabytes: float | None = None, cores: int = 1,
                     parallel: int = 4) -> list[tuple[str, str]]:
    """Rewrite archived tables with the columns their contracts have gained; returns those written."""
    if not contracts:
        raise LookupError("No contracts found")
    found = discover_tables(spark, archive_root, list(contracts), glob)

    def write_backfilled(name: tuple[str, str]) -> None:
        source, table = name
        rows = backfill(read_raw(spark, _glob(archive_root, source, table, glob)), contracts[name])
        if rows.isEmpty():
            raise BackfillError(f"The archive of {source}.{table} is empty")
        tables.overwrite_sized(rows, f"{output.rstrip('/')}/{source}/{table}", gigabytes, cores)

    for_each_table(write_backfilled, found, parallel)
    return found


# --- reconciliation ---------------------------------------------------------------------------

def _readable(read: Callable[[], DataFrame]) -> DataFrame | None:
    """A store's rows, None if the store cannot be reached or has no such table."""
    try:
        return read()
    except Exception as error:
        log.warning("Store cannot be read, its count is 0: %s", error)
        return None


def state_counts(spark: SparkSession, contracts, zones: Zones, source_rows: Callable[[TableContract], DataFrame],
                 mirror_rows: Callable[[TableContract], DataFrame] | None = None,
                 managed: set[str] | None = None) -> DataFrame:
    """Row counts of every table in source, structured, curated and mirror.

    The mirror is skipped (null) for tables it does not manage.
    """
    counts = []
    for contract in contracts:
        name = contract.full_name
        stores = {
            "source": _readable(lambda c=contract: source_rows(c)),
            "structured": tables.read_table(spark, contract.path(zones.structured)),
            "curated": tables.read_table(spark, contract.path(zones.curated)),
        }
        if mirror_rows is not None and (managed is None or name in managed):
            stores["mirror"] = _readable(lambda c=contract: mirror_rows(c))
        counts += [rec.store_count(df, name, store, spark) for store, df in stores.items()]
    return rec.state_counts(counts)


def raw_change_counts(spark: SparkSession, contracts, *roots: str) -> DataFrame:
    """Changes per table and operation over several roots, such as raw zone and archive."""
    counts = []
    for root in roots:
        for contract in contracts:
            name = contract.full_name
            try:
                # One column under a given schema: no file is opened to find out its schema.
                ops = spark.read.schema(f"{OP} string").parquet(contract.path(root))
                for row in rec.unknown_ops(ops).collect():
                    log.warning("%d changes of %s in %s have the unknown operation %s", row["n"], name, root, row[OP])
                counts.append(rec.count_by_op(ops, name))
            except Exception as error:
                if not has_condition(error, "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                counts.append(rec.no_changes(spark, name))
    return rec.combine_counts(*counts)


def key_check(spark: SparkSession, contracts, zones: Zones,
              source_keys: Callable[[TableContract], DataFrame]) -> DataFrame:
    """Keys of curated tables against keys of the source database."""
    def both(contract: TableContract) -> tuple[DataFrame, DataFrame]:
        stored = tables.read_table(spark, contract.path(zones.curated))
        return in_differing_ranges(key_projection(stored, contract), source_keys(contract), contract.keys)

    report = key_report([key_diff(*both(c), c.keys, c.full_name) for c in contracts]).persist()
    # The report is a row per table; the keys themselves are looked up for tables that differ.
    wrong = {r["table"] for r in report.where(~F.col("matches")).select("table").collect()}
    for contract in contracts:
        if contract.full_name in wrong:
            sample = key_sample(*both(contract), contract.keys).collect()
            log.warning("Keys without a partner in %s, for example: %s", contract.full_name, [r.asDict() for r in sample])
    return report


class ReconciliationFailed(Exception):
    """At least one check failed and the caller asked for an error."""


def reconcile(spark: SparkSession, reports: dict[str, Callable[[], DataFrame]],
              checks=rec.DEFAULT_CHECKS, *, fail: bool = False) -> DataFrame:
    """Run the selected checks: one row each, with ``ok``, the number of failing tables and the ``overall`` verdict.

    Without any check the overall verdict is good. ``reports`` gives a report per check name, see :mod:`cdclake.operators.reconcile`.
    """
    known = {rec.STATE_COUNTS, rec.CHANGE_COUNTS, rec.KEY_CHECK}
    names = [c.strip().lower() for c in checks]
    for name in names:
        if name not in known:
            raise ValueError(f"Unknown reconciliation check: {name}")
    combined = rec.with_overall(spark, [rec.check_result(reports[n](), n) for n in names])
    if fail:
        failing = [r.check for r in combined.where(~F.col("ok")).select("check").collect()]
        if failing:
            raise ReconciliationFailed(f"{len(failing)} reconciliation checks failed: {', '.join(failing)}")
    return combined


# --- files and tables -------------------------------------------------------------------------

def committed_of(spark: SparkSession, table_names, zones: Zones) -> DataFrame:
    """Files taken in by the streams of all configured tables."""
    logs = [committed_files(spark, zones.stream_checkpoint(s, t)).select("path") for s, t in table_names]
    return reduce(DataFrame.unionByName, logs, spark.createDataFrame([], "path string"))


def plan_archiving(spark: SparkSession, table_names, zones: Zones, ledger: DataFrame, now: datetime,
                   retention: timedelta = timedelta(days=2)) -> DataFrame:
    """Which raw files to copy to the archive, and which may be deleted afterwards."""
    inventory = file_inventory(spark, zones.raw, table_names)
    return archive_plan(inventory, ledger, committed_of(spark, table_names, zones), now, retention)


def all_processed(spark: SparkSession, table_names, zones: Zones, regex: str = PARQUET_FILE) -> bool:
    """Have all raw files been taken in by their streams?"""
    inventory = file_inventory(spark, zones.raw, table_names, regex)
    return unprocessed_files(inventory, committed_of(spark, table_names, zones)).isEmpty()


def maintain(spark: SparkSession, root: str, action: Callable[[SparkSession, str], object], depth: int = 2,
             parallel: int = 4) -> int:
    """Run a maintenance action, such as ``tables.compact``, on all tables below ``root``.

    A failure does not stop the others; at the end the number of failures is raised.
    """
    found = tables.list_tables(spark, root, depth)

    def act(path: str) -> None:
        tables.let_writers_pass(spark, path)
        action(spark, path)

    def attempt(path: str) -> bool:
        try:
            # Maintenance gives way to writers: it tries again on what they have left.
            tables.with_retries(lambda: act(path))
            return True
        except Exception:
            log.exception("Maintenance of %s failed", path)
            return False

    failed = for_each_table(attempt, found, parallel).count(False)
    if failed:
        raise RuntimeError(f"Maintenance failed for {failed} of {len(found)} tables")
    return len(found)
