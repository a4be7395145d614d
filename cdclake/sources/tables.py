"""Stored tables: parquet folders with atomic replacement, on any Hadoop file system.

A table is split into hash buckets of its primary key. Every write adds a folder
``data/gen=<id>/_bucket=<n>`` and then one small version file naming the folders that make up the
table, and of folders that are not whole any more the files, so readers never see half a write and a
failed job leaves the old version in place. A merge looks for its keys in the buckets its changes fall
into and rewrites only the files that hold some; an append rewrites nothing.

The schema is kept in the version file: reading needs no look into parquet footers, and columns
may be added over time. Of two writers at once one is refused at commit and may try again
(:func:`with_retries`); maintenance gives way to it then.
"""

from __future__ import annotations

import json
import logging
import math
import random
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import DELETE, OP
from cdclake.functions.columns import all_of, quoted, row_digest
from cdclake.functions.joins import spread_join
from cdclake.functions.types import SchemaConflict, conform, merged_type, nullable
from cdclake.operators import changes as ops
from cdclake.operators import sequence
from cdclake.session import plan_bytes, sized_shuffles
from cdclake.sources import paths

log = logging.getLogger(__name__)

BUCKET = "_bucket"
_GEN = "gen"
_BUCKET_BYTES = 512 << 20
_NO_STATISTICS = 1 << 60
_MEMORY = "_memory"
_WAITING = "_waiting"
_GROUP_BYTES = 64 << 30
#: Ranges of each key along the curve that compacted rows follow, keys that make it up, and rows its ranges are told by.
_CURVE_BITS, _CURVE_KEYS, _CURVE_SAMPLE = 6, 4, 4096


class TableConflict(Exception):
    """Another writer has changed the table since this write began."""


def with_retries(write: Callable[[], object], attempts: int = 5, seconds: float = 0.1,
                 table: tuple[SparkSession, str] | None = None) -> object:
    """Repeat a write that loads the newest version first, as long as other writers get in its way.

    Waits grow up to some seconds; after ``attempts`` the conflict is passed on. A write refused once says
    so in ``table`` (session and path) until it is done, and maintenance gives way to it: a write that takes
    longer than the time between two compactions would be refused every time.
    """
    announced = None
    try:
        for attempt in range(attempts):
            began = time.time()
            try:
                return write()
            except TableConflict:
                if attempt + 1 == attempts:
                    raise
                if table is not None:
                    announced = _announce(*table, announced, time.time() - began)
                time.sleep(min(5.0, seconds * 2**attempt) * random.uniform(0.5, 1.5))
    finally:
        if announced is not None:
            paths.delete(table[0], announced)
    raise ValueError("attempts must be at least 1")


def _announce(spark: SparkSession, path: str, earlier: str | None, took: float) -> str:
    """Say that a write which took so long is tried again. The name tells until when that holds, should its job die."""
    until = int((time.time() + max(60.0, 4 * took)) * 1000)
    name = f"{path}/{_WAITING}/{until:013d}-{uuid.uuid4().hex}"
    paths.write_text(spark, name, "")
    if earlier is not None:
        paths.delete(spark, earlier)
    return name


def _awaited(spark: SparkSession, path: str) -> bool:
    """Is a write that was refused tried again?"""
    now = time.time() * 1000
    return any(int(name.partition("-")[0]) > now for name, _, _ in paths.entries(spark, f"{path}/{_WAITING}"))


def _give_way(spark: SparkSession, path: str) -> None:
    """Refuse maintenance while a write that was refused is tried again."""
    if _awaited(spark, path):
        raise TableConflict(f"{path} is waited for by a writer that was refused")


def let_writers_pass(spark: SparkSession, path: str, seconds: float = 1.0) -> None:
    """Wait, before maintenance, until no write that was refused is tried again."""
    while _awaited(spark, path):
        time.sleep(seconds)


# --- version files ----------------------------------------------------------------------------

def _versions(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    return sorted(
        (int(name[:-5]), modified)
        for name, _, modified in paths.entries(spark, f"{path}/_versions")
        if name.endswith(".json") and name[:-5].isdigit()
    )


def _load(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(paths.read_text(spark, f"{path}/_versions/{version:012d}.json"))


def table_state(spark: SparkSession, path: str) -> dict | None:
    """The newest version of a table, None if there is no table."""
    versions = _versions(spark, path)
    return _load(spark, path, versions[-1][0]) if versions else None


def _commit(spark: SparkSession, path: str, before: dict | None, after: dict) -> None:
    after["version"] = before["version"] + 1 if before else 0
    after["committed"] = int(time.time() * 1000)
    written, sizes = (before["written"], before["sizes"]) if before else ({}, {})
    after["written"] = {gen: written.get(gen, len(live)) for gen, live in after["live"].items()}
    partial = {
        gen: {b: names for b, names in left.items() if int(b) in after["live"].get(gen, ())}
        for gen, left in after.get("partial", {}).items()
    }
    after["partial"] = {gen: left for gen, left in partial.items() if left}
    after["sizes"] = {
        gen: sizes[gen] if gen in sizes else paths.size(spark, f"{path}/data/{_GEN}={gen}") for gen in after["live"]
    }
    folder = f"{path}/_versions"
    draft = f"{folder}/.{uuid.uuid4().hex}"
    paths.write_text(spark, draft, json.dumps(after))
    if not paths.rename(spark, draft, f"{folder}/{after['version']:012d}.json"):
        paths.delete(spark, draft)
        raise TableConflict(f"{path} already has version {after['version']}")


# --- reading ----------------------------------------------------------------------------------

def table_exists(spark: SparkSession, path: str) -> bool:
    return table_state(spark, path) is not None


def has_records(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, path) and not read_table(spark, path).isEmpty()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table; a missing table gives a frame without rows and columns."""
    state = table_state(spark, path)
    if state is None:
        return spark.createDataFrame([], T.StructType())
    return _read(spark, path, state)


def table_units(state: dict, buckets: set[int] | None = None) -> list[tuple[str, int, str]]:
    """What makes up a version: (generation, bucket, file), the file empty for a folder that is whole."""
    return [
        (gen, b, name)
        for gen, live in sorted(state["live"].items())
        for b in live
        if buckets is None or b in buckets
        for name in _partial(state, gen, b) or [""]
    ]


def _partial(state: dict, gen: str, bucket: int) -> list[str] | None:
    """Files left of a folder, None if it is whole."""
    return state.get("partial", {}).get(gen, {}).get(str(bucket))


def unit_path(path: str, gen: str, bucket: int, name: str) -> str:
    folder = f"{path}/data/{_GEN}={gen}/{BUCKET}={bucket}"
    return f"{folder}/{name}" if name else folder


def _unit_of(file: str) -> tuple[str, int, str]:
    """The unit that a file of a table is."""
    gen, bucket, name = file.split("/")[-3:]
    return gen.partition("=")[2], int(bucket.partition("=")[2]), name


def table_folders(state: dict, path: str, buckets: set[int] | None = None) -> list[str]:
    return [unit_path(path, *u) for u in table_units(state, buckets)]


def _read(spark: SparkSession, path: str, state: dict, buckets: set[int] | None = None,
          units: list[tuple[str, int, str]] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    units = table_units(state, buckets) if units is None else units
    if not units:
        return spark.createDataFrame([], schema)
    stored = schema.add(BUCKET, T.IntegerType()).add(_GEN, T.StringType())
    names = [f.name for f in schema.fields if f.name not in (BUCKET, _GEN)]
    reader = spark.read.schema(stored).option("basePath", f"{path}/data")
    return reader.parquet(*[unit_path(path, *u) for u in units]).select(*[quoted(n) for n in names])


# --- writing ----------------------------------------------------------------------------------

def _broadcast_limit(spark: SparkSession) -> int:
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return -1 if limit.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def _bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(buckets)).cast("int")


def _bucket_count(size: int) -> int:
    return max(1, math.ceil(size / _BUCKET_BYTES))


def _size(df: DataFrame) -> int:
    """Spark's estimate of a frame's bytes; one that it knows nothing about is measured."""
    size = plan_bytes(df)
    if size < _NO_STATISTICS:
        return size
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct(*[quoted(c) for c in df.columns]))))).first()[0] or 0


def _fitting_count(state: dict) -> int:
    """Bucket count for the next rewrite: the table's own until it has clearly outgrown it.

    A table that a stream began with a small batch would otherwise keep its few buckets for ever.
    """
    live = sum(size * len(state["live"][gen]) / state["written"][gen] for gen, size in state["sizes"].items())
    wanted = _bucket_count(math.ceil(live))
    return wanted if wanted >= 4 * state["buckets"] else state["buckets"]


def _balanced(df: DataFrame, buckets: int) -> DataFrame:
    # Adaptive execution sizes the output: small buckets share a task, large ones are split. With
    # more partitions than buckets few buckets meet in one partition, so splits stay whole files.
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * buckets)
    return df.hint("rebalance", partitions, F.col(BUCKET))


def _write(spark: SparkSession, df: DataFrame, path: str, balance: int | None) -> tuple[str, list[int]]:
    """Write bucketed rows as a new generation; returns its id and the buckets it holds.

    ``balance`` is the table's bucket count if rows are still to be gathered by bucket.
    """
    # A generation is named after the time its writing began.
    gen = f"t{int(time.time() * 1000):012x}{uuid.uuid4().hex[:10]}"
    out = _balanced(df, balance) if balance else df
    folder = f"{path}/data/{_GEN}={gen}"
    out.write.partitionBy(BUCKET).parquet(folder)
    prefix = f"{BUCKET}="
    live = [int(n[len(prefix):]) for n, _, _ in paths.entries(spark, folder) if n.startswith(prefix)]
    return gen, sorted(live)


def _merged_schema(stored: dict, added: T.StructType) -> dict:
    schema = T.StructType.fromJson(stored)
    new = {f.name: f.dataType for f in added.fields}
    fields = [
        T.StructField(f.name, merged_type(f.dataType, new[f.name], f.name) if f.name in new else f.dataType, True)
        for f in schema.fields
    ]
    return T.StructType([*fields, *[f for f in nullable(added).fields if f.name not in schema.names]]).jsonValue()


def _aligned(df: DataFrame, state: dict, helpers: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the table's types: narrower numbers are widened, structs get each other's fields.

    Anything else is refused here, before a file is written: a table stays readable. ``helpers`` are
    columns that are not for the table.
    """
    rows = [f for f in df.schema.fields if f.name not in helpers]
    want = {f.name: f.dataType for f in T.StructType.fromJson(_merged_schema(state["schema"], T.StructType(rows))).fields}
    values = [conform(quoted(f.name), f.dataType, want[f.name]).alias(f.name) for f in rows]
    return df.select(*values, *[c for c in df.columns if c in helpers])


def _seen(state: dict | None, batch: tuple[str, int] | None) -> bool:
    return bool(state and batch and state["batches"].get(batch[0], -1) >= batch[1])


def _batches(state: dict | None, batch: tuple[str, int] | None) -> dict:
    """The last batch of each stream; a stream begun anew (``name/id``) takes the place of its forerunner."""
    known = dict(state["batches"]) if state else {}
    if batch:
        name = batch[0].partition("/")[0]
        known = {k: v for k, v in known.items() if k.partition("/")[0] != name}
        known[batch[0]] = batch[1]
    return known


def _create(spark: SparkSession, path: str, df: DataFrame, keys, buckets: int | None, batch) -> bool:
    buckets = buckets or _bucket_count(_size(df))
    gen, live = _write(spark, df.withColumn(BUCKET, _bucket_of(keys, buckets)), path, buckets)
    if not live and batch is None:
        return False
    _commit(spark, path, None, {
        "keys": list(keys), "buckets": buckets, "schema": nullable(df.schema).jsonValue(),
        "live": {gen: live} if live else {}, "batches": _batches(None, batch),
    })
    return True


def copy_table(spark: SparkSession, source: str, path: str) -> bool:
    """Create a table with the rows of another one. Rows stay in their buckets, nothing is shuffled."""
    state = table_state(spark, source)
    if state is None:
        return False
    rows = _read(spark, source, state).withColumn(BUCKET, _bucket_of(state["keys"], state["buckets"]))
    gen, live = _write(spark, rows, path, None)
    _commit(spark, path, None, {**state, "live": {gen: live} if live else {}, "partial": {}, "batches": {}})
    return True


def append(spark: SparkSession, path: str, df: DataFrame, keys, *, buckets: int | None = None,
           batch: tuple[str, int] | None = None) -> bool:
    """Add rows as they are; columns the table lacks are added to it. No rows: nothing happens."""
    state = table_state(spark, path)
    if _seen(state, batch):
        return False
    if state is None:
        return _create(spark, path, df, keys, buckets, batch)
    df = _aligned(df, state)
    rows = df.withColumn(BUCKET, _bucket_of(state["keys"], state["buckets"]))
    gen, live = _write(spark, rows, path, state["buckets"])
    if not live and batch is None:
        return False
    after = {**state, "schema": _merged_schema(state["schema"], df.schema), "batches": _batches(state, batch)}
    if live:
        after["live"] = {**state["live"], gen: live}
    _commit(spark, path, state, after)
    return True


def append_new(spark: SparkSession, path: str, df: DataFrame, keys, *, buckets: int | None = None,
               batch: tuple[str, int] | None = None) -> bool:
    """Add the rows with keys the table lacks; the first write adds all. Nothing is rewritten."""
    state = table_state(spark, path)
    if _seen(state, batch):
        return False
    if state is not None:
        df = ops.missing_rows(_read(spark, path, state), _aligned(df, state), keys)
    return append(spark, path, df, keys, buckets=buckets, batch=batch)


def merge(spark: SparkSession, path: str, changes: DataFrame, keys, *, buckets: int | None = None,
          batch: tuple[str, int] | None = None, unique: bool = False, in_sequence: bool = False) -> bool:
    """Apply changes (:func:`cdclake.operators.changes.apply_changes`); creates a missing table.

    With ``in_sequence`` the result is that of the newest change of each key, however a feed is cut into
    batches (:mod:`cdclake.operators.sequence`). What the feed has done to a key is remembered for that,
    in a table below this one.
    """
    state = table_state(spark, path)
    if _seen(state, batch):
        return False
    if in_sequence:
        changes = changes if unique else ops.require_unique(changes, keys)
        return _merge_in_sequence(spark, path, state, changes, keys, buckets, batch)
    if state is None:
        first = changes if unique else ops.require_unique(changes, keys)
        return _create(spark, path, first.where(F.col(OP) != DELETE), keys, buckets, batch)
    return _rewrite(spark, path, state, changes, keys, batch, unique, ops.merge_changes)


def _merge_in_sequence(spark: SparkSession, path: str, state: dict | None, changes: DataFrame, keys, buckets, batch) -> bool:
    """Remember the changes, then merge them.

    If the job dies in between, the same changes find themselves remembered, together with the rows from
    before, and are merged then.
    """
    memory_path = f"{path}/{_MEMORY}"
    memory = table_state(spark, memory_path)
    cached = changes.is_cached
    changes = changes if cached else changes.persist()
    told = None
    try:
        aligned = changes if state is None else _aligned(changes, state)
        touched = {s["buckets"]: set() for s in (state, memory) if s}
        for count in touched:
            touched[count] = _buckets_of(aligned, keys, count)
        small = bool(touched) and _is_small(spark, changes)
        known = None if memory is None else _read(spark, memory_path, memory, touched[memory["buckets"]])
        told = sequence.in_sequence(aligned, known, keys, small=small).persist()
        if not _seen(memory, batch):
            current = None if state is None else _read(spark, path, state, touched[state["buckets"]])
            marks = sequence.remembered(told, current, keys, small=small)
            if memory is None:
                _create(spark, memory_path, marks, keys, buckets or (state or {}).get("buckets"), batch)
            else:
                _rewrite(spark, memory_path, memory, marks, keys, batch, True, ops.merge_changes, touched=touched)
            # What others have done to the table meanwhile is no conflict yet.
            state = table_state(spark, path)
        if state is None:
            return _create(spark, path, sequence.first_rows(told), keys, buckets, batch)
        return _rewrite(spark, path, state, told, keys, batch, True, sequence.merge, sequence.HELPERS, touched)
    finally:
        if told is not None:
            told.unpersist()
        if not cached:
            changes.unpersist()


def _buckets_of(rows: DataFrame, keys, count: int) -> set[int]:
    """At most one number per bucket comes to the driver."""
    return {r[0] for r in rows.select(_bucket_of(keys, count).alias(BUCKET)).distinct().collect()}


def _is_small(spark: SparkSession, rows: DataFrame) -> bool:
    """Do persisted and computed rows suit a broadcast?"""
    return plan_bytes(rows) <= _broadcast_limit(spark)


def update(spark: SparkSession, path: str, updates: DataFrame, keys, *, batch: tuple[str, int] | None = None,
           unique: bool = False) -> bool:
    """Overwrite matched rows, add none; a missing table is logged and left alone."""
    state = table_state(spark, path)
    if state is None:
        log.error("Cannot update %s: there is no such table", path)
        return False
    if _seen(state, batch):
        return False
    return _rewrite(spark, path, state, updates, keys, batch, unique, ops.merge_updates)


def _rewrite(spark: SparkSession, path: str, state: dict, changes: DataFrame, keys, batch, unique: bool,
             merge_rows, helpers: tuple[str, ...] = (), touched: dict[int, set[int]] | None = None) -> bool:
    """Replace the files that hold keys of ``changes`` by the result of ``merge_rows``.

    ``touched`` has the buckets that changes fall into, by bucket count, where they are known.
    """
    count = _fitting_count(state)
    grown = count != state["buckets"]
    bucket, new_bucket = _bucket_of(state["keys"], state["buckets"]), _bucket_of(state["keys"], count)
    cached = changes.is_cached
    changes = changes if cached else changes.persist()
    try:
        aligned = _aligned(changes, state, helpers)
        known = touched or {}
        touched = known[state["buckets"]] if state["buckets"] in known else _buckets_of(aligned, state["keys"], state["buckets"])
        if not touched and batch is None:
            return False
        schema = _merged_schema(state["schema"], aligned.drop(*helpers).schema)
        after = {**state, "buckets": count if touched else state["buckets"], "schema": schema, "batches": _batches(state, batch)}
        if touched:
            if grown:
                touched = {b for live_buckets in state["live"].values() for b in live_buckets}
            if not unique:
                aligned = ops.require_unique(aligned, keys)
            # A small change set is broadcast: rows remaining stay in the tasks that read their
            # files and need no shuffle. Otherwise they are gathered by bucket again.
            small = _is_small(spark, changes)
            in_place = small and not grown
            before = {**state, "schema": schema}
            stored, hit = _files_hit(spark, path, before, touched, aligned, keys, small, grown)
            current = _read(spark, path, before, units=hit)
            merged = merge_rows(current, aligned, keys, small=small)
            if in_place and merged.added is not None:
                rows = merged.remaining.withColumn(BUCKET, bucket).unionByName(
                    _balanced(merged.added.withColumn(BUCKET, bucket), count)
                )
            else:
                rows = merged.rows.withColumn(BUCKET, new_bucket)
            gen, live = None, []
            if hit or merged.added is not None:
                with sized_shuffles(spark, 0 if in_place else plan_bytes(current)):
                    gen, live = _write(spark, rows, path, None if in_place else count)
            after |= _without(state, stored, hit)
            if live:
                after["live"][gen] = live
        _commit(spark, path, state, after)
        return True
    finally:
        if not cached:
            changes.unpersist()


def _files_hit(spark: SparkSession, path: str, state: dict, touched: set[int], changes: DataFrame, keys, small: bool,
               everything: bool) -> tuple[list[tuple[str, int, str]], list[tuple[str, int, str]]]:
    """All files of the buckets, and those that hold a key of the changes.

    Only key columns are read for that, and only names of files come to the driver. Where a bucket is a
    single file there is nothing to choose.
    """
    rows = _read(spark, path, state, touched)
    stored = sorted(_unit_of(f) for f in rows.inputFiles())
    if everything or len(stored) <= len(touched):
        return stored, stored
    names = [quoted(k) for k in keys]
    held = rows.select(*names, F.col("_metadata.file_path").alias("__file"))
    asked = changes.select(*[quoted(k).alias(f"__c_{k}") for k in keys])
    pairs = [(k, f"__c_{k}") for k in keys]
    if small:
        held = held.join(F.broadcast(asked), all_of([quoted(a) == quoted(b) for a, b in pairs]), "left_semi")
    else:
        held = spread_join(held, asked, pairs, "left_semi")
    return stored, sorted(_unit_of(r[0]) for r in held.select("__file").distinct().collect())


def _without(state: dict, stored: list[tuple[str, int, str]], gone: list[tuple[str, int, str]]) -> dict:
    """What is live after some files have gone. ``stored`` are all files of the folders they are in."""
    left: dict[tuple[str, int], list[str]] = {(gen, b): [] for gen, b, _ in gone}
    removed = set(gone)
    for unit in stored:
        if unit[:2] in left and unit not in removed:
            left[unit[:2]].append(unit[2])
    live = {gen: [b for b in bs if left.get((gen, b), [""])] for gen, bs in state["live"].items()}
    partial = {gen: dict(names) for gen, names in state.get("partial", {}).items()}
    for (gen, b), names in left.items():
        if names:
            partial.setdefault(gen, {})[str(b)] = sorted(names)
    return {"live": {gen: bs for gen, bs in live.items() if bs}, "partial": partial}


def overwrite_sized(df: DataFrame, path: str, gigabytes: float | None = None, cores: int = 1) -> int:
    """Overwrite plain parquet with files sized by the data; returns their number.

    Adaptive execution measures the rows and spreads them evenly over as many tasks as they fill. With
    a size given in ``gigabytes`` the number is fixed instead: twice the size in 128 MB files, rounded
    up to a multiple of the cores of an executor.
    """
    rows = df.hint("rebalance") if gigabytes is None else df.repartition(sized_files(gigabytes, cores))
    rows.write.mode("overwrite").parquet(path)
    return sum(name.endswith(".parquet") for name, _, _ in paths.entries(df.sparkSession, path))


def sized_files(gigabytes: float, cores: int) -> int:
    return max(1, math.ceil(2 * gigabytes * 1024 / 128 / cores) * cores)


# --- maintenance ------------------------------------------------------------------------------

def compact(spark: SparkSession, path: str, *, full: bool = False, target_mb: float = 128,
            buckets: int | None = None, group_bytes: int = _GROUP_BYTES) -> bool:
    """Rewrite small files into larger ones, some buckets at a time.

    Without ``full``, only buckets with more files than their size calls for. With it the whole
    table, and the bucket count is fitted to the table's size unless given. Rows follow a space-filling
    curve through the first four key columns, so that files cover narrow ranges of each of them.
    Repeated keys are spread over files by the rest of the row.

    Buckets are rewritten in groups of about ``group_bytes``, each of which is committed by itself: a job
    that dies, or meets another writer in one of its buckets (:class:`TableConflict`), keeps the groups that are
    done, and run again goes on with the others. Writers to other buckets are no conflict. A new bucket
    count moves rows between buckets, so it is committed at the end. While a writer that was refused tries
    again (:func:`with_retries`), nothing is begun or committed here; that is a :class:`TableConflict` too.
    """
    state = table_state(spark, path)
    if state is None:
        log.warning("Cannot compact %s: there is no such table", path)
        return False
    target = int(target_mb * (1 << 20))
    sizes = _bucket_files(spark, table_folders(state, path))
    if full or buckets is not None:
        chosen = set(sizes)
        count = buckets or _bucket_count(sum(size for _, size in sizes.values()))
    else:
        # One more than needed, because files do not span buckets.
        chosen = {b for b, (files, size) in sizes.items() if files > math.ceil(size / target) + 1}
        count = state["buckets"]
    if not chosen:
        return False
    groups = _bucket_groups({b: sizes[b][1] for b in chosen}, group_bytes)
    if count == state["buckets"]:
        for group in groups:
            _give_way(spark, path)
            gen, live = _clustered(spark, path, state, group, count, math.ceil(sum(sizes[b][1] for b in group) / target))
            _replace_buckets(spark, path, state, group, {gen: live} if live else {})
        return True
    _give_way(spark, path)
    written = [
        _clustered(spark, path, state, group, count, math.ceil(sum(sizes[b][1] for b in group) / target)) for group in groups
    ]
    live = {gen: found for gen, found in written if found}
    _give_way(spark, path)
    _commit(spark, path, state, {**state, "live": live, "partial": {}, "buckets": count})
    return True


def _bucket_groups(sizes: dict[int, int], most: int) -> list[set[int]]:
    """Buckets in groups of about ``most`` bytes, at least one in each."""
    groups: list[set[int]] = []
    held = 0
    for b in sorted(sizes):
        if not groups or held + sizes[b] > most:
            groups.append(set())
            held = 0
        groups[-1].add(b)
        held += sizes[b]
    return groups


def _clustered(spark: SparkSession, path: str, state: dict, chosen: set[int], count: int, files: int) -> tuple[str, list[int]]:
    """Write the rows of some buckets as a new generation, along the curve through their keys."""
    rows = _read(spark, path, state, chosen)
    keys = state["keys"][:_CURVE_KEYS]
    order = [quoted(BUCKET), quoted("__curve"), *[quoted(k) for k in keys], quoted("__rest")]
    placed = (
        rows.withColumns({BUCKET: _bucket_of(state["keys"], count), "__curve": _curve(rows, keys), "__rest": row_digest(rows)})
        .repartitionByRange(max(1, files), *order)
        .sortWithinPartitions(*order)
        .select(*[quoted(n) for n in rows.columns], BUCKET)
    )
    return _write(spark, placed, path, None)


def _curve(rows: DataFrame, keys) -> Column:
    """A row's place on a space-filling curve: the bits of its keys' range numbers in turn (Z-order).

    Ranges hold about as many rows each. They are told by a fixed choice of rows, whose number is bounded. A
    single key needs no curve.
    """
    if len(keys) < 2:
        return F.lit(0)
    names = [quoted(k) for k in keys]
    sample = rows.select(*names).orderBy(F.xxhash64(*names, F.lit(23))).limit(_CURVE_SAMPLE).collect()
    place = F.lit(0).cast("long")
    for j, key in enumerate(keys):
        kind = rows.schema[key].dataType
        if not isinstance(kind, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            continue
        number = _range_number(quoted(key), kind, sorted(r[j] for r in sample if r[j] is not None and r[j] == r[j]))
        for bit in range(_CURVE_BITS):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(keys) + j))
    return place


def _range_number(value: Column, kind: T.DataType, sample: list) -> Column:
    """The number of the range that holds a value, found by halving; nulls come first."""
    def halved(low: int, high: int) -> Column:
        if high - low == 1:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(sample[middle * len(sample) >> _CURVE_BITS]).cast(kind), halved(middle, high)).otherwise(halved(low, middle))

    return halved(0, 1 << _CURVE_BITS) if sample else F.lit(0)


def _replace_buckets(spark: SparkSession, path: str, read: dict, chosen: set[int], written: dict[str, list[int]]) -> None:
    """Commit what takes the place of some buckets, on top of whatever others have done to other buckets since."""
    for _ in range(20):
        state = table_state(spark, path)
        if state["buckets"] != read["buckets"] or table_units(state, chosen) != table_units(read, chosen):
            raise TableConflict(f"{path} has changed in the buckets being rewritten")
        kept = {g: [b for b in bs if b not in chosen] for g, bs in state["live"].items()}
        _give_way(spark, path)
        try:
            _commit(spark, path, state, {**state, "live": {g: bs for g, bs in kept.items() if bs} | written})
            return
        except TableConflict:
            time.sleep(random.uniform(0.05, 0.2))
    raise TableConflict(f"{path} changes too often")


def _bucket_files(spark: SparkSession, folders: list[str]) -> dict[int, tuple[int, int]]:
    """(files, bytes) of each bucket, from one distributed listing."""
    if not folders:
        return {}
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders)
    bucket = F.regexp_extract("path", f"{BUCKET}=(\\d+)/[^/]+$", 1).cast("int")
    sizes = listed.groupBy(bucket.alias("b")).agg(F.count("path").alias("n"), F.sum("length").alias("size"))
    return {r.b: (r.n, r["size"]) for r in sizes.collect()}


def vacuum(spark: SparkSession, path: str, retain_hours: float = 168, *, force: bool = False) -> int:
    """Delete data and version files not needed by any version of the retention period.

    Ages are those written into version files and generation names, not those of the file system. No
    retention at all would also delete what a running job writes, so it has to be forced.
    """
    if retain_hours <= 0 and not force:
        raise ValueError("Without a retention period a vacuum deletes data being written; pass force=True")
    cutoff = (time.time() - retain_hours * 3600) * 1000
    listed = _versions(spark, path)
    if not listed:
        log.warning("Cannot vacuum %s: there is no such table", path)
        return 0
    versions = [(v, _load(spark, path, v).get("committed", modified)) for v, modified in listed]
    kept = [v for v, committed in versions if committed >= cutoff]
    newest = versions[-1][0]
    # The version current when the period began is still needed by readers that started then.
    older = [v for v, committed in versions if committed < cutoff]
    kept = sorted({*kept, newest, *older[-1:]}) if retain_hours > 0 else [newest]
    states = [_load(spark, path, v) for v in kept]
    needed = {g for state in states for g in state["live"]}
    removed = _remove_replaced_files(spark, path, states, cutoff)
    for name, is_folder, modified in paths.entries(spark, f"{path}/data"):
        gen = name.partition("=")[2]
        began = int(gen[1:13], 16) if gen.startswith("t") else modified
        if is_folder and gen not in needed and began < cutoff:
            removed += paths.delete(spark, f"{path}/data/{name}")
    for version, _ in versions:
        if version not in kept:
            paths.delete(spark, f"{path}/_versions/{version:012d}.json")
    for name, _, _ in paths.entries(spark, f"{path}/{_WAITING}"):
        if int(name.partition("-")[0]) < time.time() * 1000:
            paths.delete(spark, f"{path}/{_WAITING}/{name}")
    return removed


def _remove_replaced_files(spark: SparkSession, path: str, states: list[dict], cutoff: float) -> int:
    """Delete buckets and files of live generations that no version needs: those that merges have replaced."""
    needed: dict[tuple[str, int], set[str] | None] = {}
    for state in states:
        for gen, live in state["live"].items():
            for b in live:
                names = _partial(state, gen, b)
                before = needed.get((gen, b), set())
                needed[gen, b] = None if names is None or before is None else before | set(names)
    removed = 0
    for gen in {g for g, _ in needed if int(g[1:13], 16) < cutoff}:
        for folder, _, _ in paths.entries(spark, f"{path}/data/{_GEN}={gen}"):
            bucket = folder.partition("=")[2]
            if bucket.isdigit() and (gen, int(bucket)) not in needed:
                removed += paths.delete(spark, f"{path}/data/{_GEN}={gen}/{folder}")
            elif bucket.isdigit() and needed[gen, int(bucket)] is not None:
                kept = needed[gen, int(bucket)]
                for name, is_folder, _ in paths.entries(spark, f"{path}/data/{_GEN}={gen}/{folder}"):
                    if not is_folder and name.endswith(".parquet") and name not in kept:
                        removed += paths.delete(spark, f"{path}/data/{_GEN}={gen}/{folder}/{name}")
    return removed


def list_tables(spark: SparkSession, root: str, depth: int = 2) -> list[str]:
    """Stored tables at most ``depth`` folders below ``root``."""
    if table_exists(spark, root):
        return [root]
    if depth == 0:
        return []
    return [
        found
        for name, is_folder, _ in sorted(paths.entries(spark, root))
        if is_folder
        for found in list_tables(spark, f"{root.rstrip('/')}/{name}", depth - 1)
    ]
