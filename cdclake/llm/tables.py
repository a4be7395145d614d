"""Shared helpers: scratch tables, column names that clash with nothing, streamed groups."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.llm.words import CHUNK, mixed, slices
from cdclake.session import scratch_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, label: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    return label if label.lower() not in taken else f"{label}_{uuid.uuid4().hex[:8]}"


def held_out(id_column: str) -> Column:
    """The fold that is never learned from: one in five rows by the checksum of the id."""
    return F.crc32(column(id_column).cast("string").cast("binary")) % 5 == 0


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numpy_column(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    values = batch.column(name)
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.to_numpy(zero_copy_only=False)


def give_back() -> None:
    """Hand what a task has freed back to the system: its worker serves tasks of other steps later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of rows that are equal in all columns, and the end."""
    n = len(columns[0])
    if n == 0:
        return np.zeros(1, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for values in columns:
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), n)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None],
    enough: int = 16 << 20,
) -> Iterator[pa.RecordBatch]:
    """Call ``work`` with whole groups of rows that arrive sorted by ``keys``, and where each group starts.

    At least ``enough`` bytes and the largest group are held at once; callers bound their groups.
    """
    held: list[pa.RecordBatch] = []
    size = 0

    def split(last: bool):
        table = pa.Table.from_batches(held).combine_chunks()
        bounds = runs(*[numpy_column(table, k) for k in keys])
        cut = table.num_rows if last else int(bounds[-2])
        rest = table.slice(cut)
        return table.slice(0, cut), bounds if last else bounds[:-1], rest

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= enough:
            table, bounds, rest = split(False)
            if table.num_rows:
                out = work(table, bounds)
                if out is not None and out.num_rows:
                    yield out
            held = rest.to_batches()
            size = 0
    if held:
        table, bounds, _ = split(True)
        if table.num_rows:
            out = work(table, bounds)
            if out is not None and out.num_rows:
                yield out
            del table, bounds, out
    held.clear()
    give_back()


def group_pairs(bounds: np.ndarray, limit: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All index pairs within each group, at most about ``limit`` (or one group's) at a time.

    Yields the group numbers of the pairs, and both rows.
    """
    sizes = np.diff(bounds)
    pairs = sizes * (sizes - 1) // 2
    ends = np.cumsum(pairs)
    first = 0
    while first < len(sizes):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + limit, side="right")))
        rows = np.arange(bounds[first], bounds[last])
        group = np.repeat(np.arange(first, last), sizes[first:last])
        after = bounds[group + 1] - rows - 1
        left = np.repeat(rows, after)
        step = np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
        yield np.repeat(group, after), left, left + 1 + step
        first = last


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row it is linked with, directly or not."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def with_struct(
    df: DataFrame, name: str, fields: str, start: Callable[[], Callable[[pa.Array, pa.StructArray], list[pa.Array]]],
    text: str, chunk: int = CHUNK,
) -> DataFrame:
    """Add a struct column computed from a text column; all other columns stay, whatever their names.

    ``start`` is called once per task and returns the function that makes the fields' values from texts
    and their whole rows; it is given about ``chunk`` bytes of texts at a time.
    """
    added = df.sparkSession.createDataFrame([], fields).schema
    names = added.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            rows = batch.column(0)
            texts = rows.field(text)
            for first, last in slices(texts, chunk):
                part = rows.slice(first, last - first)
                values = pa.StructArray.from_arrays(work(texts.slice(first, last - first), part), names=names)
                yield pa.RecordBatch.from_arrays([part, values], names=["row", "added"])
        give_back()

    rows = df.select(F.struct(*[column(c) for c in df.columns]).alias("row"))
    schema = T.StructType([T.StructField("row", df.schema), T.StructField("added", added)])
    return rows.mapInArrow(run, schema).select("row.*", F.col("added").alias(name))


def id_filter(ids: DataFrame, name: str, most_bits: int = 1 << 27) -> np.ndarray:
    """Bits that are set for every id of a column, and for few others while there is room.

    It may be sent to every task: it has at most ``most_bits`` bits. With more ids than these can tell
    apart it lets more pass, in the end everything, so it only ever spares work.
    """
    n = ids.count()
    words = min(most_bits, 1 << max(16, (16 * n).bit_length())) >> 6

    def bits(batches):
        own = np.zeros(words, dtype=np.uint64)
        for batch in batches:
            for at, bit in filter_bits(batch.column(0).to_numpy(zero_copy_only=False), words):
                np.bitwise_or.at(own, at, bit)
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own[used].view(np.int64))], names=["word", "bits"])

    parts = ids.select(column(name).cast("long")).mapInArrow(bits, "word long, bits long")
    table = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, dtype=np.uint64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def filter_bits(ids: np.ndarray, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Word and bit of each id for each of two hashes."""
    hashes = [mixed(ids.astype(np.int64).view(np.uint64), seed) for seed in (1, 2)]
    return [((h >> np.uint64(6)) % np.uint64(words), np.uint64(1) << (h & np.uint64(63))) for h in hashes]


def passes(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    (a, x), (b, y) = filter_bits(ids, len(bits))
    return ((bits[a] & x) != 0) & ((bits[b] & y) != 0)
