"""Best-two-fit packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.tables import column, shuffle_tasks, with_struct, written
from cdclake.llm.tokens import WordEncoder

CAPACITY = 2048
SEPARATOR = 0


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str, text: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): documents as ids and a separator, cut if too long.

    The tokenizer file must be where every executor finds it.
    """

    def start():
        # Spark runs a task per core already; the library's own threads would only take memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = WordEncoder(tokenizer, added=True)

        def pieces(texts: pa.Array, _) -> list[pa.Array]:
            ids, at = encoder.encode(texts)
            starts, lengths, sums, counts = [], [], [], [0]
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.append(ids[a:b], SEPARATOR).astype("<u4")
                for first in range(0, len(own), capacity):
                    cut = own[first : first + capacity]
                    starts.append(first)
                    lengths.append(len(cut))
                    sums.append(zlib.crc32(cut.tobytes()))
                counts.append(len(starts))
            edges = pa.array(counts, pa.int32())
            return [pa.ListArray.from_arrays(edges, pa.array(x, pa.int64())) for x in (starts, lengths, sums)]

        return pieces

    ids = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    cut = with_struct(ids, "p", "start array<long>, length array<long>, ids_crc32 array<long>", start, "text", 1 << 19)
    zipped = F.arrays_zip(F.col("p.start").alias("start"), F.col("p.length").alias("length"), F.col("p.ids_crc32").alias("ids_crc32"))
    return cut.select("doc_id", F.posexplode(zipped).alias("piece", "p")).select("doc_id", "piece", "p.*")


def plan_bins(counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Fill bins with ``counts[n]`` pieces of each length n: rows of (bins, pieces of each length per bin).

    Best-two-fit. A bin takes the largest pieces that fit, one after the other. Then its smallest piece
    is replaced by two that together fill its expanded gap best, if they fill it better than it did. A
    bin is repeated as long as the pieces last: the next ones would come out alike, as choices depend
    only on which lengths are left. So the plan grows with the capacity, not with the pieces.
    """
    left = counts.astype(np.int64).copy()
    plan = []
    while left.any():
        taken: dict[int, int] = {}
        gap = capacity
        while gap > 0:
            fits = np.flatnonzero(left[1 : gap + 1]) + 1
            fits = fits[::-1]
            size = next((int(n) for n in fits[: len(taken) + 1] if left[n] > taken.get(int(n), 0)), 0)
            if not size:
                break
            # As many of this length as fit: the largest that fits stays the same while there are any.
            n = min(gap // size, int(left[size]) - taken.get(size, 0))
            taken[size] = taken.get(size, 0) + n
            gap -= n * size
        smallest = min(taken)
        best = _best_two(left, taken, gap + smallest) if gap else (0, 0)
        if sum(best) > smallest:
            taken[smallest] -= 1
            for size in best:
                taken[size] = taken.get(size, 0) + 1
            taken = {size: n for size, n in taken.items() if n}
        bins = min(int(left[size]) // n for size, n in taken.items())
        for size, n in taken.items():
            left[size] -= bins * n
        plan.append((bins, taken))
    return plan


def _best_two(left: np.ndarray, taken: dict[int, int], gap: int) -> tuple[int, int]:
    """The two lengths with free pieces that fill a gap best; of equal ones that with the longest piece."""
    free = left[: gap + 1].copy()
    for size, n in taken.items():
        if size <= gap:
            free[size] -= n
    sizes = np.flatnonzero(free > 0)
    if not len(sizes):
        return 0, 0
    # For each length the largest partner that fits; a length with one free piece is not its own partner.
    at = np.searchsorted(sizes, gap - sizes, side="right") - 1
    at = np.where((at >= 0) & (sizes[at] == sizes) & (free[sizes] < 2), at - 1, at)
    total = np.where(at >= 0, sizes + sizes[at], 0)
    k = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(sizes[k]), int(sizes[at[k]])) if total[k] else (0, 0)


def _slots(plan: list[tuple[int, dict[int, int]]]) -> list[tuple]:
    """(length, first rank, end, pieces per bin, first bin, first offset): where the pieces of each length go."""
    used: dict[int, int] = {}
    rows, first_bin = [], 0
    for bins, taken in plan:
        offset = 0
        for size in sorted(taken, reverse=True):
            rank = used.get(size, 0)
            rows.append((size, rank, rank + bins * taken[size], taken[size], first_bin, offset))
            used[size] = rank + bins * taken[size]
            offset += taken[size] * size
        first_bin += bins
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Only the number of pieces of each length (at most ``capacity`` numbers) comes to the driver, where
    the bins are planned for all pieces at once. Pieces are then numbered within their length and
    looked up in the plan. Numbers are made from counts per length and bucket, so pieces of one length
    spread over tasks, however many there are; equal rows are told apart by these numbers only. The plan
    has at most some ten rows per length, so it is broadcast.
    """
    spark = pieces.sparkSession
    keys = [c for c in pieces.columns if c != "length"]
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(shuffle_tasks(spark))))
    cells = written(pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    slots = _slots(plan_bins(counts, capacity))
    slots = spark.createDataFrame(
        slots, "length long, first long, end long, each long, first_bin long, first_offset long"
    )
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = cells.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy(*keys)
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(base, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base"))
    found = ranked.join(F.broadcast(slots), ["length"]).filter("rank >= first AND rank < end")
    step = F.col("rank") - F.col("first")
    return found.select(
        *[column(c) for c in pieces.columns if c != "bucket"],
        (F.col("first_bin") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + step % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
) -> DataFrame:
    """Documents as token ids, each followed by a separator, in as few sequences as best-two-fit needs.

    Documents longer than ``capacity`` are cut into pieces of that length and a rest, others are not cut.
    A null or empty text is one separator. Rows with a null or a repeated id are packed like all others.
    Added tokens of the file that a text spells are one id each. No documents: no rows. Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (checksum
    of the piece's ids as unsigned 32-bit little-endian numbers), ``sequence_id``, ``offset``.
    """
    if not os.path.isfile(tokenizer):
        raise FileNotFoundError(tokenizer)
    return pack(written(token_pieces(docs, tokenizer, doc_id, text, capacity), "pieces"), capacity)
