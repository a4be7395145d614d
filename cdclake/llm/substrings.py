"""Repeated byte strings: an enhanced suffix array over sampled suffixes, scanned as a tree of intervals."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm.tables import column, id_filter, numpy_column, passes, shuffle_tasks, whole_groups, with_struct, written
from cdclake.llm.words import SpanHash, slices, text_buffer

LENGTH = 400
#: Suffixes are sampled by the hashes of this many bytes at their start.
GRAM = 64
#: Sampled suffixes with the same first bytes that one task sorts; more are compared window by window.
MOST_SUFFIXES = 1 << 16
_SEGMENT = 4 << 20
_PLACE = (1 << 24) - 1


def sampled_suffixes(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of suffixes, and the hashes of their first ``gram`` bytes.

    Of all places in a string of ``length`` bytes at which ``gram`` bytes fit, that with the least hash
    is taken, of equal ones the first. So equal strings, wherever they are, have a sampled suffix at the
    same offset; some two in each string are enough.
    """
    width = length - gram + 1
    places, hashes = [], []
    for low in range(0, max(0, len(data) - length + 1), _SEGMENT):
        part = data[low : low + _SEGMENT + length - 1]
        start = np.arange(len(part) - gram + 1)
        values = SpanHash(part).of(start, start + gram)
        keys = values & ~np.uint64(_PLACE) | start.astype(np.uint64)
        padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[: len(keys)] = keys
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - length + 1
        least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
        # Strings must be inside one text.
        owner = np.searchsorted(at, low + np.arange(n), side="right")
        least = least[low + np.arange(n) + length <= at[owner]]
        if len(least):
            own = (least & np.uint64(_PLACE)).astype(np.int64)
            own = np.unique(own)
            places.append(own + low)
            hashes.append(values[own])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    found, first = np.unique(np.concatenate(places), return_index=True)
    return found, np.concatenate(hashes)[first]


def _sample(length: int, gram: int):
    def start():
        def sample(texts: pa.Array, _) -> list[pa.Array]:
            data, at = text_buffer(texts)
            places, hashes = sampled_suffixes(data, at, length, gram)
            owner = np.searchsorted(at, places, side="right") - 1
            edges = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
            values = hashes.view(np.int64), places - at[owner]
            return [pa.ListArray.from_arrays(edges, pa.array(v, pa.int64())) for v in values]

        return sample

    return start


def _key(name: str = "digest"):
    """The first 8 bytes of a digest as a number."""
    return F.conv(F.hex(F.substring(F.col(name), 1, 8)), 16, -10).cast("long")


def _candidates(batches, bits: np.ndarray):
    """Texts go on only with documents that may have candidates."""
    for batch in batches:
        keep = passes(numpy_column(batch, "key"), bits)
        text = batch.column(batch.schema.get_field_index("text"))
        for low, high in slices(text):
            part = batch.slice(low, high - low)
            kept = pa.array(np.where(keep[low:high], np.arange(high - low), -1), mask=~keep[low:high])
            columns = [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "digest", "n_bytes")]
            yield pa.RecordBatch.from_arrays([*columns, text.slice(low, high - low).take(kept)], names=["doc_id", "digest", "n_bytes", "text"])


def _located(batch: pa.RecordBatch):
    """Each text of a batch with its digest and the grams and places of its suffixes, some texts at a time."""
    text, digest, found = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "digest", "found"))
    for low, high in slices(text, 1 << 19):
        data, at = text_buffer(text.slice(low, high - low))
        lists = found.slice(low, high - low)
        edges = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
        flat = lists.flatten()
        grams, places = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("gram", "place"))
        names = digest.slice(low, high - low).to_pylist()
        for k in range(high - low):
            own = slice(edges[k], edges[k + 1])
            yield data[at[k] : at[k + 1]], names[k], grams[own], places[own]


def _contexts(length: int, gram: int):
    """For each candidate suffix its first ``length`` bytes, and the bytes before it, backwards."""
    names = ["gram", "digest", "place", "right", "left"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def rows(batches):
        for batch in batches:
            out = []
            for data, digest, grams, places in _located(batch):
                data = data.tobytes()
                for g, p in zip(grams.tolist(), places.tolist(), strict=True):
                    out.append((g, digest, p, data[p : p + length], data[max(0, p - length + gram) : p][::-1]))
                    if len(out) == 4096:
                        yield batch_of(out)
                        out = []
            if out:
                yield batch_of(out)

    return rows


class _Strings:
    """Byte strings of bounded length as a matrix, to compare many pairs at once."""

    def __init__(self, values: pa.Array):
        data, at = text_buffer(values)
        self.size = np.diff(at)
        self.cells = np.zeros((len(values), int(self.size.max(initial=0)) + 1), dtype=np.uint8)
        row = np.repeat(np.arange(len(values)), self.size)
        self.cells[row, np.arange(len(data)) - at[:-1][row]] = data

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common beginnings of pairs."""
        out = np.zeros(len(a), dtype=np.int64)
        for k in range(0, len(a), 16384):
            x, y = a[k : k + 16384], b[k : k + 16384]
            differ = self.cells[x] != self.cells[y]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), self.cells.shape[1])
            out[k : k + 16384] = np.minimum(first, np.minimum(self.size[x], self.size[y]))
        return out


def lcp_intervals(lcp: np.ndarray, least: int):
    """The intervals of a suffix array by one scan with a stack: (common length, first row, last row).

    ``lcp[i]`` is the common length of rows i and i + 1. An interval's rows share a beginning of exactly
    that length, and no row outside it does. Only lengths of at least ``least``.
    """
    stack: list[tuple[int, int]] = []
    for row, value in enumerate([*lcp.tolist(), 0]):
        first = row
        while stack and stack[-1][0] > value:
            common, first = stack.pop()
            yield common, first, row
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def _repeats(length: int, gram: int):
    """Repeated strings of at least ``length`` bytes around suffixes that arrive sorted: a row per occurrence."""

    def rows(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch | None:
        right, left = (_Strings(table.column(c).combine_chunks()) for c in ("right", "left"))
        n = table.num_rows
        lcp = right.common(np.arange(n - 1), np.arange(1, n))
        sizes = np.diff(bounds)
        # How far the repeated strings around each suffix reach; all of them hold its beginning, so they
        # are one span. And the group of the longest.
        before, after = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        longest, group_of = np.zeros(n, dtype=np.int64), np.arange(n)

        def reach(row: np.ndarray, left_size: np.ndarray, right_size: np.ndarray, group: np.ndarray) -> None:
            before[row] = np.maximum(before[row], left_size)
            after[row] = np.maximum(after[row], right_size)
            better = left_size + right_size > longest[row]
            longest[row[better]] = (left_size + right_size)[better]
            group_of[row[better]] = group[better]

        # Pairs are most of all groups; their only interval is the pair itself.
        a = bounds[:-1][sizes == 2]
        shared = left.common(a, a + 1)
        found = (lcp[a] >= gram) & (shared + lcp[a] >= length)
        a, shared = a[found], shared[found]
        reach(a, shared, lcp[a], a)
        reach(a + 1, shared, lcp[a], a)
        for low, high in zip(bounds[:-1][sizes > 2].tolist(), bounds[1:][sizes > 2].tolist(), strict=True):
            order = np.array(sorted(range(low, high), key=lambda r: left.cells[r].tobytes()))
            rank = np.empty(high - low, dtype=np.int64)
            rank[order - low] = np.arange(high - low)
            for common, first, last in lcp_intervals(lcp[low : high - 1], gram):
                members = np.arange(low + first, low + last + 1)
                members = members[np.argsort(rank[members - low])]
                # Left extensions: in the order of what stands before them, neighbours share the most.
                shared = left.common(members[:-1], members[1:])
                far = np.maximum(np.append(0, shared), np.append(shared, 0))
                # A group ends where the next one shares too little: what is common to it extends no further.
                number = np.append(0, np.cumsum(shared + common < length))
                group = members[np.searchsorted(number, number)]
                hit = far + common >= length
                reach(members[hit], far[hit], np.full(hit.sum(), common), group[hit])
        row = np.flatnonzero(longest)
        if not len(row):
            return None
        place = numpy_column(table, "place")
        digests = table.column("digest").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [
                digests.take(pa.array(row)), pa.array(place[row] - before[row]), pa.array(place[row] + after[row]),
                digests.take(pa.array(group_of[row])), pa.array(place[group_of[row]]),
            ],
            names=["digest", "start", "end", "group_digest", "group_place"],
        )

    return lambda batches: whole_groups(batches, ["gram"], rows, 8 << 20)


_SPAN = "digest binary, start long, end long, group_digest binary, group_place long"


def _windows(length: int, gram: int):
    """Every string of ``length`` bytes around suffixes: two hashes and where it starts."""

    def rows(batches):
        for batch in batches:
            for data, digest, _, places in _located(batch):
                start = np.unique((places[:, None] - np.arange(length - gram + 1)).ravel())
                start = start[(start >= 0) & (start + length <= len(data))]
                hashes = SpanHash(data).of(start, start + length, 3), SpanHash(data, 0xC2B2AE3D27D4EB4F).of(start, start + length, 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[0].view(np.int64)), pa.array(hashes[1].view(np.int64)),
                     pa.array([digest] * len(start), pa.binary()), pa.array(start, pa.int64())],
                    names=["w1", "w2", "digest", "start"],
                )

    return rows


def _looked_up(rows: DataFrame, often: DataFrame, keys: list[str], count: str, most: int) -> DataFrame:
    """Rows with what is known of their keys.

    Rows of a key that has more than ``most`` of them are not shuffled, as they would all meet in one task: they
    look it up where they are. There is at most one such key in ``most`` rows, so every task may have them all.
    """
    many = F.broadcast(often.filter(F.col(count) > most))
    few = rows.join(many, keys, "left_anti").join(often.filter(F.col(count) <= most), keys)
    return rows.join(many, keys).unionByName(few)


def repeated_spans(prepared: DataFrame, suffixes: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """Spans (digest, start, end, group) of texts that repeat elsewhere, from suffixes with shared beginnings."""
    tasks = shuffle_tasks(prepared.sparkSession)
    once = prepared.filter("text IS NOT NULL")

    def located(chosen: DataFrame) -> DataFrame:
        found = chosen.groupBy("digest", "rep").agg(F.collect_list(F.struct("gram", "place")).alias("found"))
        same = (once["digest"] == found["digest"]) & once["doc_id"].eqNullSafe(found["rep"])
        return once.join(found, same).select(once["digest"], "text", "found")

    contexts = located(suffixes.filter(F.col("members") <= most)).mapInArrow(
        _contexts(length, gram), "gram long, digest binary, place long, right binary, left binary"
    ).dropDuplicates(["gram", "digest", "place"])
    ordered = contexts.repartition(tasks, "gram").sortWithinPartitions("gram", "right")
    spans = ordered.mapInArrow(_repeats(length, gram), _SPAN)
    # Too many suffixes for one task: all strings around them are counted by their hashes, wherever they are.
    windows = located(suffixes.filter(F.col("members") > most)).mapInArrow(
        _windows(length, gram), "w1 long, w2 long, digest binary, start long"
    ).dropDuplicates(["w1", "w2", "digest", "start"])
    often = windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(F.struct("digest", "start")).alias("g")).filter("n > 1")
    more = _looked_up(windows, often, ["w1", "w2"], "n", most).select(
        "digest", "start", (F.col("start") + length).alias("end"), F.col("g.digest").alias("group_digest"), F.col("g.start").alias("group_place")
    )
    return spans.unionByName(more)


def _cut(batches):
    """Join the spans of each text to maximal ones and remove these; texts that have none are as their digest says."""
    for batch in batches:
        column_of = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        data, at = text_buffer(column_of["text"])
        spans = column_of["spans"]
        counts = np.nan_to_num(pa.compute.list_value_length(spans).to_numpy(zero_copy_only=False)).astype(np.int64)
        edges = np.append(0, np.cumsum(counts))
        flat = spans.flatten()
        start, end = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "end"))
        kept = [d.hex() for d in column_of["digest"].to_pylist()]
        runs, firsts, lasts = np.zeros(batch.num_rows, dtype=np.int64), [], []
        for row in np.flatnonzero(counts).tolist():
            text = data[at[row] : at[row + 1]]
            change = np.zeros(len(text) + 1, dtype=np.int32)
            np.add.at(change, start[edges[row] : edges[row + 1]], 1)
            np.add.at(change, end[edges[row] : edges[row + 1]], -1)
            gone = np.cumsum(change[:-1]) > 0
            turns = np.flatnonzero(np.diff(gone, prepend=False, append=False))
            firsts.append(turns[::2])
            lasts.append(turns[1::2])
            runs[row] = len(turns) // 2
            kept[row] = hashlib.sha256(text[~gone].tobytes()).hexdigest()
        none = np.zeros(0, dtype=np.int64)
        removed = pa.StructArray.from_arrays([pa.array(np.concatenate([none, *x])) for x in (firsts, lasts)], names=["start", "end"])
        removed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(runs)), pa.int32()), removed)
        yield pa.RecordBatch.from_arrays(
            [column_of["doc_id"], column_of["n_bytes"], removed, pa.array(kept, pa.string())],
            names=["doc_id", "n_bytes", "spans", "kept_sha256"],
        )


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST_SUFFIXES,
) -> DataFrame:
    """Every document with the places of all bytes of repeated strings, and the digest of what is left without them.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in the same
    document or another. Columns: ``doc_id``, ``n_bytes``, ``spans`` (maximal removed runs in order, each
    from the byte ``start`` to before the byte ``end``), ``kept_sha256`` (of the remaining bytes).

    Suffixes are sampled so that equal strings have one at the same offset. Those whose first ``gram``
    bytes occur again are sorted in tasks by these bytes, with the common length of neighbours; a scan
    with a stack gives the intervals of suffixes with a common beginning; within each, suffixes that
    share enough of what stands before them are a repeat group. A common beginning with more than
    ``most`` suffixes is not put into one task: its strings are counted by 128-bit hashes instead, and
    the occurrences of one of them are not put into one task either.

    Equal texts are one text here; if it is long enough, all of it is repeated. A null text is empty; an
    empty or short text keeps all its bytes. Rows with null or repeated ids are documents like others.
    """
    rows = docs.select(column(doc_id).alias("doc_id"), F.coalesce(column(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).withColumn("n_bytes", F.octet_length("text").cast("long"))
    long_enough = rows.filter(F.col("n_bytes") >= length)
    sampled = with_struct(long_enough, "s", "grams array<long>, places array<long>", _sample(length, gram), "text")
    sampled = written(sampled.select("doc_id", "digest", "n_bytes", "s.grams", "s.places"), "suffixes")
    texts = sampled.groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.first("n_bytes").alias("n_bytes"),
        F.first("grams").alias("grams"), F.first("places").alias("places"),
    )
    zipped = F.arrays_zip(F.col("grams").alias("gram"), F.col("places").alias("place"))
    single = texts.select("digest", "rep", F.explode(zipped).alias("s")).select("digest", "rep", "s.gram", "s.place")
    often = single.groupBy("gram").agg(F.count("*").alias("members")).filter("members > 1")
    suffixes = written(_looked_up(single, often, ["gram"], "members", most), "repeated")
    whole = written(texts.filter("copies > 1").select("digest", F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")), "copies")

    wanted = suffixes.select("digest").union(whole.select("digest")).distinct().select(_key().alias("key"))
    bits = id_filter(wanted, "key")
    ids = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"
    prepared = written(rows.withColumn("key", _key()).mapInArrow(
        lambda batches: _candidates(batches, bits), f"{ids}, digest binary, n_bytes long, text string"
    ), "candidates")
    spans = repeated_spans(prepared, suffixes, length, gram, most).select("digest", "start", "end").union(whole)
    spans = spans.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = prepared.join(spans, "digest", "left").select("doc_id", "digest", "n_bytes", "text", "spans")
    return joined.mapInArrow(_cut, f"{ids}, n_bytes long, spans array<struct<start: long, end: long>>, kept_sha256 string")


def span_counts() -> list[Column]:
    """How many bytes the spans of a document hold, and how many spans there are."""
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return [size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans")]


def remove_repeats(docs: DataFrame, *args, **options) -> DataFrame:
    """``without_repeats`` in numbers: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    return without_repeats(docs, *args, **options).select("doc_id", "n_bytes", *span_counts(), "kept_sha256")
