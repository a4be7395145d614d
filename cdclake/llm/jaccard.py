"""Similarity join of texts on word n-grams: MinHash banding, then exact Jaccard on the full sets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.components import components
from cdclake.llm.tables import (
    column, group_pairs, id_filter, local_roots, numpy_column, passes, runs, shuffle_tasks, whole_groups, with_struct, written,
)
from cdclake.llm.words import Words, band_hashes, choose_bands, min_hashes, slices

NGRAM = 5
SIMILARITY = 0.8
RECALL = 0.999
MOST_HASHES = 128
#: Members and words of a bucket that about make up a block; tasks hold two blocks at once.
BLOCK = 256
BLOCK_WORDS = 1 << 20
_CELLS = 4 << 20
_GROUP = ["bucket", "block_a", "block_b"]


def _digests(words: Words) -> pa.Array:
    joined = np.stack(words.digests(), axis=1).tobytes()
    return pa.array([joined[i : i + 16] for i in range(0, len(joined), 16)], pa.binary())


def signatures(
    docs: DataFrame, name: str, text: str, ngram: int, bands: int, rows: int,
) -> DataFrame:
    """Every row with a struct: ``digest`` of its sequence of words, ``n`` words, ``bands`` hashes (none without words)."""

    def start():
        def sign(texts: pa.Array, _) -> list[pa.Array]:
            words = Words(texts)
            n = np.diff(words.first)
            shingles, at = words.shingles(ngram)
            hashes = band_hashes(min_hashes(shingles, at, bands * rows), bands, rows)
            # A bucket is a hash with its band in the low byte.
            hashes = (hashes & ~np.uint64(255) | np.arange(bands, dtype=np.uint64)).view(np.int64)
            counts = np.append(0, np.cumsum(np.where(n > 0, bands, 0)))
            return [
                _digests(words), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(hashes[n > 0].ravel())),
            ]

        return sign

    return with_struct(docs, name, "digest binary, n long, bands array<long>", start, text)


def in_blocks(members: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Spread buckets of any size over groups of at most about two blocks, so that all pairs meet once.

    A bucket is cut into blocks of about ``BLOCK`` members and ``BLOCK_WORDS`` words (column ``n``, if
    there is one) by a hash of ``by``; each pair of blocks, and each block with itself, is a group
    (``block_a`` <= ``block_b``). Buckets with one member go. Sizes are counted before any shuffle.
    """
    words = F.sum("n") if "n" in members.columns else F.lit(0)
    sizes = members.groupBy(*keys).agg(F.count("*").alias("members"), words.alias("words"))
    parts = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("words") / BLOCK_WORDS)).cast("int")
    parts = F.least(parts, F.col("members").cast("int"))
    own = F.pmod(F.xxhash64(by, F.lit(11)), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (
        members.join(sizes.filter("members > 1"), keys)
        .withColumn("parts", parts).withColumn("own", own).withColumn("other", other)
        .withColumn("block_a", F.least("own", "other")).withColumn("block_b", F.greatest("own", "other"))
        .drop("members", "words", "parts", "other")
    )


def by_group(df: DataFrame) -> DataFrame:
    """Groups of blocks as sorted runs within tasks."""
    return df.repartition(shuffle_tasks(df.sparkSession), *_GROUP).sortWithinPartitions(*_GROUP)


def _bucket_pairs(table: pa.Table, bounds: np.ndarray):
    """Pairs of a table's groups that belong to this bucket: those that collide in no earlier band."""
    bands = table.column("bands").combine_chunks()
    hashes = bands.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
    band = numpy_column(table, "bucket") & 255
    rep, own = numpy_column(table, "rep"), numpy_column(table, "own")
    across = numpy_column(table, "block_a") != numpy_column(table, "block_b")
    for _, left, right in group_pairs(bounds):
        # Between two blocks only pairs across: those within a block meet in its own group.
        keep = (~across[left] | (own[left] != own[right])) & (rep[left] != rep[right])
        left, right = left[keep], right[keep]
        earlier = np.zeros(len(left), dtype=bool)
        for other in range(hashes.shape[1]):
            earlier |= (other < band[left]) & (hashes[left, other] == hashes[right, other])
        yield left[~earlier], right[~earlier]


def _needed(batches):
    def rows(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        used = np.zeros(table.num_rows, dtype=bool)
        for left, right in _bucket_pairs(table, bounds):
            used[left] = used[right] = True
        return table.filter(pa.array(used)).combine_chunks().to_batches()[0] if used.any() else None

    yield from whole_groups(batches, _GROUP, rows)


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    if len(left) <= 64:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right, strict=True)])
    # Only values of at least two sets can be shared: a table of sets by such values, some columns at a time.
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    distinct, number, count = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    keep = count[number] > 1
    number, owner = rank[number[keep]], owner[keep]
    width = max(1, _CELLS // len(sets))
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    for low in range(0, int((count > 1).sum()), width):
        a, b = np.searchsorted(number, [low, low + width])
        cells = np.zeros((len(sets), width), dtype=np.float32)
        cells[owner[a:b], number[a:b] - low] = 1
        total += cells @ cells.T
    return total[left, right].astype(np.int64)


def _verify(similarity: float):
    def rows(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("set").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        copies = numpy_column(table, "copies")
        links = np.zeros(table.num_rows, dtype=np.int64)
        ends = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        starts = bounds[:-1]
        for left, right in _bucket_pairs(table, bounds):
            # Sets whose sizes differ too much cannot reach the similarity.
            small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
            near = small / large >= similarity
            left, right = left[near], right[near]
            group = np.searchsorted(starts, left, side="right") - 1
            for a, b in zip((at := runs(group))[:-1], at[1:], strict=True) if len(left) else ():
                low, high = bounds[group[a]], bounds[group[a] + 1]
                both = _shared(sets[low:high], left[a:b] - low, right[a:b] - low)
                union = sizes[left[a:b]] + sizes[right[a:b]] - both
                linked = both / union >= similarity
                ends[0].append(left[a:b][linked])
                ends[1].append(right[a:b][linked])
        left, right = np.concatenate(ends[0]), np.concatenate(ends[1])
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        rep = numpy_column(table, "rep")
        root = rep[local_roots(table.num_rows, left, right)]
        found = links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(rep[found]), pa.array(links[found]), pa.array(root[found])], names=["rep", "links", "root"]
        )

    return lambda batches: whole_groups(batches, _GROUP, rows)


def full_sets(docs: DataFrame, bits: np.ndarray, ngram: int) -> DataFrame:
    """Rows (digest, set) of documents whose id passes a filter: their distinct n-gram hashes, sorted, as bytes."""

    def sets(batches):
        for batch in batches:
            batch = batch.filter(pa.array(passes(batch.column(0).to_numpy(zero_copy_only=False), bits)))
            for first, last in slices(batch.column(1)):
                words = Words(batch.column(1).slice(first, last - first))
                shingles, at = words.shingles(ngram)
                distinct = [np.unique(shingles[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([_digests(words), pa.array(distinct, pa.binary())], names=["digest", "set"])

    made = docs.filter("doc_id IS NOT NULL").mapInArrow(sets, "digest binary, set binary")
    return made.groupBy("digest").agg(F.first("set").alias("set"))


def linked_classes(
    classes: DataFrame, members: DataFrame, sets: Callable[[np.ndarray], DataFrame], similarity: float,
) -> DataFrame:
    """Rows (rep, links, root) of classes with similar ones: sums of links and a spanning forest, in parts.

    ``classes`` has (digest, rep, copies, bands), ``members`` a row (digest, bucket) per band, and ``sets``
    gives the full sets (digest, set) of classes whose ``rep`` passes a filter. Buckets are counted and
    cut with small rows; only members of shared buckets get their bands, and of these only those with
    pairs to verify their sets.
    """
    shared = in_blocks(members, ["bucket"], "digest").drop("n")
    grouped = by_group(shared.join(classes.select("digest", "rep", "copies", "bands"), "digest"))
    needed = written(grouped.mapInArrow(_needed, grouped.schema), "candidates")
    bits = id_filter(needed.select("rep").distinct(), "rep")
    full = by_group(needed.join(sets(bits), "digest"))
    return written(full.mapInArrow(_verify(similarity), "rep long, links long, root long"), "links")


def ngram_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, ngram: int = NGRAM,
    recall: float = RECALL, most_hashes: int = MOST_HASHES,
) -> DataFrame:
    """One row per document: its class, its links and its group of near-duplicates.

    Two documents are linked if the Jaccard similarity of their sets of ``ngram``-word shingles is at
    least ``similarity``; a text of fewer words, but not none, is one shingle. Columns: ``doc_id``;
    ``class_id``, the smallest id among documents with the same sequence of words; ``n_links``, other
    documents linked directly; ``component_id``, the smallest id reachable by links; ``kept``, the
    document is that one.

    Documents with equal words are one class and are compared once. Bands and rows of MinHash values are
    chosen to find a pair at the threshold with probability ``recall``, with the most rows that
    ``most_hashes`` allow. Buckets are cut into blocks, so none is ever in one task as a whole; a pair is
    verified in the first band it collides in, inside the task, and only sums of links and a spanning
    forest leave it. Full sets are made and moved only for classes with such pairs.

    Texts that are null or without words link with nothing and are classes of their own. Documents
    without an id are not compared (null class and component, no links, kept). Rows that share an id are
    one document: their links are added up, their groups joined.
    """
    bands, rows = choose_bands(similarity, recall, most_hashes)
    ids = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).cast("string").alias("text"))
    signed = written(
        signatures(ids, "s", "text", ngram, bands, rows).select("doc_id", "s.digest", "s.n", "s.bands"), "signatures"
    )
    named = signed.filter("doc_id IS NOT NULL AND n > 0")
    classes = named.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = written(classes, "classes")

    members = classes.select("digest", "n", F.explode("bands").alias("bucket"))
    found = linked_classes(classes, members, lambda bits: full_sets(ids, bits, ngram), similarity)

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found, "rep", "root").withColumnRenamed("node", "rep")
    joined = classes.select("digest", "rep", "copies").join(links, "rep", "left").join(groups, "rep", "left")
    out = signed.select("doc_id", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("digest")).alias("digest"))
    return out.join(joined, "digest", "left").select(
        "doc_id",
        F.coalesce("rep", "doc_id").alias("class_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "rep", "doc_id"), F.lit(True)).alias("kept"),
    )
