"""Repeated passages: MinHash banding of paragraphs, exact Jaccard, clusters by components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.components import components
from cdclake.llm.jaccard import linked_classes
from cdclake.llm.tables import column, passes, with_struct, written
from cdclake.llm.words import SpanHash, Words, band_hashes, choose_bands, min_hashes, mixed, slices

NGRAM = 5
SIMILARITY = 0.8
RECALL = 0.99
#: Paragraphs have few shingles: more hashes would cost more than the dissimilar pairs they keep apart.
MOST_HASHES = 16
LEAST_WORDS = 8
LEAST_RUN = 16
#: Of so many sentence ends in a row at least one ends a paragraph.
ENDS = 3
LONG_SENTENCE = 24
#: Of so many words in a row at least one ends a paragraph where lines are short.
SHORT_LINES = 16


class Paragraphs:
    """The paragraphs of a batch: word bounds, the text each is in, its number there, and its key.

    A paragraph ends at a line break, and at some ends of sentences within a line: of every ``ENDS``
    sentence ends in a row at that whose last words have the least hash. Long sentences have ends after
    one word in eight, chosen by hash. So a passage is cut alike wherever it stands, also in the middle
    of a line, but for its first and last sentences.

    Breaks between lines of fewer than ``least`` words do not count. Such lines, as of verse, menus or
    code, are one stretch, and of every ``SHORT_LINES`` words in a row there that with the least hash ends
    a paragraph.
    """

    def __init__(self, texts: pa.Array, least: int = LEAST_WORDS):
        self.words = words = Words(texts)
        n = len(words)
        stops, breaks = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
        stops[[ord(c) for c in ".!?\n"]] = True
        breaks[ord("\n")] = True
        last = np.ones(n, dtype=bool)
        last[:-1] = words.text[1:] != words.text[:-1]
        ends, hard = last.copy(), last.copy()
        for table, found in ((stops, ends), (breaks, hard)):
            count = np.append(0, np.cumsum(table[words.data]))
            found[:-1] |= count[words.start[1:]] != count[words.end[:-1]]
        # Of ends right behind each other, as after words of a shouted text, only the first counts.
        ends[1:] &= ~ends[:-1] | hard[1:]
        # A long sentence has further ends, after words that any text with it would choose.
        sentence = np.append(0, np.cumsum(ends)[:-1]) if n else np.zeros(0, dtype=np.int64)
        long = np.bincount(sentence)[sentence] > LONG_SENTENCE if n else ends
        ends |= long & (mixed(words.hash, 9) % np.uint64(8) == 0)
        at = np.flatnonzero(ends)
        before = np.maximum(at - 1, 0)
        key = mixed(words.hash[at] * np.uint64(3) + words.hash[before], 5)
        chosen = hard[at].copy()
        if len(at) >= ENDS:
            window = np.lib.stride_tricks.sliding_window_view(key, ENDS)
            together = words.text[at[ENDS - 1 :]] == words.text[at[: len(at) - ENDS + 1]]
            chosen[(np.arange(len(window)) + window.argmin(axis=1))[together]] = True
        cut = np.zeros(n, dtype=bool)
        cut[at[chosen]] = True
        if n:
            line = np.append(0, np.cumsum(hard)[:-1])
            short = np.bincount(line)[line] < least
            between = np.append(short[:-1] & short[1:], False) & ~last
            cut[short] = (hard & ~between)[short]
            stretch = np.append(0, np.cumsum(hard & ~between)[:-1])
            window = np.arange(SHORT_LINES)
            first = np.flatnonzero(short[: max(0, n - SHORT_LINES + 1)])
            first = first[stretch[first] == stretch[first + SHORT_LINES - 1]]
            for low in range(0, len(first), 65536):
                words_at = first[low : low + 65536, None] + window
                key = mixed(words.hash[words_at] * np.uint64(3) + words.hash[np.maximum(words_at - 1, 0)], 5)
                cut[words_at[:, 0] + key.argmin(axis=1)] = True
        self.bounds = np.append(0, np.flatnonzero(cut) + 1)
        self.text = words.text[self.bounds[:-1]]
        self.count = np.diff(self.bounds)
        edges = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.number = np.arange(len(self.text)) - edges[self.text]
        self.key = SpanHash(words.hash).of(self.bounds[:-1], self.bounds[1:], 1).view(np.int64)

    def edges(self, kept: np.ndarray, rows: int) -> pa.Array:
        return pa.array(np.searchsorted(self.text[kept], np.arange(rows + 1)), pa.int32())


def _sign(bands: int, rows: int, ngram: int, least: int):
    def start():
        def sign(texts: pa.Array, _) -> list[pa.Array]:
            found = Paragraphs(texts, least)
            kept = np.flatnonzero(found.count >= least)
            edges = found.edges(kept, len(texts))
            shingles, at = found.words.shingles(ngram, found.bounds)
            hashes = band_hashes(min_hashes(shingles, at, bands * rows)[kept], bands, rows)
            hashes = (hashes & ~np.uint64(255) | np.arange(bands, dtype=np.uint64)).view(np.int64)
            base = found.words.at[found.text[kept]]
            begin = found.words.start[found.bounds[kept]] - base
            end = found.words.end[found.bounds[kept + 1] - 1] - base
            place = np.arange(len(kept)) - np.searchsorted(found.text[kept], found.text[kept])
            values = [found.number[kept], place, found.key[kept], begin, end, found.count[kept], *hashes.T]
            names = ["number", "place", "digest", "start", "end", "n", *[f"b{k}" for k in range(bands)]]
            items = pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in values], names=names)
            return [pa.ListArray.from_arrays(edges, items)]

        return sign

    return start


def _sets(docs: DataFrame, bits: np.ndarray, ngram: int, least: int) -> DataFrame:
    """Rows (digest, set) of paragraphs whose key passes a filter."""

    def sets(batches):
        for batch in batches:
            for first, last in slices(batch.column(0)):
                found = Paragraphs(batch.column(0).slice(first, last - first), least)
                kept = np.flatnonzero((found.count >= least) & passes(found.key, bits))
                kept = kept[np.unique(found.key[kept], return_index=True)[1]]
                shingles, at = found.words.shingles(ngram, found.bounds)
                distinct = [np.unique(shingles[at[k] : at[k + 1]]).tobytes() for k in kept.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(found.key[kept]), pa.array(distinct, pa.binary())], names=["digest", "set"])

    return docs.select("text").mapInArrow(sets, "digest long, set binary").groupBy("digest").agg(F.first("set").alias("set"))


def repeated_paragraphs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, ngram: int = NGRAM,
    recall: float = RECALL, most_hashes: int = MOST_HASHES, least_words: int = LEAST_WORDS, least_run: int = LEAST_RUN,
) -> DataFrame:
    """The paragraphs that repeat in other places: a row for each occurrence, documents without any have none.

    Paragraphs of at least ``least_words`` words are alike if the Jaccard similarity of their sets of
    ``ngram``-word shingles is at least ``similarity``. Those reachable by likeness are a cluster; its
    first occurrence (smallest id, then place) is kept, the others are to be removed. Columns:
    ``doc_id``, ``paragraph`` (its number in the text), ``start`` and ``end`` (byte offsets in UTF-8),
    ``n_words``, ``cluster_id``, ``occurrences`` of the cluster, ``kept``. Clustered paragraphs that
    stand together have at least ``least_run`` words, else they are left alone, as are short formulas;
    paragraphs too short to be compared do not part them. Lines too short to be compared are compared
    together with their short neighbours (see ``Paragraphs``).

    Equal paragraphs are one class, named by a 63-bit hash of its words, and compared once. Bands and rows
    are chosen for ``recall`` at the threshold; buckets are cut into blocks, and only sums and spanning
    forests leave a task. Null and empty texts have no paragraphs. Documents with null or repeated ids
    count as documents of their own; a null id comes first.
    """
    bands, rows = choose_bands(similarity, recall, most_hashes)
    ids = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    fields = ", ".join(f"{c}: bigint" for c in ["number", "place", "digest", "start", "end", "n", *[f"b{k}" for k in range(bands)]])
    signed = with_struct(ids, "s", f"found array<struct<{fields}>>", _sign(bands, rows, ngram, least_words), "text")
    numbered = signed.withColumn("row", F.monotonically_increasing_id())
    found = numbered.select("row", "doc_id", F.explode("s.found").alias("p"))
    names = [F.col(f"p.b{k}") for k in range(bands)]
    # The numbers of rows are written with them, so they stay as they are if a task is run again later.
    units = written(found.select("row", "doc_id", "p.number", "p.place", "p.digest", "p.start", "p.end", "p.n", F.array(*names).alias("bands")), "paragraphs")
    classes = units.groupBy("digest").agg(F.count("*").alias("copies"), F.first("bands").alias("bands"))
    # Several steps look at the classes; written once, their bands are shuffled once.
    classes = written(classes.withColumn("rep", F.col("digest")), "classes")
    members = classes.select("digest", F.explode("bands").alias("bucket"))
    linked = linked_classes(classes, members, lambda bits: _sets(ids, bits, ngram, least_words), similarity)

    groups = components(linked, "rep", "root")
    again = units.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    clusters = written(
        again.join(groups, again["digest"] == groups["node"], "full_outer").select(
            F.coalesce("digest", "node").alias("digest"), F.coalesce("component", "digest").alias("cluster_id")
        ), "clusters"
    )
    hits = units.drop("bands").join(clusters, "digest")
    in_text = Window.partitionBy("row").orderBy("number")
    hits = hits.withColumn("run", F.col("place") - F.row_number().over(in_text))
    hits = hits.withColumn("run_words", F.sum("n").over(Window.partitionBy("row", "run"))).filter(F.col("run_words") >= least_run)
    hits = written(hits, "repeats")
    first = hits.groupBy("cluster_id").agg(
        F.min(F.struct("doc_id", "row", "number")).alias("first"), F.count("*").alias("occurrences")
    ).filter("occurrences > 1")
    return hits.join(first, "cluster_id").select(
        "doc_id", F.col("number").alias("paragraph"), "start", "end", F.col("n").alias("n_words"), "cluster_id", "occurrences",
        ((F.col("row") == F.col("first.row")) & (F.col("number") == F.col("first.number"))).alias("kept"),
    )
