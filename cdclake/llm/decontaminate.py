"""Benchmark passages in documents: a prefix-filtered join of word windows with exact checks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.tables import column, fresh, with_struct
from cdclake.llm.words import Words, slices

WINDOW = 13
#: Bytes of items that are looked up at a time; what goes to the tasks is about five times that.
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 16

RESULT = "n_words long, n_hit long, item_ids array<string>, items_sha256 string, contaminated boolean"
_SPANS = "first array<long>, last array<long>, item array<string>"


@dataclass
class Windows:
    """The windows of a block of items, ordered by their prefix: the rarest word of each.

    ``hashes`` has all words of the items in a row; ``start`` is a window's first one there, ``size`` its
    words, ``offset`` the place of the prefix word in it. ``filter`` has the low bits of all prefixes.
    """

    prefix: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    size: np.ndarray
    offset: np.ndarray
    item: np.ndarray
    names: list[str | None]

    def __post_init__(self):
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.prefix & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last word (of the whole batch) and item of every window that occurs."""
        near = np.flatnonzero(self.filter[words.hash & np.uint64((1 << _FILTER_BITS) - 1)])
        low = np.searchsorted(self.prefix, words.hash[near], side="left")
        count = np.searchsorted(self.prefix, words.hash[near], side="right") - low
        found = np.repeat(near, count)
        window = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        # Positional and length bounds: the whole window must fit into the document.
        start = found - self.offset[window]
        end = start + self.size[window]
        text = words.text[found]
        fits = (start >= words.first[text]) & (end <= words.first[text + 1])
        start, end, window = start[fits], end[fits], window[fits]
        for word in range(int(self.size.max(initial=0))):
            # Each word of a window is compared; a window drops out at the first that differs.
            inside = word < self.size[window]
            there = np.where(inside, start + word, start)
            wanted = self.hashes[self.start[window] + np.where(inside, word, 0)]
            same = ~inside | (words.hash[there] == wanted)
            start, end, window = start[same], end[same], window[same]
        return start, end, self.item[window]


def _item_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all items in a row, and where each item's begin."""
    hashes, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(1, dtype=np.int64)]
    for first, last in slices(texts):
        words = Words(texts.slice(first, last - first))
        hashes.append(words.hash)
        counts.append(np.diff(words.first))
    return np.concatenate(hashes), np.cumsum(np.concatenate(counts))


def _windows(names: list, hashes: np.ndarray, first: np.ndarray, size: int, vocabulary: np.ndarray, often: np.ndarray) -> Windows:
    count = np.diff(first)
    each = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    item = np.repeat(np.arange(len(count), dtype=np.int32), each)
    start = (first[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each)).astype(np.int32)
    sizes = np.minimum(count[item], size).astype(np.int16)
    # Rarest first; equally rare words by hash, so that every window of the same words has one prefix.
    rank = np.empty(len(vocabulary), dtype=np.int32)
    rank[np.lexsort((vocabulary, often))] = np.arange(len(vocabulary), dtype=np.int32)
    ranks = rank[np.searchsorted(vocabulary, hashes)]
    offset = np.zeros(len(item), dtype=np.int16)
    least = ranks[start] if len(item) else np.zeros(0, dtype=np.int32)
    for word in range(1, int(sizes.max(initial=0))):
        inside = np.flatnonzero(word < sizes)
        better = inside[ranks[start[inside] + word] < least[inside]]
        offset[better], least[better] = word, ranks[start[better] + word]
    prefix = hashes[start + offset]
    order = np.argsort(prefix, kind="stable")
    return Windows(prefix[order], hashes, start[order], sizes[order], offset[order], item[order], names)


def word_frequencies(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of a bounded vocabulary, given by its hash in order, occurs in all documents."""

    def count(batches):
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for first, last in slices(batch.column(0)):
                found = Words(batch.column(0).slice(first, last - first)).hash
                at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
                total += np.bincount(at[vocabulary[at] == found], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary.view(np.int64)), pa.array(total)], names=["word", "n"])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    if len(vocabulary):
        counts = docs.select(column(text)).mapInArrow(count, "word long, n long").filter("n > 0")
        table = counts.groupBy("word").agg(F.sum("n").alias("n")).toArrow()
        words = table.column("word").to_numpy().view(np.uint64)
        out[np.searchsorted(vocabulary, words)] = table.column("n").to_numpy()
    return out


def _verdict(words: Words, spans: list[tuple[list, list, list]]) -> list[pa.Array]:
    n_words = np.diff(words.first)
    n_hit, ids, digests = [], [], []
    for count, (first, last, items) in zip(n_words, spans, strict=True):
        change = np.zeros(count + 1, dtype=np.int64)
        np.add.at(change, np.array(first, dtype=np.int64), 1)
        np.add.at(change, np.array(last, dtype=np.int64), -1)
        n_hit.append(int((np.cumsum(change)[:count] > 0).sum()))
        ids.append(sorted({i for i in items if i is not None}))
        digests.append(hashlib.sha256(",".join(ids[-1]).encode()).hexdigest())
    hit = np.array(n_hit, dtype=np.int64)
    return [
        pa.array(n_words, pa.int64()), pa.array(hit), pa.array(ids, pa.list_(pa.string())), pa.array(digests, pa.string()),
        pa.array((hit > 0) & (20 * hit >= n_words)),
    ]


def _matcher(index: Windows, before: str | None, last: bool):
    """Adds the spans of one block of items to those of the blocks before; the last one judges."""

    def add(texts: pa.Array, rows: pa.StructArray) -> list[pa.Array]:
        words = Words(texts)
        start, end, item = index.hits(words)
        row = words.text[start]
        base = words.first[row]
        spans = [([], [], []) for _ in range(len(texts))]
        if before is not None:
            spans = [(s["first"], s["last"], s["item"]) for s in rows.field(before).to_pylist()]
        for r, a, b, i in zip(row.tolist(), (start - base).tolist(), (end - base).tolist(), item.tolist(), strict=True):
            spans[r][0].append(a)
            spans[r][1].append(b)
            spans[r][2].append(index.names[i])
        if last:
            return _verdict(words, spans)
        kinds = pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())
        return [pa.array([s[k] for s in spans], kind) for k, kind in enumerate(kinds)]

    return lambda: add


def contamination(
    docs: DataFrame, items: DataFrame, name: str = "contamination", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every document with a struct column ``name``: which benchmark items its words repeat.

    A window is ``size`` consecutive words of an item; an item of fewer words is one window. Each window
    is looked up by its rarest word in all documents (its prefix); where a document has that word, the
    window must fit around it, and all its words are compared. A word inside any occurrence is hit.
    Fields: ``n_words``; ``n_hit``; ``item_ids``, items with an occurring window, sorted as strings;
    ``items_sha256``, of those joined by commas; ``contaminated``, at least one word in twenty is hit.

    Items are taken in blocks of at most about ``block_bytes``, so what goes to the tasks is bounded; with
    one block documents are read twice (word counts, matches) and never shuffled. Null texts have no
    words and are not contaminated. Items without words match nothing; an item without id makes hits but
    is not listed; repeated ids count once. No items: nothing is hit.
    """
    items = items.select(column(item_id).cast("string").alias("name"), column(item_text).cast("string").alias("text"))
    items = items.distinct()
    size_of = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size_of // block_bytes))
    vocabulary_of = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    before = None
    for block in range(blocks):
        table = vocabulary_of.filter(F.col("block") == block).select("name", "text").toArrow()
        texts = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())
        hashes, first = _item_words(texts)
        vocabulary = np.unique(hashes)
        often = word_frequencies(docs, text, vocabulary)
        index = _windows(table.column("name").to_pylist(), hashes, first, size, vocabulary, often)
        last = block == blocks - 1
        added = name if last else fresh(docs, f"spans_{block}")
        fields = RESULT if last else _SPANS
        docs = with_struct(docs, added, fields, _matcher(index, before, last), text)
        docs, before = docs.drop(before) if before else docs, added
    return docs
