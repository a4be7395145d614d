"""Spelling variants: permuterm rotations of words, sorted and scanned for words one edit apart."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.tables import column, written
from cdclake.llm.words import CHUNK, lowered, slices, text_buffer

LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A word is a variant of a near one that occurs at least so many times as often.
TIMES = 2
#: One run in so many, chosen by its checksum, loses a letter.
DAMAGED = 97
#: Words of more letters have their rotations named by hashes; those of just as many are in both ways.
SPELLED = 64
_END = "\x00"
#: Moduli and bases of the rolling hashes: each product fits into 63 bits, together they have 124.
_FIELDS = ((2147483647, 911382323), (2147483629, 972663749), (2147483587, 355555561), (2147483579, 713371337))
#: Rotations that leave a task at once.
_TOGETHER = 1 << 18


# Counting

def _checksum_steps() -> np.ndarray:
    """What a byte does to a CRC-32, by the library's own results for single bytes."""
    return np.array([zlib.crc32(bytes([k]), 0xFFFFFFFF) ^ 0xFFFFFFFF for k in range(256)], dtype=np.uint32)


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters, and of U+00C0 to U+00FF: those that begin with C3."""
    low = data | 0x20
    inside = (low >= 0x61) & (low <= 0x7A) & (data < 0x80)
    lead = data == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


def _checksums(begun: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The checksums of strings in ``data``, each going on from a checksum ``begun``."""
    steps = _checksum_steps()
    state = begun.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-length, kind="stable")
    state, at, left = state[order], start[order], length[order]
    # Strings end one after the other, so those that go on are always the first ones.
    going = np.searchsorted(-left, -np.arange(1, min(int(left[0]) if len(left) else 0, 4 * SPELLED) + 1), side="right")
    for k, n in enumerate(going):
        state[:n] = steps[(state[:n] ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(left > len(going)):
        rest = data[at[k] + len(going) : at[k] + left[k]].tobytes()
        state[k] = zlib.crc32(rest, int(state[k]))
    out = np.empty(len(state), dtype=np.int64)
    out[order] = state
    return out


def _count_runs(texts: pa.Array, ids: list[str | None]) -> pa.RecordBatch | None:
    data, at = text_buffer(texts)
    data = lowered(data)
    inside = _letters(data)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begin = at[:-1][at[:-1] < len(data)]
    starts[begin] = inside[begin]
    first = np.flatnonzero(starts)
    if not len(first):
        return None
    held = np.flatnonzero(inside)
    ends = np.append(np.searchsorted(held, first), len(held))
    letters = data[held]
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = runs.dictionary_encode()
    words, number = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    text = np.searchsorted(at, first, side="right") - 1
    # The checksum of a run depends on its document and spelling alone.
    pair, count = np.unique(text * len(words) + number, return_counts=True)
    text, number = pair // len(words), pair % len(words)
    begun = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.int64)
    named = np.array([i is not None for i in ids], dtype=bool)[text]
    _, offsets, spelled = words.buffers()
    spelled = np.frombuffer(spelled, dtype=np.uint8)
    where = np.frombuffer(offsets, dtype=np.int64)[: len(words) + 1]
    sums = _checksums(begun[text], spelled, where[number], np.diff(where)[number])
    damaged = named & (sums % DAMAGED == 0)
    whole = np.zeros(len(words), dtype=np.int64)
    np.add.at(whole, number[~damaged], count[~damaged])
    # Every byte begins a letter but those that go on with one.
    begins = np.append(0, np.cumsum((spelled & 0xC0) != 0x80))
    size = begins[where[1:]] - begins[where[:-1]]
    kept = np.flatnonzero((whole > 0) & (size >= LEAST_LETTERS))
    shorter = []
    for k in np.flatnonzero(damaged):
        word = spelled[where[number[k]] : where[number[k] + 1]].tobytes().decode()
        gap = int(sums[k]) % len(word)
        shorter.append(word[:gap] + word[gap + 1 :])
    found = pa.chunked_array([words.take(pa.array(kept)).cast(pa.large_string()), pa.array(shorter, pa.large_string())])
    return pa.RecordBatch.from_arrays(
        [found.combine_chunks().cast(pa.string()), pa.array(np.append(whole[kept], count[damaged]))], names=["word", "n"]
    )


def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST_COUNT) -> DataFrame:
    """Rows (word, n): how often each word of five letters or more occurs, if at least ``least`` times.

    Words are maximal runs of ASCII letters and U+00C0 to U+00FF, with A-Z in lower case. A run whose CRC-32
    of ``<doc_id>:<run>`` is a multiple of 97 loses its letter at that checksum modulo its length. Null texts
    have no words, runs of rows without an id are left whole. Counts are added up in the tasks and again
    before the shuffle, so words that are everywhere cost no more than others.
    """
    rows = docs.select(column(doc_id).cast("string").alias("id"), column(text).alias("text")).filter("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1), CHUNK):
                part = batch.slice(low, high - low)
                found = _count_runs(part.column(1), part.column(0).to_pylist())
                if found is not None:
                    yield found

    counted = rows.mapInArrow(run, "word string, n long").filter(F.length("word") >= LEAST_LETTERS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# Rotations

def _spelled_rotations(words: DataFrame) -> DataFrame:
    """Rotations of words of at most ``SPELLED`` letters, each whole, and cut before its last letter.

    A word of L letters and its end mark has L + 1 rotations. The last letter of one is the letter that an
    edit may change: ``key`` is what stands before it, ``edited`` the letter. In the sorted rotations those with
    one key are a range: words that differ in that letter alone, and first the word that lacks it, whose whole
    rotation is the key. ``first`` says that no equal letter stands before the edited one: of the letters of a run
    any may be left out, and only its first counts.
    """
    word, at = F.col("word"), F.col("at")
    ahead = word.substr(F.lit(1), at)
    letter = word.substr(at + 1, F.lit(1))
    end = F.lit(_END)
    whole = F.struct(F.concat(word.substr(at + 1, F.length(word)), end, ahead).alias("key"), F.lit("").alias("edited"), F.lit(False).alias("first"))
    cut = F.struct(
        F.concat(word.substr(at + 2, F.length(word)), end, ahead).alias("key"), letter.alias("edited"),
        (letter != word.substr(at, F.lit(1))).alias("first"),
    )
    cut = F.when(at == 0, F.struct(cut["key"].alias("key"), letter.alias("edited"), F.lit(True).alias("first"))).otherwise(cut)
    places = words.withColumn("at", F.explode(F.sequence(F.lit(0), F.length(word))))
    both = places.withColumn("r", F.explode(F.when(at < F.length(word), F.array(whole, cut)).otherwise(F.array(whole))))
    return both.select("r.key", "r.edited", "r.first", F.col("word").alias("ref"), "n")


def _powers(base: int, n: int, modulus: int) -> np.ndarray:
    out = np.ones(n + 1, dtype=np.int64)
    done = 1
    while done <= n:
        more = min(done, n + 1 - done)
        out[done : done + more] = out[:more] * pow(base, done, modulus) % modulus
        done += more
    return out


def _rotation_hashes(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rotations of a word with its end mark: whole ones, and those without their last letter.

    Both come from sums over beginnings of the word, so they cost as much for each rotation as for any.
    """
    n = len(letters)
    wholes, cuts = [], []
    for modulus, base in _FIELDS:
        power, inverse = _powers(base, n + 1, modulus), _powers(pow(base, -1, modulus), n + 1, modulus)
        sums = np.append(0, np.cumsum((letters + 2) * power[:n] % modulus)) % modulus

        def rotated(behind: np.ndarray, ahead: np.ndarray) -> np.ndarray:
            size = n - behind
            rest = (sums[n] - sums[behind]) % modulus * inverse[behind] % modulus
            return (rest + power[size] + sums[ahead] * power[size + 1]) % modulus

        places = np.arange(n + 1)
        wholes.append(rotated(places, places))
        cuts.append(rotated(places[1:], places[:-1]))
    return tuple(np.stack([(h[0] << 31) | h[1], (h[2] << 31) | h[3]]) for h in (wholes, cuts))


def _hashed_rotations(words: DataFrame) -> DataFrame:
    """The same rows for words of at least ``SPELLED`` letters, with hashes as keys and digests as ``ref``.

    Rows grow with the length of a word, not with its square. Words of just ``SPELLED`` letters are there to be
    met by those with one more.
    """

    def batches_of(word: str, n: int) -> Iterator[pa.RecordBatch]:
        letters = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        digest = hashlib.md5(word.encode()).hexdigest()
        whole, cut = _rotation_hashes(letters)
        before = np.append(-1, letters[:-1])
        hashes, edited, first = whole, np.full(len(letters) + 1, -1), np.zeros(len(letters) + 1, dtype=bool)
        if len(letters) > SPELLED:
            hashes = np.concatenate([whole, cut], axis=1)
            edited, first = np.append(edited, letters), np.append(first, letters != before)
        for low in range(0, len(edited), _TOGETHER):
            part = slice(low, low + _TOGETHER)
            size = len(edited[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[0][part]), pa.array(hashes[1][part]), pa.array(edited[part]), pa.array(first[part]),
                 pa.array([digest] * size), pa.array(np.full(size, n, dtype=np.int64))],
                names=["a", "b", "letter", "first", "ref", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from batches_of(batch.column(0)[k].as_py(), batch.column(1)[k].as_py())

    rows = words.select("word", "n").mapInArrow(run, "a long, b long, letter long, first boolean, ref string, n long")
    # Letters are compared as numbers of one width, so that they sort as letters do.
    edited = F.when(F.col("letter") < 0, F.lit("")).otherwise(F.lpad(F.hex("letter"), 6, "0"))
    return rows.select(F.concat_ws("-", F.hex("a"), F.hex("b")).alias("key"), edited.alias("edited"), "first", "ref", "n")


def _scan(rotations: DataFrame) -> DataFrame:
    """Rows (ref, n_near, best): for each rotation whose range holds near words their number and the best of them.

    ``best`` has at most two candidates, as pairs of a negated count and a ref: the first of the words that
    differ in the letter, and the word that lacks it. A range has one word for each letter of the alphabet at
    most; no pairs are made of it.
    """
    whole = F.col("edited") == ""
    ranked = Window.partitionBy("key").orderBy(whole, F.desc("n"), "edited")
    spread = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct((-F.col("n")).alias("less"), F.col("ref").alias("near"))
    seen = rotations.select(
        "ref", "first", whole.alias("whole"), F.row_number().over(ranked).alias("rank"),
        F.count(F.when(~whole, 1)).over(spread).alias("letters"), F.count(F.when(F.col("first"), 1)).over(spread).alias("firsts"),
        F.first(F.when(~whole, own)).over(spread).alias("one"), F.nth_value(F.when(~whole, own), 2).over(spread).alias("two"),
        F.first(F.when(F.col("first"), own), ignorenulls=True).over(spread).alias("longer"),
        F.last(F.when(whole, own)).over(spread).alias("shorter"),
    )
    shorter = F.when(F.col("first"), F.col("shorter"))
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(F.col("letters") - 1 + shorter.isNotNull().cast("int"))
    other = F.when(F.col("rank") == 1, F.col("two")).otherwise(F.col("one"))
    best = F.when(F.col("whole"), F.array("longer")).otherwise(F.array(other, shorter))
    return seen.select("ref", near.alias("n_near"), F.array_compact(best).alias("best")).filter("n_near > 0")


def near_words(words: DataFrame) -> DataFrame:
    """Rows (word, n, n_near, near, near_n) for a table of words with their counts ``n``.

    Two words are near if one inserted, deleted or replaced letter (code point) makes one of the other.
    ``n_near`` counts a word's near ones, ``near`` is that of them which occurs most (of several the first in
    the order of code points), ``near_n`` its count; both are null where there is none.

    All rotations of the words, each closed by an end mark, are sorted; words one edit apart stand in one range
    of rotations that agree but for the edited letter, which is their last. A range is scanned once, and each of
    its words told how many others it holds and the best of them. Words that are longer than 64 letters have
    their rotations named by 124-bit hashes, so a word of any length costs no more than its length.

    Null words, and those that hold U+0000, are left out; counts of repeated words are added up.
    """
    usable = F.col("word").isNotNull() & ~F.contains("word", F.lit(_END))
    words = words.select("word", F.col("n").cast("long").alias("n")).filter(usable).groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    found = _scan(_spelled_rotations(words.filter(F.length("word") <= SPELLED)))
    found = found.select(F.col("ref").alias("word"), "n_near", F.array_min("best").alias("best"))
    long = words.filter(F.length("word") >= SPELLED)
    if not long.filter(F.length("word") > SPELLED).isEmpty():
        found = found.unionByName(_near_long_words(long))
    alone = words.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    best = found.unionByName(alone).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return words.join(best, "word").select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _near_long_words(words: DataFrame) -> DataFrame:
    """Rows (word, n_near, best) of long words. Of candidates that occur equally often the spellings decide."""
    seen = written(_scan(_hashed_rotations(words)), "long_words")
    spelled = words.select(F.md5(F.col("word").cast("binary")).alias("digest"), "word")
    counts = seen.groupBy("ref").agg(F.sum("n_near").alias("n_near"))
    candidates = seen.select("ref", F.explode("best").alias("c")).select("ref", "c.less", "c.near").distinct()
    least = candidates.groupBy("ref").agg(F.min("less").alias("less"))
    names = spelled.select(F.col("digest").alias("near"), F.col("word").alias("spelled"))
    best = candidates.join(least, ["ref", "less"]).join(names, "near").groupBy("ref", "less").agg(F.min("spelled").alias("near"))
    return (
        counts.join(best, "ref").join(spelled, F.col("ref") == F.col("digest"))
        .select("word", "n_near", F.struct("less", "near").alias("best"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) for words with a form: the last of the forms that follow each other.

    Every round jumps as far again as all before it. A form occurs twice as often as its word, so chains are as
    long as the logarithm of the counts at most, and rounds as few as its logarithm.
    """
    links = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = written(moved, "roots")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return links


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for a table of words with their counts ``n``.

    ``form`` is the near word that occurs most (see ``near_words``), if at least ``times`` as often as the word,
    else null; ``root`` the word that its forms lead to, itself if it has none. Without words the result is empty.
    ``times`` must be more than 1, or forms could lead in circles.
    """
    if times <= 1:
        raise ValueError("a form must occur more often than its word")
    enough: Column = F.col("near_n") >= times * F.col("n")
    near = near_words(words).select(
        "word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")
    )
    near = written(near, "near_words")
    roots = _roots(near.filter("form IS NOT NULL"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
