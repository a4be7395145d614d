"""Language identification with hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.tables import column, held_out, with_struct
from cdclake.llm.words import slices

DIMENSIONS = 512
UNKNOWN = "und"
#: About this many documents of each language are learned from.
SAMPLE = 4000
_SEGMENT = 1 << 20
_BLANK = 0x20


class Encoder:
    """Document vectors: sums over all letter trigrams of their vectors.

    Every letter has a random vector of +1 and -1. A trigram's vector binds those of its letters, each
    permuted (rotated) by its place: their product, element by element. Runs of other characters, and
    both ends of a text, count as one blank letter.
    """

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        self.dimensions, self._seed = dimensions, seed
        self._letter = np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])
        self._number = np.zeros(sys.maxunicode + 1, dtype=np.int64)
        self._vectors: dict[int, np.ndarray] = {}

    def _vector(self, point: int) -> np.ndarray:
        if point not in self._vectors:
            bits = np.random.Generator(np.random.PCG64([self._seed, point])).integers(0, 2, self.dimensions)
            self._vectors[point] = (2 * bits - 1).astype(np.int8)
        return self._vectors[point]

    def _trigrams(self, letters: np.ndarray, codes: np.ndarray) -> np.ndarray:
        base = np.stack([self._vector(int(p)) for p in letters])
        n = len(letters)
        bound = np.roll(base, 2, axis=1)[codes // (n * n)]
        bound = bound * np.roll(base, 1, axis=1)[codes // n % n]
        return (bound * base[codes % n]).astype(np.float32)

    def _sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        padded = [f" {t.lower()} " for t in texts]
        points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        text = np.repeat(np.arange(len(padded)), [len(p) for p in padded])
        letter = self._letter[points]
        has_letter = np.bincount(text[letter], minlength=len(texts)) > 0
        keep = letter.copy()
        keep[0] = True
        keep[1:] |= letter[:-1] | (text[1:] != text[:-1])
        points, text = np.where(letter, points, _BLANK)[keep], text[keep]
        present = np.zeros(sys.maxunicode + 1, dtype=bool)
        present[points] = True
        letters = np.flatnonzero(present)
        self._number[letters] = np.arange(len(letters))
        n, number = len(letters), self._number[points]
        inside = text[2:] == text[:-2]
        codes = ((number[:-2] * n + number[1:-1]) * n + number[2:])[inside]
        owner = text[:-2][inside]
        if n**3 <= 1 << 24:
            seen = np.zeros(n**3, dtype=bool)
            seen[codes] = True
            distinct = np.flatnonzero(seen)
            place = np.zeros(n**3, dtype=np.int64)
            place[distinct] = np.arange(len(distinct))
            at = place[codes]
        else:
            distinct, at = np.unique(codes, return_inverse=True)
        total = np.zeros((len(texts), self.dimensions), dtype=np.float32)
        # Texts by trigrams, some texts at a time; their product with the trigrams' vectors is exact.
        vectors = self._trigrams(letters, distinct)
        step = max(1, (4 << 20) // max(1, len(distinct)))
        edges = np.searchsorted(owner, np.arange(0, len(texts) + step, step))
        for k, first in enumerate(range(0, len(texts), step)):
            a, b = edges[k], edges[k + 1]
            rows = min(step, len(texts) - first)
            cells = (owner[a:b] - first) * len(distinct) + at[a:b]
            counts = np.bincount(cells, minlength=rows * len(distinct)).reshape(rows, -1)
            total[first : first + rows] = counts.astype(np.float32) @ vectors
        return total, has_letter

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of unit length (zero without letters), and whether a text has letters.

        Long texts are taken in segments, whose vectors add up.
        """
        parts, owner = [], []
        for k, text in enumerate(texts):
            for first in range(0, max(1, len(text or "")), _SEGMENT):
                parts.append((text or "")[first : first + _SEGMENT])
                owner.append(k)
        total = np.zeros((len(texts), self.dimensions))
        has_letter = np.zeros(len(texts), dtype=bool)
        if parts:
            sums, letters = self._sums(parts)
            np.add.at(total, owner, sums)
            np.logical_or.at(has_letter, owner, letters)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        return total / np.where(norm > 0, norm, 1), has_letter


@dataclass
class Profiles:
    """Languages and the unit vectors that stand for them."""

    languages: list[str]
    vectors: np.ndarray


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> Profiles:
    """Bundle the vectors of labelled documents of each language.

    Learns from rows with a text, a language and an id outside the held-out fold: all, or where a
    language has more than ``sample``, a fixed choice of about that many by a hash of the id. What comes
    to the driver is one vector per language.
    """
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"), column(lang).alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    often = [F.when(F.col("lang") == name, sample / n) for name, n in counts.items() if n > sample]
    share = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / (1 << 30)
    chosen = rows.filter(share < F.coalesce(*often, F.lit(2.0)))

    def bundle(batches):
        encoder, sums = Encoder(), {}
        for batch in batches:
            for first, last in slices(batch.column(0), _SEGMENT):
                vectors, has_letter = encoder.vectors(batch.column(0).slice(first, last - first).to_pylist())
                names = np.array(batch.column(1).slice(first, last - first).to_pylist(), dtype=object)
                for name in set(names[has_letter]):
                    sums[name] = sums.get(name, 0) + vectors[has_letter & (names == name)].sum(axis=0)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(total)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                names=["lang", "place", "value"],
            )

    parts = chosen.select("text", "lang").mapInArrow(bundle, "lang string, place int, value double")
    totals = parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).collect()
    languages = sorted({r["lang"] for r in totals})
    vectors = np.zeros((len(languages), DIMENSIONS))
    for r in totals:
        vectors[languages.index(r["lang"]), r["place"]] = r["value"]
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(languages, vectors / np.where(norm > 0, norm, 1))


def predict(docs: DataFrame, profiles: Profiles, name: str = "language", text: str = "text") -> DataFrame:
    """Every row with a struct column ``name``: ``lang_pred`` and ``score``, both from the whole text alone.

    The language is that of the most similar profile by cosine (of equal ones the first by name), the
    score that cosine, at least 0. A text that is null or has no letter, and every text if nothing was
    learned, is ``und`` with score 0.
    """

    def start():
        encoder = Encoder()

        def tell(texts: pa.Array, _) -> list[pa.Array]:
            vectors, has_letter = encoder.vectors(texts.to_pylist())
            if not profiles.languages:
                has_letter[:] = False
            similar = vectors @ profiles.vectors.T if profiles.languages else np.zeros((len(vectors), 1))
            best = similar.argmax(axis=1)
            names = np.array([*profiles.languages, UNKNOWN], dtype=object)
            score = np.where(has_letter, similar[np.arange(len(best)), best].clip(0, 1), 0.0)
            return [pa.array(names[np.where(has_letter, best, len(names) - 1)], pa.string()), pa.array(score)]

        return tell

    return with_struct(docs, name, "lang_pred string, score double", start, text, _SEGMENT)
