"""Words, shingles and their hashes for whole batches of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of texts worked on at a time; a task holds some forty times as many meanwhile.
CHUNK = 512 << 10


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base % (1 << 64), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class SpanHash:
    """Hashes of spans of a sequence from sums of powers: any span costs two lookups."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        n = len(values)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, n)[:n], out=self._sums[1:])
        self._inverse = powers(pow(base, -1, 1 << 64), n)

    def of(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        span = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mixed(span ^ ((end - start).astype(np.uint64) << np.uint64(40)), seed)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``chunk`` bytes each; a longer text comes alone."""
    _, at = text_buffer(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + chunk, side="right")) - 1)
        yield first, last
        first = last


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = True
    table[0x61:0x7B] = True
    table[0x80:] = True
    return table


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + np.uint8(32), data)


class Words:
    """The words of a batch: maximal runs of digits, letters a-z (A-Z in lower case) and non-ASCII characters.

    ``start`` and ``end`` are byte offsets into ``data``, ``text`` the row a word is in, ``first`` the
    number of each row's first word (with one more entry at the end), ``hash`` a value per word.
    """

    def __init__(self, texts: pa.Array):
        data, at = text_buffer(texts)
        self.data, self.at = lowered(data), at
        inside = np.zeros(len(data) + 1, dtype=bool)
        inside[:-1] = _word_bytes()[self.data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        # A text begins a word of its own even where the text before it ends in one.
        begin = at[:-1][at[:-1] < len(data)]
        starts[begin] = inside[begin]
        self.start = np.flatnonzero(starts)
        ends = inside[:-1] & ~inside[1:]
        last = at[1:][at[1:] > 0] - 1
        ends[last] = inside[last]
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.text = np.repeat(np.arange(len(at) - 1), np.diff(self.first))
        self.hash = SpanHash(self.data).of(self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def windows(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``size`` words that is inside one text."""
        n = len(self) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        first = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        return first, self._run(first, size, seed)

    def _run(self, first: np.ndarray, size: int, seed: int) -> np.ndarray:
        total = np.zeros(len(first), dtype=np.uint64)
        for word in range(size):
            total = total * np.uint64(_BASE_INVERSE) + self.hash[first + word]
        return mixed(total, seed + size)

    def shingles(self, size: int, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes in the order of the texts, and where each text's begin.

        A text of fewer words, but not none, is one shingle. ``bounds`` may cut the words into other
        spans than texts: their first words, and the end.
        """
        bounds = self.first if bounds is None else bounds
        count = np.diff(bounds)
        shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        at = np.append(0, np.cumsum(shingles))
        out = np.zeros(at[-1], dtype=np.uint64)
        span = np.repeat(np.arange(len(count)), shingles)
        first = bounds[:-1][span] + np.arange(at[-1]) - at[:-1][span]
        whole = count[span] >= size
        out[whole] = self._run(first[whole], size, 0)
        for words in range(1, size):
            short = np.flatnonzero(count == words)
            out[at[short]] = self._run(bounds[short], words, 0)
        return out, at

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each text's sequence of words."""
        a, b = self.first[:-1], self.first[1:]
        return SpanHash(self.hash).of(a, b, 1), SpanHash(mixed(self.hash, 7), 0xC2B2AE3D27D4EB4F).of(a, b, 2)


def segment_min(values: np.ndarray, at: np.ndarray, empty: int = 0) -> np.ndarray:
    """The least value of each segment; ``empty`` for segments without values."""
    out = np.full(len(at) - 1, empty, dtype=values.dtype)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = np.minimum.reduceat(values, at[full])
    return out


def min_hashes(shingles: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values for each segment of shingles."""
    rng = np.random.Generator(np.random.PCG64(20_240_229))
    factors = rng.integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, size=n, dtype=np.uint64)
    out = np.zeros((len(at) - 1, n), dtype=np.uint64)
    for k in range(n):
        out[:, k] = segment_min(shingles * factors[k] + shifts[k], at)
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` MinHash values."""
    out = np.zeros((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        total = np.zeros(len(signature), dtype=np.uint64)
        for row in range(rows):
            total = mixed(total ^ signature[:, band * rows + row])
        out[:, band] = mixed(total, band + 1)
    return out


def choose_bands(similarity: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """Bands and rows with which a pair of that similarity collides with at least that probability.

    Of all choices within ``most_hashes`` MinHash values, that with the most rows: it lets the fewest
    dissimilar pairs collide.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        bands = int(np.ceil(np.log1p(-recall) / np.log1p(-(similarity**rows))))
        if bands * rows <= most_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best
