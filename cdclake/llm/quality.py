"""Quality rules: counts of words, symbols and repeats, then bands of zstandard ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from cdclake.llm.tables import with_struct
from cdclake.llm.words import text_buffer

#: Bytes of text from which a band holds, and its least and greatest ratio of compressed to plain bytes.
#: Prose compresses better the longer it is, and its ratio varies less; copied lines fall below the band,
#: encoded binary data (three quarters and more at any length) rise above it.
BANDS = (
    (128, 0.40, 1.05), (256, 0.32, 0.90), (512, 0.28, 0.80), (1 << 10, 0.25, 0.72), (1 << 12, 0.22, 0.68),
    (1 << 14, 0.18, 0.66), (1 << 16, 0.14, 0.64), (1 << 18, 0.10, 0.62),
)
#: Bytes of a chunk, and the share of a text's bytes that may be in chunks outside their band.
CHUNK_BYTES, MOST_OUTSIDE = 4096, 0.3
LEVEL = 3
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Words of the windows that are looked for again.
WINDOW = 8
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\v\f\r"
#: Bytes of texts that are looked at together, and that a long text is compressed by.
_TOGETHER, _FED = 512 << 10, 1 << 20


def _marks(wanted: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(wanted)] = True
    return table


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    marked = np.flatnonzero(flags)
    return np.diff(np.searchsorted(marked, at))


def _numbers(keys: np.ndarray) -> np.ndarray:
    """A number below their count for each key, equal for equal keys only."""
    return pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)


def _spelled(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number for each of the strings that stand in a row in ``data``, equal for equal strings only."""
    ends = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=ends[1:])
    strings = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return strings.dictionary_encode().indices.to_numpy().astype(np.int64)


def _repeated_words(text: np.ndarray, word: np.ndarray, n_texts: int) -> np.ndarray:
    """Words of each text inside windows that it has more than once."""
    n = len(word) - WINDOW + 1
    if n <= 0:
        return np.zeros(n_texts, dtype=np.int64)
    # Runs of one, two, four and eight words get numbers of their own; those of one word know the text.
    number = _numbers(text * (word.max() + 1) + word)
    for size in (1, 2, 4):
        number = _numbers(number[:-size] * len(word) + number[size:])
    inside = text[:n] == text[WINDOW - 1 :]
    # Windows that reach into the next text have numbers too.
    times = np.bincount(number[inside], minlength=int(number.max()) + 1)
    again = np.flatnonzero(inside & (times[number] > 1))
    # A window begins to cover words at its first and ends after its last.
    depth = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(depth, again, 1)
    np.add.at(depth, again + WINDOW, -1)
    return np.bincount(text[np.cumsum(depth)[:-1] > 0], minlength=n_texts)


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words and their code points, symbols, lines equal to an earlier one, and words in repeated windows."""
    data, at = text_buffer(texts)
    n_texts = len(at) - 1
    inside = ~_marks(_BLANKS)[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begin = at[:-1][at[:-1] < len(data)]
    starts[begin] = inside[begin]
    first = np.flatnonzero(starts)
    text = np.searchsorted(at, first, side="right") - 1
    held = np.flatnonzero(inside)
    lengths = np.diff(np.append(np.searchsorted(held, first), len(held)))
    out = {
        "n_words": np.bincount(text, minlength=n_texts),
        # Every byte begins a code point but those that go on with one.
        "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), at),
        "n_symbols": _per_text(_marks(_SYMBOLS)[data], at),
        "n_repeat_words": _repeated_words(text, _spelled(data[held], lengths), n_texts) if len(first) else np.zeros(n_texts, dtype=np.int64),
    }
    # A line begins with each text that is not empty, and after each line break inside one.
    breaks = data == 10
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = breaks[:-1]
    begins[begin] = True
    line = np.flatnonzero(begins)
    ends = np.append(line[1:], len(data))
    full = np.diff(np.searchsorted(held, np.append(line, len(data)))) > 0
    plain = np.flatnonzero(~breaks)
    sizes = np.searchsorted(plain, ends) - np.searchsorted(plain, line)
    owner = np.searchsorted(at, line, side="right") - 1
    spelled = _spelled(data[plain], sizes) if len(line) else np.zeros(0, dtype=np.int64)
    keys = (owner * (len(line) + 1) + spelled)[full]
    different = np.bincount(np.unique(keys) // (len(line) + 1), minlength=n_texts)
    out["n_dup_lines"] = np.bincount(owner[full], minlength=n_texts) - different
    return out


class Ratios:
    """Compressed to plain bytes, of whole texts and of their chunks."""

    def __init__(self, bands: tuple[tuple[int, float, float], ...], chunk_bytes: int, level: int):
        self._from = np.array([b[0] for b in bands])
        # Texts shorter than the first band have no limits.
        self._least = np.array([0.0, *[b[1] for b in bands]])
        self._most = np.array([np.inf, *[b[2] for b in bands]])
        self._chunk = chunk_bytes
        self._compressor = zstandard.ZstdCompressor(level=level)

    def _ratio(self, data: memoryview) -> float:
        if len(data) <= _FED:
            return len(self._compressor.compress(data)) / len(data)
        stream = self._compressor.compressobj(size=len(data))
        size = sum(len(stream.compress(data[k : k + _FED])) for k in range(0, len(data), _FED))
        return (size + len(stream.flush())) / len(data)

    def _outside(self, size: int, ratio: float) -> bool:
        band = int(np.searchsorted(self._from, size, side="right"))
        return not self._least[band] <= ratio <= self._most[band]

    def of(self, data: memoryview) -> tuple[float, bool, float, float, float]:
        """The ratio of a text that is not empty, whether it is outside its band, the least and greatest
        ratio of a chunk, and the share of bytes in chunks outside theirs."""
        whole = self._ratio(data)
        if len(data) <= self._chunk:
            bad = self._outside(len(data), whole)
            return whole, bad, whole, whole, float(bad)
        parts = [data[k : k + self._chunk] for k in range(0, len(data), self._chunk)]
        ratios = [self._ratio(p) for p in parts]
        # The rest at the end counts in shares; as an extreme it would say more of its length than of the text.
        outside = sum(len(p) for p, r in zip(parts, ratios, strict=True) if self._outside(len(p), r))
        full = ratios[: len(data) // self._chunk]
        return whole, self._outside(len(data), whole), min(full), max(full), outside / len(data)


_FIELDS = """n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,
    ratio double, chunk_least double, chunk_most double, outside double, kept boolean"""


def quality(
    docs: DataFrame, name: str = "quality", text: str = "text", bands: tuple[tuple[int, float, float], ...] = BANDS,
    chunk_bytes: int = CHUNK_BYTES, most_outside: float = MOST_OUTSIDE, level: int = LEVEL,
) -> DataFrame:
    """All columns of the documents, and a struct ``name`` with what is counted and decided of the whole text.

    Words are runs of other characters than ASCII blanks. ``word_chars`` are their code points, ``n_symbols``
    characters of ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal an earlier one, ``n_repeat_words``
    words in eight-word windows that the text has twice or more. ``base_failed`` says that there are fewer
    than 20 words, or more than 30 of 100 in such windows. Strings are compared as they are, not by hashes.

    ``ratio`` is compressed to plain bytes of the text, ``chunk_least`` and ``chunk_most`` the extremes of its
    whole chunks (of a text of one chunk or less: its own ratio), ``outside`` the share of its bytes in chunks
    outside the band of their length. ``kept`` is false if the base failed, if ``ratio`` is outside the band of
    the text's length, or if ``outside`` exceeds ``most_outside``. ``bands`` must rise in length.

    Null texts have no words and fail the base, as empty ones do; their ratios are null and ``outside`` is 0.
    Rows are judged each by itself, so repeated rows, ids and clashing columns change nothing: only ``name``
    must be new. Nothing is shuffled; tasks hold about half a megabyte of texts, or one longer text.
    """

    def start():
        ratios = Ratios(bands, chunk_bytes, level)

        def work(texts: pa.Array, _rows: pa.StructArray) -> list[pa.Array]:
            found = counts(texts)
            failed = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
            data, at = text_buffer(texts)
            view = memoryview(data)
            told = [ratios.of(view[a:b]) if b > a else (None, False, None, None, 0.0) for a, b in zip(at[:-1], at[1:], strict=True)]
            whole, bad, least, most, outside = (list(x) for x in zip(*told, strict=True))
            kept = ~failed & ~np.array(bad, dtype=bool) & (np.array(outside) <= most_outside)
            numbers = [pa.array(found[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            doubles = [pa.array(x, pa.float64()) for x in (whole, least, most, outside)]
            return [*numbers, pa.array(failed), *doubles, pa.array(kept)]

        return work

    return with_struct(docs, name, _FIELDS, start, text, _TOGETHER)
