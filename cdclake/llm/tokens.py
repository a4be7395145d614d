"""Token ids of a word-BPE tokenizer for whole batches: each distinct word is encoded once."""

from __future__ import annotations

import re
import sys
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from cdclake.llm.words import SpanHash

_OTHER, _SPACE, _LETTER, _NUMBER, _UNSEEN = 0, 1, 2, 3, 255
# What the vocabulary's pre-tokenizer splits off after an apostrophe, and its white space.
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Words remembered at a time, in places chosen by their hash; a newer word takes the place of an older one.
SLOTS = 1 << 20
#: Ids remembered at a time; beyond that all words are forgotten.
_MOST_IDS = 4 << 20


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, others from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or b >= 0xA1 and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _spelled(word: str) -> str:
    return word.encode().decode("latin-1").translate(_LETTERS)


class WordEncoder:
    """Ids of texts under a tokenizer file whose words never span the runs that it splits texts into.

    The same ids as the tokenizers library gives if it adds no special tokens. Words are found for a whole
    batch in numpy, the library encodes those that are not remembered, each once a batch. Up to ``slots``
    words are remembered. Kinds of characters are asked of the library when they are first met, and texts
    with characters that Python's tables do not know are normalized by it, so both know the same ones. With
    ``added``, the file's added tokens are known where texts spell them, as the library does; without it
    such a string is text like any other.
    """

    def __init__(self, path: str, slots: int = SLOTS, added: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        tokens = self._tokenizer.get_added_tokens_decoder() if added else {}
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in tokens.values()):
            raise ValueError("added tokens that are not looked up as they stand")
        self._added = {t.content: k for k, t in tokens.items()}
        # The longest of those that begin at one place, as in the library.
        literals = sorted(self._added, key=len, reverse=True)
        self._literal = re.compile(f"({'|'.join(map(re.escape, literals))})") if literals else None
        self._kind = np.full(sys.maxunicode + 1, _UNSEEN, dtype=np.uint8)
        self._kind[list(_SPACES)] = _SPACE
        self._known = np.zeros(slots, dtype=np.uint64)
        self._place = np.zeros(slots, dtype=np.int32)
        self._length = np.zeros(slots, dtype=np.int32)
        self._forget()

    def _forget(self) -> None:
        self._known[:] = 0
        self._ids = np.zeros(0, dtype=np.uint32)

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """Kinds of characters: two letters are one run, two numbers never are, a letter and another kind never are."""
        kind = self._kind[points]
        for point in np.unique(points[kind == _UNSEEN]).tolist():
            split = self._tokenizer.pre_tokenizer.pre_tokenize_str
            if 0xD800 <= point < 0xE000:
                self._kind[point] = _OTHER
            elif len(split(f"a{chr(point)}")) == 1:
                self._kind[point] = _LETTER
            elif len(split(f"!{chr(point)}")) == 1:
                self._kind[point] = _OTHER
            else:
                self._kind[point] = _NUMBER
        return self._kind[points]

    def _normal(self, text: str) -> str:
        """Composed form, then lower case letter by letter, as the vocabulary's normalizer does."""
        if text.isascii():
            return text.lower()
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self._tokenizer.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _words(self, texts: list[str]):
        normal = [self._normal(t) for t in texts]
        joined = "\n".join(normal)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = self._kinds(points)
        start = np.ones(len(points), dtype=bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        start &= kind != _SPACE
        quotes = np.flatnonzero((points == 0x27) & start)
        for at in quotes.tolist():
            rest = joined[at + 1 : at + 3]
            for short in _CONTRACTIONS:
                if rest.startswith(short):
                    # The apostrophe and these letters are a word; what follows begins another one.
                    start[at + 1] = False
                    after = at + 1 + len(short)
                    if len(short) == 2:
                        start[at + 2] = False
                    if after < len(points) and kind[after] != _SPACE:
                        start[after] = True
                    break
        begin = np.flatnonzero(start)
        stop = np.ones(len(points) + 1, dtype=bool)
        stop[:-1] = start | (kind == _SPACE)
        stops = np.flatnonzero(stop)
        end = stops[np.searchsorted(stops, begin, side="right")]
        edges = np.cumsum([0] + [len(t) + 1 for t in normal])
        return joined, points, begin, end, np.searchsorted(begin, edges)

    def _learn(self, joined: str, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of new words are kept, and how many they are."""
        words = [joined[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        # Words are whole runs in normal form by now, so only the merges are left to do.
        merged = self._tokenizer.model.tokenize
        ids = [[t.id for t in merged(w if w.isalpha() and w.isascii() else _spelled(w))] for w in words]
        length = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
        place = np.cumsum(length, dtype=np.int32) - length + np.int32(len(self._ids))
        self._ids = np.append(self._ids, np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(length.sum())))
        return place, length

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin; null counts as empty."""
        plain = [t or "" for t in texts.to_pylist()]
        if self._literal is None:
            return self._encode(plain)
        # Text, token, text, token, text: the texts between tokens are encoded each apart.
        parts = [self._literal.split(t) for t in plain]
        ids, at = self._encode([p for x in parts for p in x[::2]])
        tokens = np.array([self._added[p] for x in parts for p in x[1::2]], dtype=ids.dtype)
        pieces = np.array([len(x) // 2 + 1 for x in parts], dtype=np.int64)
        first = np.append(0, np.cumsum(pieces))
        inner = np.ones(len(at) - 1, dtype=bool)
        inner[first[1:] - 1] = False
        return np.insert(ids, at[1:][inner], tokens), at[first] + first - np.arange(len(first))

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined, points, begin, end, first = self._words(texts)
        hashes = SpanHash(points).of(begin, end)
        if len(self._ids) > _MOST_IDS:
            self._forget()
        slot = (hashes % np.uint64(len(self._known))).astype(np.int64)
        place, length = self._place[slot], self._length[slot]
        new = np.flatnonzero(self._known[slot] != hashes)
        if len(new):
            distinct, sample, number = np.unique(hashes[new], return_index=True, return_inverse=True)
            at = new[sample]
            new_place, new_length = self._learn(joined, begin[at], end[at])
            place[new], length[new] = new_place[number], new_length[number]
            # Of new words with one slot the last is remembered, in all three tables.
            self._known[slot[at]], self._place[slot[at]], self._length[slot[at]] = distinct, new_place, new_length
        edges = np.append(0, np.cumsum(length, dtype=np.int64))
        ids = self._ids[np.repeat(place - edges[:-1], length) + np.arange(edges[-1])]
        return ids, edges[first]
