import numpy as np
import pyarrow as pa
import pytest

from cdclake.llm.words import SpanHash, Words, choose_bands, slices

from . import corpus

TEXTS = [None, "", "A b-c", "é1ü x", "", "no end", "Dog", "!!", "ünï cödé 日本"]


def test_words_are_those_of_the_pattern():
    found = Words(pa.array(TEXTS))
    for k, text in enumerate(TEXTS):
        own = [bytes(found.data[a:b]).decode() for a, b in zip(
            found.start[found.first[k] : found.first[k + 1]], found.end[found.first[k] : found.first[k + 1]], strict=True)]
        assert own == corpus.words(text)


def test_equal_words_have_equal_hashes_wherever_they_are():
    found = Words(pa.array(["x abc", "abc", "ABC y", "abcd"]))
    assert found.hash[1] == found.hash[2] == found.hash[3]
    assert len(set(found.hash.tolist())) == 4


def test_shingles_of_short_texts_and_slices_of_arrays():
    array = pa.array(["skip me", "a b c", "a b c d e f", "", None]).slice(1)
    shingles, at = Words(array).shingles(5)
    assert np.diff(at).tolist() == [1, 2, 0, 0]
    assert len(set(shingles.tolist())) == 3


def test_span_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"abcabcxabc", dtype=np.uint8)
    at = np.array([0, 3, 7])
    assert len(set(SpanHash(data).of(at, at + 3).tolist())) == 1


def test_slices_cover_all_rows():
    array = pa.array(["a" * 10, None, "b" * 100, "", "c"])
    assert list(slices(array, 20)) == [(0, 2), (2, 3), (3, 5)]
    assert list(slices(pa.array([], pa.string()), 20)) == []


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.999), (0.5, 0.9), (0.95, 0.99)):
        bands, rows = choose_bands(similarity, recall, 128)
        assert 1 - (1 - similarity**rows) ** bands >= recall
    with pytest.raises(ValueError):
        choose_bands(0.1, 0.999, 4)
