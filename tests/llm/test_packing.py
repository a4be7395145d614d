import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cdclake.llm import packing

from . import corpus

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200))
def test_plan_holds_every_piece_once_and_fits(lengths):
    counts = np.bincount(lengths, minlength=41)
    total = np.zeros(41, dtype=int)
    for bins, taken in packing.plan_bins(counts, 40):
        assert bins > 0 and sum(n * size for size, n in taken.items()) <= 40
        for size, n in taken.items():
            total[size] += bins * n
    assert (total == counts).all()


def test_smallest_piece_gives_way_to_two_that_fit_better():
    # 6 + 3 leaves a gap of 1; 6 + 2 + 2 leaves none.
    plan = packing.plan_bins(np.bincount([6, 3, 2, 2], minlength=11), 10)
    assert plan[0] == (1, {6: 1, 2: 2})


def test_encoder_gives_the_ids_of_the_library(library):
    import pyarrow as pa

    from cdclake.llm.tokens import WordEncoder

    texts = ["It's  can't''ll", "ÀÉ ß Σς İ", "á ́x", "12½ ٣", "<|endoftext|>", "", None, "日本 x\x1cy\n\t", "'sing 're.'"]
    ids, at = WordEncoder(PATH, slots=3).encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_characters_newer_than_python_knows_are_split_as_the_library_does():
    import pyarrow as pa

    from cdclake.llm.tokens import WordEncoder

    plain = Tokenizer.from_file(PATH)
    points = [*range(1, 0xD800, 7), 0x1C89, 0xA7CB, 0x105C0, *range(0xE000, 0x110000, 101), *range(0x10D40, 0x10D70)]
    texts = [f"a{chr(p)}b {chr(p)}{chr(p)}1 !{chr(p)}\u0301" for p in points]
    ids, at = WordEncoder(PATH, added=True).encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, hex(points[k])


def test_added_tokens_have_the_ids_of_the_plain_library(spark):
    import pyarrow as pa

    from cdclake.llm.tokens import WordEncoder

    plain = Tokenizer.from_file(PATH)
    texts = [
        "a <|endoftext|> b", "<|endoftext|>", "<|startoftext|><|endoftext|>x<|endoftext|>", "", None, "<|ENDOFTEXT|> <|endoftext|",
        "e<|endoftext|>\u0301'll", "<<|endoftext|>>", "no token",
    ]
    expected = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert expected[0] == [320, 49407, 321]
    for some in (texts, texts[-1:], texts[3:5], []):
        ids, at = WordEncoder(PATH, slots=3, added=True).encode(pa.array(some, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == expected[texts.index(some[0]) :][: len(some)] if some else True
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]
    got = packing.pack_documents(spark.createDataFrame(rows, corpus.SCHEMA), PATH).collect()
    crc = [zlib.crc32(np.array([*e, 0], dtype="<u4").tobytes()) for e in expected]
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in got) == [(k, len(e) + 1, crc[k]) for k, e in enumerate(expected)]


def test_sequences_hold_all_pieces_gapless(spark, docs, library):
    capacity = 64
    rows = [r.asDict() for r in packing.pack_documents(docs, PATH, capacity=capacity).collect()]
    expected = []
    for doc_id, text, *_ in corpus.documents():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = np.array(ids[start : start + capacity], dtype="<u4")
            expected.append((doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=key) == sorted(expected, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= sum(e[3] for e in expected) / capacity * 1.05 + 1


def test_no_documents(no_docs):
    assert packing.pack_documents(no_docs, PATH).count() == 0
