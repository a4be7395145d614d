import random

import numpy as np

from cdclake.llm import language

from . import corpus


def test_held_out_texts_get_their_language(spark):
    rng = random.Random(1)
    rows = [(k, corpus.prose(rng, lang, 40), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.language for r in language.predict(table, language.learn(table, sample=20)).collect()}
    assert all(got[i].lang_pred == lang and 0 < got[i].score <= 1 for i, _, lang in rows)


def test_only_labelled_rows_outside_the_fold_teach(spark):
    table = spark.createDataFrame(
        [(None, "kalo mita", "xx"), (1, None, "yy"), (2, "kalo", None), (3, "1 2 3", "zz"), (4, "mita", "aa")],
        "doc_id long, text string, lang string")
    from zlib import crc32

    expected = ["aa"] if crc32(b"4") % 5 else []
    assert language.learn(table).languages == expected


def test_odd_texts(spark, docs, no_docs):
    profiles = language.learn(docs)
    told = docs.withColumnRenamed("n_chars", "language.x").select("*", "text")
    rows = language.predict(docs, profiles).collect()
    assert told.count() == len(rows)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang_pred == "und") == (not letters)
        assert (r.language.score == 0) or letters
    nothing = language.learn(no_docs)
    assert nothing.languages == []
    assert {r.language.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(no_docs, profiles).count() == 0


def test_vectors_are_sums_of_bound_letters(monkeypatch):
    encoder = language.Encoder(dimensions=64)
    text = "Ab, ab!"
    letters = " ab ab "
    total = sum(
        np.roll(encoder._vector(ord(a)), 2) * np.roll(encoder._vector(ord(b)), 1) * encoder._vector(ord(c))
        for a, b, c in zip(letters, letters[1:], letters[2:], strict=False)
    )
    vectors, _ = encoder.vectors([text, "x", text])
    assert np.allclose(vectors[0], total / np.linalg.norm(total), atol=1e-6)
    assert np.allclose(vectors[0], vectors[2])
    monkeypatch.setattr(language, "_SEGMENT", 4)
    assert np.linalg.norm(encoder.vectors(["abcdefgh"])[0]) > 0
