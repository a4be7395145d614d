import random

import numpy as np

from cdclake.llm import toxicity

from . import corpus


def labelled(n=300, seed=2):
    rng = random.Random(seed)
    rows, marks = [], []
    for k in range(n):
        words = corpus.prose(rng, "aa", 60).split(" ")
        bad = k % 3 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["vileness", "vilest", "rotten"])
        rows.append((k, " ".join(words), "x"))
        marks.append((k, int(bad)))
    return rows, marks


def test_held_out_documents_and_their_sentences(spark):
    rows, marks = labelled()
    table = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([*marks, (1, 1), (2, 7), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(table, labels)
    got = toxicity.score(table, model).collect()
    right = sum(r.toxicity.predicted == int(r.doc_id % 3 == 0) for r in got)
    assert right >= 0.97 * len(rows)
    for r in got:
        assert 0 <= r.toxicity.score <= 1
        for a, b, s in zip(r.toxicity.start, r.toxicity.end, r.toxicity.sentence_score, strict=True):
            assert s >= 0.5
            sentence = r.text.encode()[a:b].decode()
            assert "." not in sentence and "\n" not in sentence
            if r.doc_id % 3 == 0 and len(r.toxicity.start) == 1:
                assert any(w in sentence for w in ("vile", "rotten"))


def test_noisy_or():
    model = toxicity.Model(np.zeros(toxicity.FEATURES), 0.0)
    scores = model.document_scores(np.array([0.5, 0.5, 0.2]), np.array([0, 0, 2]), 3)
    assert np.allclose(scores, [0.75, 0, 0.2])


def test_odd_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "doc_id long, toxic int")
    for model in (toxicity.learn(docs, labels), toxicity.learn(no_docs, labels), toxicity.learn(docs, labels.limit(0))):
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == docs.count()
        assert all(r.toxicity.score == 0 for r in rows if not corpus.words(r.text))
        assert toxicity.score(no_docs, model).count() == 0
