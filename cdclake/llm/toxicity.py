"""Toxicity as multiple-instance learning: sentences score, documents combine them by noisy-or."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.tables import column, held_out, with_struct
from cdclake.llm.words import SpanHash, Words

#: Hashed features of a sentence: its words and their beginnings of these many bytes.
FEATURES = 1 << 20
BEGINNINGS = (4, 5, 6)
#: Features in fewer documents of the sample are not learned.
LEAST_DOCUMENTS = 3
#: About this many documents with and as many without the label are learned from.
SAMPLE = 2500
#: Sentences of a document that learning looks at are all of it; documents longer than this are passed over in the sample.
SAMPLE_WORDS = 5000
#: Log-odds from which learning begins with a feature; it begins with all others at 0.
CLEAR = 2.0
OFFENDING = 0.5

_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True

RESULT = "score double, predicted int, start array<long>, end array<long>, sentence_score array<double>"


class Sentences:
    """The words of a batch of texts as features, and the sentences they are in.

    A sentence ends at a full stop, exclamation or question mark or line break. ``first`` has the first
    word of each sentence and the end, ``text`` the row each sentence is in.
    """

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts)
        stops = np.append(0, np.cumsum(_STOPS[words.data]))
        number = stops[words.start]
        new = np.ones(len(words), dtype=bool)
        new[1:] = (number[1:] != number[:-1]) | (words.text[1:] != words.text[:-1])
        self.first = np.append(np.flatnonzero(new), len(words))
        self.text = words.text[self.first[:-1]]
        spans = SpanHash(words.data)
        hashes = [words.hash] + [spans.of(words.start, np.minimum(words.end, words.start + n), n) for n in BEGINNINGS]
        #: A row per word.
        self.features = (np.stack(hashes, axis=1) % np.uint64(FEATURES)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each sentence: logistic in the sum of its features' weights."""
        if len(first) < 2:
            return np.zeros(0)
        words = sum(self.weights[features[:, k]] for k in range(features.shape[1]))
        return 1 / (1 + np.exp(-np.clip(np.add.reduceat(words, first[:-1]) + self.bias, -30, 30)))

    def document_scores(self, sentence: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """Noisy-or: a document is toxic unless all its sentences fail to make it so."""
        return -np.expm1(np.bincount(text, np.log1p(-np.minimum(sentence, 1 - 1e-12)), minlength=n))


def fit(
    features: np.ndarray, first: np.ndarray, text: np.ndarray, label: np.ndarray, weight: np.ndarray, epochs: int = 30,
    rate: float = 0.05, shrink: float = 1e-6,
) -> Model:
    """Gradient ascent on the weighted likelihood of document labels under noisy-or, in Adagrad steps.

    The bias starts low: a sentence is taken for harmless until its words say otherwise.
    """
    sentence_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(label)
    seen = np.unique(features.astype(np.int64) * n + text[sentence_of][:, None])
    toxic = label[seen % n] == 1
    with_label = np.bincount(seen[toxic] // n, minlength=FEATURES) * (n / max(1, 2 * label.sum()))
    without = np.bincount(seen[~toxic] // n, minlength=FEATURES) * (n / max(1, 2 * (n - label.sum())))
    learned = np.bincount(seen // n, minlength=FEATURES) >= LEAST_DOCUMENTS
    # Begin with the log-odds of features whose documents clearly differ, shared by a word's features.
    odds = np.log((with_label + 2) / (without + 2))
    model = Model(np.where(learned & (odds > CLEAR), odds, 0) * (2 / features.shape[1]), -6.0)
    squares, bias_squares, total = np.full(FEATURES, 1e-6), 1e-6, weight.sum()
    for _ in range(epochs):
        sentence = model.sentence_scores(features, first)
        document = np.clip(model.document_scores(sentence, text, n), 1e-9, 1 - 1e-9)
        # d log-likelihood / d sentence logit: -p for clean documents, p (1 - P) / P for toxic ones.
        pull = (weight * np.where(label == 1, (1 - document) / document, -1.0))[text] * sentence / total
        by_word = pull[sentence_of]
        slope = sum(np.bincount(features[:, k], by_word, minlength=FEATURES) for k in range(features.shape[1]))
        slope = np.where(learned, slope, 0) - shrink * model.weights
        squares += slope**2
        model.weights += rate * slope / np.sqrt(squares)
        slope = float(pull.sum())
        bias_squares += slope**2
        model.bias += 0.1 * rate * slope / bias_squares**0.5
    return model


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE,
) -> Model:
    """Learn from a bounded sample of labelled documents outside the held-out fold.

    For each label all documents, or where there are more a fixed choice of about ``sample`` by a hash of
    the id. Their word features come to the driver, no texts; documents of more than ``SAMPLE_WORDS`` words
    are not learned from. Of rows that share an id that with the smallest text is. Labels other than 0 and 1 are not used; a document with both labels is not used.
    """
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    marks = labels.select(column(doc_id).alias("doc_id"), column(label).cast("int").alias("label"))
    marks = marks.filter("label IN (0, 1)").filter(~held_out("doc_id")).groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("most")
    ).filter("label = most")
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model(np.zeros(FEATURES), -6.0 if not counts.get(1) else 6.0)
    often = [F.when(F.col("label") == k, sample / n) for k, n in counts.items() if n > sample]
    share = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    chosen = marks.filter(share < F.coalesce(*often, F.lit(2.0))).select("doc_id", "label")

    def start():
        def features(texts: pa.Array, _) -> list[pa.Array]:
            found = Sentences(texts)
            edges = np.searchsorted(found.text, np.arange(len(texts) + 1))
            return [
                pa.ListArray.from_arrays(
                    pa.array(found.words.first * found.features.shape[1], pa.int32()), pa.array(found.features.ravel())
                ),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.diff(found.first), pa.int32())),
            ]

        return features

    # The ids of the sample are few by its bound, so the documents stay where they are.
    picked = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    made = with_struct(picked, "f", "feature array<int>, sizes array<int>", start, "text")
    table = made.filter(F.size("f.feature") <= SAMPLE_WORDS * (1 + len(BEGINNINGS))).select("label", "f.*").toArrow()
    if not table.num_rows:
        return Model(np.zeros(FEATURES), -6.0)
    features = table.column("feature").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = table.column("sizes").combine_chunks()
    text_of = np.repeat(np.arange(table.num_rows), np.diff(sizes.offsets.to_numpy()))
    first = np.append(0, np.cumsum(sizes.flatten().to_numpy(zero_copy_only=False)))
    label_of = table.column("label").to_numpy()
    # Each label weighs as much as it does among all labelled documents.
    weight = np.array([counts[0], counts[1]]) / np.maximum(np.bincount(label_of, minlength=2), 1)
    return fit(features.reshape(-1, 1 + len(BEGINNINGS)), first, text_of, label_of, weight[label_of])


def score(docs: DataFrame, model: Model, name: str = "toxicity", text: str = "text") -> DataFrame:
    """Every row with a struct column ``name``, from its whole text alone.

    Fields: ``score``, the noisy-or of all sentences' scores; ``predicted``, 1 if it is at least 0.5;
    ``start``, ``end`` and ``sentence_score``: byte offsets (in UTF-8) and scores of the sentences that
    score at least 0.5 themselves. Null texts and texts without words score 0.
    """
    used = np.flatnonzero(model.weights).astype(np.int32)
    values, bias = model.weights[used].astype(np.float32), model.bias

    def start():
        weights = np.zeros(FEATURES)
        weights[used] = values
        own = Model(weights, bias)

        def tell(texts: pa.Array, _) -> list[pa.Array]:
            found = Sentences(texts)
            sentence = own.sentence_scores(found.features, found.first)
            document = own.document_scores(sentence, found.text, len(texts))
            bad = np.flatnonzero(sentence >= OFFENDING)
            edges = pa.array(np.searchsorted(found.text[bad], np.arange(len(texts) + 1)), pa.int32())
            base = found.words.at[found.text[bad]]
            begin = found.words.start[found.first[bad]] - base
            end = found.words.end[found.first[bad + 1] - 1] - base
            lists = [pa.ListArray.from_arrays(edges, pa.array(x)) for x in (begin, end, sentence[bad])]
            return [pa.array(document), pa.array((document >= 0.5).astype(np.int32)), *lists]

        return tell

    return with_struct(docs, name, RESULT, start, text)
