import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cdclake.llm import substrings

from . import corpus


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, digest string, key int")
    got = [tuple(r) for r in substrings.remove_repeats(table, **options).collect()]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    expected = [(i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], options.get("length", 400)), strict=True)]
    assert sorted(got, key=key) == sorted(expected, key=key)


def made(seed=5):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.randint(20, 90))) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts += [passage[cut:], "".join(rng.choice("hijk") for _ in range(rng.randint(0, 30)))]
        rows.append((k, "".join(parts)))
    return rows + [(None, rows[3][1]), (7, None), (7, ""), (8, "ab" * 100), (9, "z" * 51), (3, rows[3][1])]


def test_removed_bytes_are_those_of_a_plain_search(spark):
    check(spark, made(), length=50, gram=16)


def test_common_beginnings_beyond_one_task_are_counted(spark):
    check(spark, made(6), length=50, gram=16, most=3)


def test_documents_at_the_contracts_length(spark):
    check(spark, [(i, t) for i, t, *_ in corpus.documents()])


def test_occurrences_of_one_string_are_not_put_into_one_task(spark):
    text = "a" * 2000
    digest = hashlib.sha256(text.encode()).digest()
    prepared = spark.createDataFrame([(1, digest, text)], "doc_id long, digest binary, text string")
    suffixes = spark.createDataFrame([(digest, 1, 7, p, 2000) for p in range(0, 1900, 30)], "digest binary, rep long, gram long, place long, members long")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spans = substrings.repeated_spans(prepared, suffixes, 50, 16, 100)
        rows = spans.groupBy(F.spark_partition_id().alias("task")).count().collect()
        places = sorted(r["start"] for r in spans.select("start").collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert places == list(range(1891))
    assert max(r["count"] for r in rows) < 1000


def test_rows_of_a_frequent_key_stay_where_they_are(spark):
    rows = spark.range(0, 1200, 1, 4).selectExpr("if(id % 6 = 0, id, -1) AS gram", "id AS place")
    often = rows.groupBy("gram").count()
    found = substrings._looked_up(rows, often, ["gram"], "count", 100)
    frequent = found.filter("gram = -1").groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in frequent) == [250] * 4
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.join(often, "gram").collect()))


def test_spans_are_the_removed_runs(spark):
    passage, other = "".join(map(str, range(40))), "".join(chr(97 + k * k % 26) for k in range(60))
    texts = ["x" + passage + "yé", "é" + passage + "-" + other, other + "z", "alone", None, passage[:49]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in substrings.without_repeats(table, length=50, gram=16).collect()}
    spans = {k: [tuple(s) for s in r["spans"]] for k, r in found.items()}
    assert spans == {0: [(1, 71)], 1: [(2, 72), (73, 133)], 2: [(0, 60)], 3: [], 4: [], 5: []}
    for k, text in enumerate(texts):
        data = (text or "").encode()
        kept = b"".join(data[a:b] for a, b in zip([0, *[e for _, e in spans[k]]], [*[s for s, _ in spans[k]], len(data)], strict=True))
        assert found[k]["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_no_documents(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0


def test_equal_strings_have_a_sampled_suffix_at_one_offset(monkeypatch):
    monkeypatch.setattr(substrings, "_SEGMENT", 256)
    rng = random.Random(2)
    common = bytes(rng.randrange(4) for _ in range(64))
    data = b"".join(bytes(rng.randrange(256) for _ in range(rng.randint(0, 200))) + common for _ in range(30))
    at = np.array([0, len(data)])
    places, _ = substrings.sampled_suffixes(np.frombuffer(data, dtype=np.uint8), at, 64, 16)
    offsets, start = [], data.find(common)
    while start >= 0:
        offsets.append({int(p) - start for p in places if start <= p <= start + 48})
        start = data.find(common, start + 1)
    assert len(offsets) == 30 and set.intersection(*offsets)


def test_intervals_hold_all_occurrences():
    words = sorted(["abcab", "abcd", "abx", "abcae", "b", "b"])
    lcp = [len(_common(a, b)) for a, b in zip(words, words[1:], strict=False)]
    found = {(n, words[a], words[b]) for n, a, b in substrings.lcp_intervals(np.array(lcp), 1)}
    assert found == {(4, "abcab", "abcae"), (3, "abcab", "abcd"), (2, "abcab", "abx"), (1, "b", "b")}


def _common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


def test_common_lengths_of_strings():
    strings = substrings._Strings(pa.array([b"abc", b"abd", b"", b"abc\x00"], pa.binary()))
    assert strings.common(np.array([0, 0, 0]), np.array([1, 2, 3])).tolist() == [2, 0, 3]
