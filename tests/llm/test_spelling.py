import random
import re
import zlib
from collections import Counter

import pytest

from cdclake.llm import spelling



def plain_counts(rows):
    """Words and counts, run by run."""
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    out, forms = [], {}
    for w, n in counts.items():
        others = [(-m, v) for v, m in counts.items() if near(w, v)]
        best = min(others, default=None)
        forms[w] = best[1] if best and -best[0] >= 2 * n else None
        out.append([w, forms[w], None, n, len(others), counts[forms[w]] if forms[w] else None])
    for row in out:
        row[2] = row[0]
        while forms[row[2]]:
            row[2] = forms[row[2]]
    return sorted(map(tuple, out), key=repr)


def variants(spark, counts):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.spelling_variants(rows).collect()), key=repr)


def test_counts_are_those_of_each_run(spark):
    rng = random.Random(2)
    words = ["tables", "Tables", "Étérnel", "étérnel", "a×b÷cdef", "kurz", "x" * 300, "naïve", "œuvre"]
    rows = [(k, " ".join(rng.choice(words) + rng.choice([" ", ",", "1", "’", "\n"]) for _ in range(200))) for k in range(80)]
    rows += [(None, "tables tables tables"), (81, None), (82, ""), (83, "..."), (5, rows[5][1]), (84, "y" * 70_000 + " z")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n long").repartition(5)
    got = {r["word"]: r["n"] for r in spelling.count_words(docs).collect()}
    assert got == plain_counts(rows)
    assert any(len(w) == 299 for w in got)


def test_variants_of_random_words(spark):
    rng = random.Random(3)
    counts = {}
    for _ in range(1500):
        word = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        counts[word] = rng.choice([3, 3, 4, 6, 8, 16, 40, 100])
    assert variants(spark, counts) == plain_variants(counts)


def test_variants_of_long_words(spark):
    rng = random.Random(4)
    counts = {}
    for size in (62, 63, 64, 65, 66, 200):
        base = "".join(rng.choice("ab") for _ in range(size))
        for _ in range(25):
            at = rng.randrange(len(base))
            counts[base] = rng.choice([3, 5, 10, 10, 20])
            base = rng.choice([base[:at] + base[at + 1 :], base[:at] + "ba" + base[at + 1 :], base[:at] + "b" + base[at + 1 :]])
    counts |= {"a" * n: 3 + n % 7 for n in range(58, 72)}
    assert variants(spark, counts) == plain_variants(counts)


def test_a_word_of_any_length_costs_its_length(spark):
    counts = {"q" * 300_000: 3, "q" * 299_999: 9, "q" * 299_998 + "r": 9}
    got = {r[0][-2:] + str(len(r[0])): (r[1] and len(r[1]), r[4]) for r in variants(spark, counts)}
    # Both others are near and occur as often; the first in order of code points is the form.
    assert got == {"qq300000": (299_999, 1), "qq299999": (None, 2), "qr299999": (None, 1)}


def test_forms_lead_to_the_last_one(spark):
    counts = {"abcde": 3, "abcdf": 6, "abcgf": 12, "abhgf": 24, "aihgf": 48, "jihgf": 96, "jihgk": 95}
    got = {r[0]: (r[1], r[2]) for r in variants(spark, counts)}
    assert got["abcde"] == ("abcdf", "jihgf") and got["aihgf"] == ("jihgf", "jihgf")
    assert got["jihgk"] == (None, "jihgk")
    with pytest.raises(ValueError, match="more often"):
        spelling.spelling_variants(spark.createDataFrame([("a", 1)], "word string, n long"), times=1)


def test_repeated_null_and_marked_words_and_no_words(spark):
    rows = [("table", 2), ("table", 3), (None, 9), ("ta\x00ble", 9), ("tables", 2)]
    got = spelling.spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()
    assert sorted(map(tuple, got)) == [("table", None, "table", 5, 1, None), ("tables", "table", "table", 2, 1, 5)]
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_whole_texts(spark, docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(map(tuple, spelling.spelling_variants(spelling.count_words(docs)).collect()), key=repr)
    assert got == plain_variants(plain_counts(rows))
    assert spelling.count_words(no_docs).count() == 0
