import base64
import random
import re

import pyarrow as pa
import pytest
import zstandard

from cdclake.llm import quality
from cdclake.llm.tables import fresh

from . import corpus


def plain(text):
    """The counted columns, by the rules as they are worded."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, again = len(words), len(covered)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": again, "base_failed": n < 20 or 100 * again > 30 * n,
    }


def verdict(text):
    """Ratios and decision, one text and one chunk at a time."""
    data = (text or "").encode()

    def band(part):
        ratio = len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part)
        limits = [(lo, hi) for size, lo, hi in quality.BANDS if size <= len(part)]
        return ratio, bool(limits) and not limits[-1][0] <= ratio <= limits[-1][1]

    if not data:
        return None, 0.0, False
    chunks = [data[k : k + 4096] for k in range(0, len(data), 4096)]
    outside = sum(len(c) for c in chunks if band(c)[1]) / len(data)
    ratio, bad = band(data)
    return ratio, outside, not plain(text)["base_failed"] and not bad and outside <= 0.3


def texts():
    rng = random.Random(5)
    odd = ["", None, " \n\t ", "a b c \u0085 d", "one\n\none\n one\none \n", "é\U0001f600 # $$ <|>", "\n", "x" * 9000,
           "a b c d e f g h " * 3, "same line here\nsame line here\nother", "w " * 7, "w " * 8, "w " * 9]
    prose = [corpus.prose(rng, "bb", n) for n in (5, 19, 20, 21, 40, 300, 3000)]
    noise = base64.b64encode(rng.randbytes(12_000)).decode()
    half = corpus.prose(rng, "aa", 900) + "\n" + "and so on " * 2000
    return [*odd, *prose, " ".join(noise[k : k + 60] for k in range(0, len(noise), 60)), half, prose[-1] + prose[-1], *[r[1] for r in corpus.documents(3, 20)]]


def test_counts_are_those_of_the_plain_rules():
    batch = texts()
    found = quality.counts(pa.array(batch, pa.string()))
    for k, text in enumerate(batch):
        expected = plain(text)
        assert {c: int(v[k]) for c, v in found.items()} == {c: expected[c] for c in found}, text


def test_windows_do_not_reach_into_the_next_text():
    for batch in (["w " * 9, "x y z"], ["a b c d", "e f g h", "a b c d", "e f g h"], ["a b c d e f g h", "a b c d e f g h"]):
        found = quality.counts(pa.array(batch))["n_repeat_words"]
        assert found.tolist() == [plain(t)["n_repeat_words"] for t in batch]


def test_decisions_are_those_of_one_text_at_a_time(spark):
    rows = [(k, t, "x") for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string").repartition(3)
    name = fresh(docs, "quality")
    got = {r["doc_id"]: r[name] for r in quality.quality(docs, name).collect()}
    assert len(got) == len(rows)
    for k, text, _ in rows:
        ratio, outside, kept = verdict(text)
        assert (got[k]["ratio"], got[k]["kept"], got[k]["base_failed"]) == (ratio, kept, plain(text)["base_failed"]), text
        assert got[k]["outside"] == pytest.approx(outside)


def test_repetitive_and_incompressible_texts_go_and_prose_stays():
    ratios = quality.Ratios(quality.BANDS, 4096, 3)
    rng = random.Random(6)

    def kept(text):
        whole, bad, least, most, outside = ratios.of(memoryview(text.encode()))
        return not bad and outside <= 0.3

    assert all(kept(corpus.prose(rng, lang, n)) for lang in ("bb", "cc") for n in (30, 60, 200, 1000, 5000))
    assert not any(kept("all work and no play makes a dull text. " * n) for n in (8, 30, 1000))
    assert not any(kept(base64.b64encode(rng.randbytes(n)).decode()) for n in (1000, 5000, 100_000))
    prose = corpus.prose(rng, "bb", 3000)
    assert not kept(prose + base64.b64encode(rng.randbytes(len(prose))).decode())


def test_long_texts_are_compressed_in_pieces(spark):
    rng = random.Random(7)
    text = corpus.prose(rng, "bb", 250_000)
    assert len(text) > 1 << 20
    ratio, bad, *_ = quality.Ratios(quality.BANDS, 4096, 3).of(memoryview(text.encode()))
    assert ratio == pytest.approx(len(zstandard.ZstdCompressor(level=3).compress(text.encode())) / len(text.encode()), rel=0.01)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.quality(docs).select("quality.n_words").first()[0] == len(text.split())


def test_repeated_rows_ids_and_empty_tables(spark, docs, no_docs):
    assert quality.quality(no_docs).count() == 0
    assert quality.quality(docs).count() == docs.count()
    twice = quality.quality(docs.union(docs)).select("text", "quality.*").distinct()
    assert twice.count() == docs.select("text").distinct().count()
