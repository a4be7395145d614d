import hashlib

from cdclake.llm.decontaminate import contamination

from . import corpus


def brute(text, items):
    w = corpus.words(text)
    hit, found = set(), set()
    for name, item in items:
        v = corpus.words(item)
        size = min(13, len(v))
        for j in range(max(1, len(v) - 12) if v else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[j : j + size]:
                    hit.update(range(i, i + size))
                    found.add(name)
    names = sorted(str(n) for n in found if n is not None)
    return len(w), len(hit), names, hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_hits_are_those_of_a_plain_search(spark, docs):
    texts = corpus.documents()
    long = texts[3][1].split(" ")
    items = [(10, " ".join(long[:20])), (9, " ".join(long[5:30])), (9, "Changed"), (1, None), (2, "!"), (None, " ".join(long[:14])), (3, "one")]
    table = spark.createDataFrame(items, "item_id long, text string")
    extra = docs.withColumnsRenamed({"n_chars": "n.chars"})
    for block in (1 << 20, 300):
        got = contamination(extra, table, block_bytes=block)
        assert got.columns == [*extra.columns, "contamination"]
        rows = {(r.doc_id, r.text): tuple(r.contamination) for r in got.collect()}
        for row in texts:
            assert rows[row[:2]] == brute(row[1], items), row
        assert got.count() == len(texts)


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contamination.contaminated or r.contamination.n_hit for r in contamination(docs, items).collect())
    assert contamination(no_docs, items).count() == 0
