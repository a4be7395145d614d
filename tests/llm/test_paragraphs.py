import random

from cdclake.llm import paragraphs

from . import corpus


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(11)
    rows, holders = [], {}
    for p in range(12):
        passage = corpus.prose(rng, "bb", 80)
        for k in range(3):
            doc = 1000 * (p + 1) + k
            text = passage if k == 0 else f"{corpus.prose(rng, 'aa', 30)} {passage} {corpus.prose(rng, 'cc', 30)}"
            rows.append((doc, text, "x"))
            holders.setdefault(p, set()).add(doc)
    clean = [(k, corpus.prose(rng, "aa", 120), "x") for k in range(40)]
    formula = [(k + 100, f"{corpus.prose(rng, 'aa', 40)}\nSee the terms of use.\n{corpus.prose(rng, 'cc', 40)}", "x") for k in range(9)]
    table = spark.createDataFrame(rows + clean + formula, "doc_id long, text string, digest string")
    got = paragraphs.repeated_paragraphs(table).collect()
    found = {r.doc_id for r in got}
    assert found == set.union(*holders.values())
    texts = {d: t for d, t, _ in rows}
    for r in got:
        assert len(corpus.words(texts[r.doc_id].encode()[r.start : r.end].decode())) == r.n_words
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.cluster_id for r in got})
    for r in kept:
        assert (r.doc_id, r.paragraph) == min((x.doc_id, x.paragraph) for x in got if x.cluster_id == r.cluster_id)


def test_pairs_of_lines_are_those_of_a_plain_search(spark, monkeypatch):
    monkeypatch.setattr(paragraphs, "ENDS", 10**6)
    monkeypatch.setattr(paragraphs, "LONG_SENTENCE", 10**6)
    rng = random.Random(4)
    lines = [corpus.prose(rng, "aa", 40).replace("\n", " ") for _ in range(15)]
    for k in range(15):
        for edits in (1, 4):
            own = lines[k].split(" ")
            for e in range(edits):
                own[(e * 9 + k) % len(own)] = f"new{e}{k}"
            lines.append(" ".join(own))
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    sets = [corpus.shingles(x) for x in lines]
    links = [(a, b) for a in range(len(lines)) for b in range(a) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    least = corpus.reachable(range(len(lines)), links)
    got = paragraphs.repeated_paragraphs(table, recall=0.9999, most_hashes=64).collect()
    clusters = {}
    for r in got:
        clusters.setdefault(r.cluster_id, set()).add(r.doc_id)
    expected = {}
    for k, low in least.items():
        expected.setdefault(low, set()).add(k)
    assert sorted(map(sorted, clusters.values())) == sorted(sorted(v) for v in expected.values() if len(v) > 1)


def lines(rng, lang, sizes):
    words = corpus.words(corpus.prose(rng, lang, sum(sizes) + 20))
    return "\n".join(" ".join(words.pop() for _ in range(n)) for n in sizes)


def test_passages_of_short_lines_are_found(spark):
    rng = random.Random(21)
    shapes = [[5] * 12, [2] * 30, [1, 7, 3, 4] * 4, [10, 3, 10, 2, 10]]
    passages = [lines(rng, "bb", shapes[p % 4]) for p in range(24)]
    rows, holders = [], set()
    for p, passage in enumerate(passages):
        for k in range(3):
            sizes = [[], [4] * 9, [40]][k]
            rows.append((100 * (p + 1) + k, "\n".join([lines(rng, "aa", sizes), passage, lines(rng, "cc", sizes)])))
            holders.add(rows[-1][0])
    clean = [(k, lines(rng, "aa", [5] * 12)) for k in range(40)]
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()
    found = {r.doc_id for r in got}
    assert found <= holders
    assert len(found) >= 0.97 * len(holders)
    texts = dict(rows)
    for r in got:
        assert len(corpus.words(texts[r.doc_id].encode()[r.start : r.end].decode())) == r.n_words


def test_odd_rows(spark, docs, no_docs):
    got = paragraphs.repeated_paragraphs(docs.withColumnRenamed("lang", "digest")).collect()
    assert {100, 200, 300, 301, 302, 303} <= {r.doc_id for r in got}
    assert not {401, 402, 403, 404, 405} & {r.doc_id for r in got}
    assert paragraphs.repeated_paragraphs(no_docs).count() == 0
