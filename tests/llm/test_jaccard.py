from cdclake.llm import jaccard

from . import corpus


def brute(rows):
    named = [(i, t) for i, t in rows if i is not None]
    sets = [(i, corpus.shingles(t)) for i, t in named]
    links = []
    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and len(x & y) / len(x | y) >= 0.8:
                links.append((i, j))
    counts = {i: 0 for i, _ in named}
    for i, j in links:
        counts[i] += 1
        if i != j:
            counts[j] += 1
    least = corpus.reachable(counts, links)
    return {i: (counts[i], least[i]) for i, _ in named}


def check(spark, rows):
    got = jaccard.ngram_join(spark.createDataFrame(rows, "doc_id long, text string, rep int, digest int"))
    assert got.columns == ["doc_id", "class_id", "n_links", "component_id", "kept"]
    out = got.collect()
    assert len(out) == len(rows)
    expected = brute([r[:2] for r in rows])
    for r in out:
        if r.doc_id is None:
            assert (r.class_id, r.n_links, r.component_id, r.kept) == (None, 0, None, True)
        else:
            assert (r.n_links, r.component_id) == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_links_are_those_of_a_plain_search(spark):
    check(spark, [(i, t, None, 1) for i, t, *_ in corpus.documents()])


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    base = corpus.documents()[5][1].split(" ") * 2
    rows = []
    for k in range(60):
        own = list(base)
        own[(k * 5) % len(own)] = f"edit{k}"
        rows.append((k, " ".join(own), None, 1))
    check(spark, rows + [(100 + k, rows[0][1], None, 1) for k in range(20)])


def test_no_documents(no_docs):
    assert jaccard.ngram_join(no_docs).count() == 0


def test_blocks_of_one_bucket_meet_once(spark):
    members = spark.createDataFrame([(1, k, 1) for k in range(1000)] + [(2, 7, 1)], "bucket long, digest long, n long")
    blocks = jaccard.in_blocks(members, ["bucket"], "digest")
    sizes = blocks.groupBy("bucket", "block_a", "block_b").count().collect()
    parts = -(-1000 // jaccard.BLOCK)
    assert len(sizes) == parts * (parts + 1) // 2
    assert max(r["count"] for r in sizes) < 3 * jaccard.BLOCK
