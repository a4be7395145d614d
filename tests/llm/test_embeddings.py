import math

import numpy as np
import pytest

from cdclake.llm import embeddings

from . import corpus

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, copies int"


def vectors(n=400, dims=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    for k in range(0, n // 2, 2):
        x[k + 1] = x[k] + rng.normal(scale=rng.choice([0.05, 0.3, 0.4]), size=dims)
    x[n - 40 :] = x[0] + rng.normal(scale=0.15, size=(40, dims))
    rows = [(k, [float(v) for v in x[k]], int(k // 2 % 3) if k < n - 40 else 0) for k in range(n)]
    rows += [(1000 + k, rows[2][1], rows[2][2]) for k in range(5)] + [(2000, [2 * v for v in rows[2][1]], rows[2][2])]
    odd = [None, [], [0.0] * dims, [math.nan] * dims, [math.inf] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1), [1.0, 0.0], [1.0, 0.1]]
    rows += [(3000 + k, v, 0) for k, v in enumerate(odd)] + [(4000, rows[2][1], None), (None, rows[2][1], rows[2][2]), (5, rows[5][1], rows[5][2])]
    return [(*r, 1, 1) for r in rows]


def brute(rows):
    good = []
    for i, v, label, *_ in rows:
        usable = i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if usable:
            good.append((i, label, np.array(v) / np.linalg.norm(v)))
    counts = {r[0]: 0 for r in rows if r[0] is not None}
    links = []
    for a, (i, label, x) in enumerate(good):
        for j, other, y in good[a + 1 :]:
            if label == other and len(x) == len(y) and float(x @ y) >= 0.93:
                links.append((i, j))
                counts[i] += 1
                if i != j:
                    counts[j] += 1
    return counts, corpus.reachable(counts, links), {frozenset(e) for e in links}


@pytest.mark.parametrize("block", [1024, 16])
def test_links_are_those_of_a_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = vectors()
    got = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    counts, least, _ = brute(rows)
    found = sum(r.n_links for r in got if r.vec_id is not None)
    assert found >= 0.9 * sum(counts.values())
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
            continue
        assert r.n_links <= counts[r.vec_id]
        assert r.kept == (r.vec_id == r.component_id)
    same = sum(r.n_links == counts[r.vec_id] and r.component_id == least[r.vec_id] for r in got if r.vec_id is not None)
    assert same >= 0.9 * len(got)


def test_table_distances_let_every_close_pair_pass():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    x[150:] = x[:150] + rng.normal(scale=0.1, size=(150, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = embeddings.Index.fit(x, 1, 0.93)
    codes, lost = index.encode(x, np.zeros(300, dtype=int))
    a, b = index.near(x, 0, codes, lost)
    passed = set(zip(a.tolist(), b.tolist(), strict=True))
    close = np.argwhere(x @ x.T >= 0.93)
    assert {tuple(p) for p in close.tolist()} <= passed
    assert len(passed) < 300 * 300 / 2


def uneven(n, dims, spread, seed):
    """Vectors in pairs near the threshold, whose components differ as ``spread`` says, in a random frame."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(spread))) * spread
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1::2] = x[::2] + 0.3 * rng.uniform(0, 1.2, size=(n // 2, 1)) * x[rng.permutation(n)[: n // 2]]
    x = x @ np.linalg.qr(rng.normal(size=(dims, len(spread))))[0].T
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize(
    "dims, spread", [(256, np.ones(3)), (256, np.ones(8)), (768, np.ones(8)), (384, 1 / np.arange(1, 385) ** 2.0)]
)
def test_every_close_pair_is_met_from_one_side(dims, spread):
    x = uneven(3000, dims, spread, 6)
    index = embeddings.Index.fit(x, 109, 0.93)
    own, near = index.probes(x)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    assert (own[a] != own[b]).sum() > 200
    assert (near[a, own[b]] | near[b, own[a]]).all()
    assert near.mean() < 0.9


def test_links_of_uneven_vectors_are_all_found(spark):
    x = uneven(600, 256, np.ones(8), 7).astype(np.float32)
    rows = [(k, [float(v) for v in x[k]], k // 2 % 3, 1, 1) for k in range(len(x))]
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)[0]


def test_no_vectors(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_any_size(spark):
    rows = [(k, [1.0 + k / 10_000, *[1.0] * 7], 1) for k in range(60)]
    rows += [(100, [1e-200] * 8, 1), (101, [1e200] * 8, 1), (102, [5e-324] * 8, 1), (103, [1e300, *[-1e300] * 7], 1)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (0, 103) if i == 103 else (62, 0) for i, *_ in rows}
