import random

from cdclake.llm.components import components

from . import corpus


def test_components_are_those_of_a_plain_search(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(k, k + 1) for k in range(300, 360)] + [(400, k) for k in range(401, 440)] + edges[:20] + [(7, 7), (None, 3), (900, None)]
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    expected = corpus.reachable({v for e in real for v in e}, real)
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(got) == len(expected)
    assert {r.node: r.component for r in got} == expected


def test_no_edges_no_rows(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
