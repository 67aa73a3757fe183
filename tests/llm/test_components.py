import numpy as np

from rinkframe.llm.components import components


def test_against_union_find(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(int(a), int(b)) for a, b in rng.integers(0, 90, (50, 2))] + [(7, 7), (200, 201), (201, 200)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
