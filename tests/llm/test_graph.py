from __future__ import annotations

import random

from docketrank.llm.graph import connected_components


def components_of(edges):
    head = {}

    def root(x):
        head.setdefault(x, x)
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            head[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(head)}


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a chain
    edges += [(2000, 2001 + i) for i in range(100)]  # a star
    edges += [(5, 5), (None, 3), (7, None), edges[0], edges[0]]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == components_of(edges)
    assert len(found) == len({r["node"] for r in found})


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
