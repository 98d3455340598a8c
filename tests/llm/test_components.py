"""Connected components against union-find."""

from __future__ import annotations

import random

from flowloom.llm.components import connected_components


def by_hand(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)]
    edges += [(1000 + i, 1001 + i) for i in range(150)]  # a chain
    edges += [(5000, 5001 + i) for i in range(300)] + [(5300, 9000)]  # a hub
    edges += edges[:20] + [(-5, 7), (-(1 << 62), 12)]
    edges = [e for e in edges if e[0] != e[1]]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == by_hand(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
