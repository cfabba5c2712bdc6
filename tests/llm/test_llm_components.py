"""Connected components against a plain union of sets."""

import random

import pytest

from parcelwise.llm.components import components


def plain(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("case", ["none", "loops", "chain", "star", "random"])
def test_components(spark, case):
    pick = random.Random(1)
    edges = {
        "none": [],
        "loops": [(1, 1), (2, 2)],
        "chain": [(k + 1, k) for k in range(200)],
        "star": [(7, k) for k in range(50)] * 2,
        "random": [(pick.randrange(150), pick.randrange(150)) for _ in range(100)],
    }[case]
    found = components(spark.createDataFrame(edges, "u int, v int")).collect()
    assert {r.node: r.root for r in found} == plain(edges) and len(found) == len(plain(edges))
