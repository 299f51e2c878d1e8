from __future__ import annotations

import random

import pytest

from sunframe.llm.components import connected_components


def brute(edges):
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {x: top(x) for x in parent}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "empty", "loops"])
def test_components(spark, kind):
    r = random.Random(3)
    edges = {
        "chain": [(i, i + 1) for i in range(120)],
        "star": [(500, i) for i in range(300)] + [(300, 700)],
        "random": [(r.randrange(200), r.randrange(200)) for _ in range(130)] * 2,
        "empty": [],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[kind]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute(edges)


def test_text_nodes_and_nulls(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), (None, "a"), ("z", None)], "a string, b string")
    got = {x["node"]: x["root"] for x in connected_components(edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "a"}
