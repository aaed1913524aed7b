import random

import numpy as np

from docloom.llm.components import connected, hooked


def roots(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_inside_a_task():
    rng = random.Random(1)
    for _ in range(50):
        n = rng.randint(1, 60)
        e = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 50))]
        got = hooked(np.arange(n), np.array([a for a, _ in e], int), np.array([b for _, b in e], int))
        assert got.tolist() == [roots(e, range(n))[k] for k in range(n)]


def test_over_tables(spark):
    rng = random.Random(2)
    e = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)] + [(-5, -5), (-7, 3000)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(e, "a long, b long")).collect()}
    linked = {x for a, b in e if a != b for x in (a, b)}
    want = {n: r for n, r in roots(e, {x for p in e for x in p}).items() if n in linked}
    assert got == want


def test_no_edges(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []
