import math
import random

import numpy as np
import pytest

from docloom.llm import topk as t

SCHEMA = "vec_id long, embedding array<float>, label int, score int, rank int"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, queries, k):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    scaled = lambda v: [math.floor(256 * float(np.float32(x))) for x in v]
    every = [(i, tuple(scaled(v))) for i, v in rows if i is not None and ok(v)]
    out = []
    for i, q in {(i, tuple(scaled(v))) for i, v in queries if i is not None and ok(v)}:
        found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in every if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def data(n, dim, seed, ties=False):
    rng = random.Random(seed)
    return [(i, [rng.choice([-1.0, 0.0, 1.0]) if ties else rng.gauss(0, 0.2) for _ in range(dim)]) for i in range(n)]


def check(vectors, rows, k=5, every=10):
    df = vectors(rows)
    got = sorted(map(tuple, t.top_k(df, df.filter(f"vec_id % {every} = 0"), k).collect()))
    assert got == brute(rows, [(i, v) for i, v in rows if i is not None and i % every == 0], k)


def test_results_are_those_of_all_pairs(vectors, monkeypatch):
    monkeypatch.setattr(t, "SHARD_ROWS", 150)
    monkeypatch.setattr(t, "BLOCK_QUERIES", 20)
    monkeypatch.setattr(t, "LEAF_ROWS", 8)
    check(vectors, data(900, 16, 1))
    check(vectors, data(600, 4, 2, ties=True))


def test_one_vector_on_a_third_of_all_rows(vectors, monkeypatch):
    monkeypatch.setattr(t, "SHARD_ROWS", 100)
    monkeypatch.setattr(t, "BLOCK_QUERIES", 20)
    rows = data(400, 6, 8)
    check(vectors, rows + [(1000 + k, [0.5] * 6) for k in range(200)], every=20)
    check(vectors, rows + [(7, rows[7][1])] * 150, every=20)  # one row many times: every one is a candidate


def test_odd_rows(vectors, monkeypatch):
    rows = data(60, 3, 3) + [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 1.0]), (103, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (110, [1.0, 2.0]), (120, [5.0, 1.0]), (130, []), (140, [])]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (10, rows[10][1])]
    check(vectors, rows)


def test_fewer_rows_than_asked_for(vectors):
    check(vectors, data(3, 4, 4), k=5, every=1)


def test_large_components_stay_exact(vectors):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-(10**6), 10**6)) for _ in range(4)]) for i in range(60)]
    check(vectors, rows)


def test_pruning_skips_leaves(monkeypatch):
    monkeypatch.setattr(t, "LEAF_ROWS", 64)
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 300, (40, 8))
    x = np.floor(np.concatenate([c + rng.normal(0, 3, (100, 8)) for c in centers]))
    q = np.floor(centers[:5])
    calls = []
    plain = t._dots
    t._dots = lambda a, b, bound: calls.append(len(a) * len(b)) or plain(a, b, bound)
    tree = t.BallTree.built(np.arange(len(x)), x)
    tree = t.BallTree.unpacked(tree.packed(), 8)
    try:
        found = t.best(tree, np.full(5, -1), q, np.full(5, np.iinfo(np.int64).min), 3)
    finally:
        t._dots = plain
    assert sum(calls) < 0.3 * len(x) * len(q)
    for i in range(5):
        order = sorted(range(len(x)), key=lambda j: (-float(x[j] @ q[i]), j))[:3]
        assert [j for k, j, _ in found if k == i] == order


def test_empty_table(vectors):
    df = vectors([])
    assert t.top_k(df, df).collect() == []
