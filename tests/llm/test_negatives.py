import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors, positives=5, k=10):
    def vector(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * float(np.float32(x))) for x in v]

    valid = [(i, vector(v), c) for i, v, c in rows if i is not None and c is not None and vector(v) is not None]
    out = []
    for i, v, c in {(i, tuple(v), c) for i, v, c in valid if i in anchors}:
        score = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, d) for j, w, d in valid if j != i and len(w) == len(v))
        for s, j, _ in [x for x in score if x[2] == c][:positives]:
            hard = [(t, n) for t, n, d in score if d != c and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, j, rank, n, -s, -t) for rank, (t, n) in enumerate(hard[:k], 1)]
    return sorted(map(repr, out))


def mined(df, anchors, **how):
    out = negatives.hard_negatives(df, df.filter(F.col("vec_id").isin(*anchors)), **how)
    return sorted(repr(tuple(r)) for r in out.collect())


def vectors(n, clusters=6, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    center = rng.normal(size=(clusters, dim))
    return [(int(i), [float(x) for x in (center[i % clusters] + 0.3 * rng.normal(size=dim)).astype(np.float32)], int(rng.integers(4))) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    """Many lists in several parts, one of which is met first."""
    for name, value in (("LIST_ROWS", 20), ("PART_ROWS", 8), ("FIRST", 1), ("BLOCK_QUERIES", 3)):
        monkeypatch.setattr(negatives, name, value)


def test_against_brute_force(spark, small):
    rows = vectors(400)
    anchors = [i for i in range(400) if i % 20 == 0]
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    assert mined(df, anchors) == brute(rows, anchors)
    assert mined(df, anchors, positives=2, k=3) == brute(rows, anchors, 2, 3)


def test_ties_repeats_nulls_and_lengths(spark, small):
    v = [0.5, -0.25, 1.0]
    rows = [(i, v, i % 2) for i in range(40)] + [(3, v, 1)] * 2 + [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [1.0, float("nan"), 0.0], 1), (103, [float("inf"), 0.0, 0.0], 0), (104, v, None), (None, v, 1)]
    rows += [(200 + i, [0.5, 0.5], i % 3) for i in range(6)] + [(300, [], 1), (301, [], 0), (302, [], 1)] + [(400 + i, [-x for x in v], i % 2) for i in range(4)]
    rows += [(500 + i, [0.3 + i / 100, -0.2, 0.6], i % 2) for i in range(30)]
    anchors = [0, 3, 100, 104, 200, 300, 400, 500, 511]
    df = spark.createDataFrame(rows, COLUMNS)
    assert mined(df, anchors) == brute(rows, anchors)


def test_empty_and_clashing_columns(spark):
    assert mined(spark.createDataFrame([], COLUMNS), [1]) == []
    rows = vectors(60)
    df = spark.createDataFrame(rows, COLUMNS)
    for name in ("id", "v", "dim", "key", "windows", "list", "part", "parts", "salt", "rank", "score", "nth", "block", "floors"):
        df = df.withColumn(name, F.lit("clash"))
    assert mined(df, [0, 20, 40]) == brute(rows, [0, 20, 40])


def test_bounds_hold():
    rng = np.random.default_rng(5)
    for _ in range(30):
        x, q = np.floor(256 * rng.normal(size=(50, 6))), np.floor(256 * rng.normal(size=(4, 6)))
        center = x.mean(axis=0)
        radius = np.sqrt(((x - center) ** 2).sum(axis=1)).max()
        least, most = negatives.bounds(q, center[None, :], np.array([radius]))
        scores = q @ x.T
        assert (scores.min(axis=1) >= least[:, 0]).all() and (scores.max(axis=1) <= most[:, 0]).all()


def test_lists_out_of_reach_are_not_met(spark, monkeypatch):
    """With clusters far apart, an anchor meets few of the lists."""
    monkeypatch.setattr(negatives, "LIST_ROWS", 25)
    monkeypatch.setattr(negatives, "FIRST", 2)
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in (10 * np.eye(12)[i % 12] + 0.1 * rng.normal(size=12)).astype(np.float32)], i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, COLUMNS)
    shape = df.selectExpr("vec_id AS id", "CAST(label AS long) AS label", "embedding AS v", "size(embedding) AS dim")
    lists = negatives.Lists(shape)
    met = []
    real = negatives.written
    monkeypatch.setattr(negatives, "written", lambda d, name: (met.append((name, real(d, name))), met[-1][1])[1])
    one = F.array(F.struct(F.lit(1).alias("nth"), F.lit(0).cast("long").alias("low"), F.lit(2**62).cast("long").alias("high"), F.lit(None).cast("long").alias("floor")))
    lists.search(shape.filter("id < 12").withColumn("key", F.xxhash64("v")).withColumn("windows", one), 3, True)
    pairs = sum(d.count() for name, d in met if name == "lists-met")
    assert pairs < 12 * lists.sizes.count() / 2
