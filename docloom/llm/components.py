"""Connected components: inside one task with numpy, over tables by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


#: Parts that a node's edges are dealt into when they are joined.
PARTS = 8


def hooked(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` after joining the classes of each pair (a[k], b[k]); a class's label is its least position."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        low, high = np.minimum(x[apart], y[apart]), np.maximum(x[apart], y[apart])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the (a, b) edges; root is the component's least node.

    Each round makes every node point its larger neighbours (large star), then its smaller ones (small star), at the least of them;
    both keep connectivity, and rounds end when the edges are stars, which they are after about log2(nodes) squared rounds at the latest. Edges stay in
    tables: nothing is gathered on the driver. A node meets its least neighbour in ``PARTS`` parts, so one with a third of all edges is not one task.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _met(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _met(large, least).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = written(small.filter("a <> b").distinct(), "edges")
        if _mark(after) == _mark(now):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = after


def _met(edges: DataFrame, least: DataFrame) -> DataFrame:
    """The edges (a, b) with the m of their a."""
    part = F.pmod(F.xxhash64("b"), F.lit(PARTS)).cast("int")
    copies = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return edges.withColumn("part", part).join(copies, ["a", "part"]).select("a", "b", "m")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())
