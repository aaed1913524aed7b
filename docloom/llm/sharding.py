"""Sharding by best-fit-decreasing bin packing over indivisible groups of equal texts."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spread, written

#: Sizes from one exact unit up to this many are packed as they are; above it, classes of sizes are at most this share apart.
PRECISE = 1024
#: Rows that one task numbers at most, on average.
ROWS_A_TASK = 20_000


class Tree:
    """A balanced search tree of (remaining capacity, bin): a treap, whose nodes hold their subtree's least key's order by random priority.

    ``take`` removes the least key that is not below the one asked for and ``add`` puts one in, both in O(log bins) expected steps.
    """

    def __init__(self):
        self.root, self.rng = None, random.Random(1)

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, self.rng.random(), None, None]), high)

    def take(self, key: tuple[int, int]) -> tuple[int, int] | None:
        low, high = self._split(self.root, key)
        if high is None:
            self.root = low
            return None
        path, node = None, high
        while node[2] is not None:
            path, node = node, node[2]
        if path is None:
            high = node[3]
        else:
            path[2] = node[3]
        self.root = self._merge(low, high)
        return node[0]

    @staticmethod
    def _split(node, key):
        """The nodes below the key, and the others."""
        low = high = None
        ends = [None, None]
        while node is not None:
            side = 0 if node[0] < key else 1
            if ends[side] is None:
                if side == 0:
                    low = node
                else:
                    high = node
            else:
                ends[side][3 - side] = node
            ends[side] = node
            node = node[3 - side]
        for side, end in enumerate(ends):
            if end is not None:
                end[3 - side] = None
        return low, high

    @staticmethod
    def _merge(low, high):
        """One tree of two, all keys of the first being below those of the second."""
        head = end = [None, 0, None, None]
        side = 3
        while low is not None and high is not None:
            if low[1] > high[1]:
                end[side] = low
                end, side, low = low, 3, low[3]
            else:
                end[side] = high
                end, side, high = high, 2, high[2]
        end[side] = low if low is not None else high
        return head[3]


class _Bins:
    """Bins by remaining capacity in a balanced tree, and the next new bin."""

    def __init__(self, capacity: int):
        self.capacity, self.tree, self.used = capacity, Tree(), 0

    def put(self, size: int, many: int) -> list[tuple[int, int]]:
        """(bin, how many) of ``many`` items of one size, each into the tightest bin that holds it.

        The bin stays the tightest until the next item doesn't fit, so it takes as many as it holds at once.
        """
        out = []
        while many:
            found = self.tree.take((size, -1))
            if found is None:
                found, self.used = (self.capacity, self.used), self.used + 1
            left, bin_ = found
            n = min(many, left // size)
            self.tree.add((left - n * size, bin_))
            out.append((bin_, n))
            many -= n
        return out


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[list[tuple[int, int]]] | None:
    """For each (size, how many), falling by size, the (bin, how many) its items go to in order; None if over ``most`` bins or an item too large.

    An item goes into the bin with the least remaining capacity that still holds it, or else a new bin. Items of one size are interchangeable, so they are
    placed a bin at a time: the time follows from the different sizes and the bins, however many items there are.
    """
    bins, out = _Bins(capacity), []
    for size, many in sizes:
        if size > capacity:
            return None
        out.append(bins.put(size, many))
        if most is not None and bins.used > most:
            return None
    return out


def balanced(sizes: list[tuple[int, int]], shards: int) -> list[list[tuple[int, int]]]:
    """As ``best_fit_decreasing``, for (size, how many) falling by size, with bins 0..shards-1 of near equal size: the least capacity that needs no more.

    An item over the mean of what is left gets a bin alone; the rest is balanced over the other bins.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in sizes]
    left, alone = sum(s * n for s, n in sizes), 0
    rest = [list(x) for x in sizes]
    for k, (size, many) in enumerate(sizes):
        while rest[k][1] and alone < shards - 1 and size * (shards - alone) > left:
            out[k].append((alone, 1))
            rest[k][1] -= 1
            left -= size
            alone += 1
        if rest[k][1]:
            break
    own, bins = [(s, n) for s, n in rest if n], shards - alone
    if not own:
        return out
    low = max(own[0][0], -(-left // bins))
    high, best = low, best_fit_decreasing(own, low, bins)
    while best is None:
        low, high = high + 1, high + max(1, high // 64)
        best = best_fit_decreasing(own, high, bins)
    while low < high:
        mid = (low + high) // 2
        if (found := best_fit_decreasing(own, mid, bins)) is not None:
            best, high = found, mid
        else:
            low = mid + 1
    at = 0
    for k, (_, n) in enumerate(rest):
        if n:
            out[k] += [(alone + bin_, m) for bin_, m in best[at]]
            at += 1
    return out


def stepped(weight: Column) -> Column:
    """The weight, from ``PRECISE`` on rounded up to a multiple of the largest power of two that leaves it ``PRECISE`` steps or more."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(weight / PRECISE)), F.lit(0)))
    return (F.ceil(weight / step) * step).cast("long")


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Each row's shard and its place there, as (doc_id, size, text_crc32, shard, slot).

    Size: UTF-8 bytes of the text plus ``overhead``; a null text has no bytes, checksum 0 and goes with the empty texts.
    Equal texts make a group that is never split. Every group is packed by best fit decreasing, its weight rounded up by a thousandth at most, into the least
    capacity that needs no more than ``shards`` bins; groups of one rounded weight are interchangeable, so the driver packs (weight, how many), about a thousand
    for each doubling of the weight however many groups there are, and the groups are dealt out by their rank among those of their weight. A group over the mean has a
    shard alone. Slots run from 0 without gaps by (id, checksum), repeated rows and null ids included. Other columns are not read. An empty table gives no rows.
    """
    text: Column = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = written(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("grp"),
        ),
        "shard-rows",
    )
    groups = written(rows.groupBy("grp").agg(F.sum("size").alias("weight"), F.count("*").alias("n")).withColumn("class", stepped(F.col("weight"))), "shard-groups")
    count = rows.count()
    classes = groups.groupBy("class").agg(F.count("*").alias("many")).orderBy(F.desc("class")).collect()
    places = balanced([(r["class"], r["many"]) for r in classes], shards)
    dealt = [(r["class"], first, bin_) for r, bins in zip(classes, places, strict=True) for first, bin_ in _firsts(bins)]
    spark = docs.sparkSession
    # of each class, the ranks from which on groups go to a bin: at most one row a class and bin
    runs = spark.createDataFrame(dealt, "class long, first long, shard int").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("runs"))
    ranked = _ranked(groups, "class", "grp", groups.count()).join(F.broadcast(runs), "class")
    own = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("nth")), -1)["shard"]
    placed = spread(rows, written(ranked.select("grp", "n", own.alias("shard")), "shard-places"), "grp")
    return numbered(placed.select("doc_id", "size", "text_crc32", "shard"), count, shards)


def _firsts(bins: list[tuple[int, int]]):
    first = 0
    for bin_, n in bins:
        yield first, bin_
        first += n


def _ranked(rows: DataFrame, key: str, by: str, count: int) -> DataFrame:
    """Adds ``nth``: 0.. among the rows of a key by a hash, whose parts are numbered apart and shifted by the rows of the parts before."""
    parts = max(1, -(-count // ROWS_A_TASK))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = rows.groupBy(key, "part").agg(F.count("*").alias("k")).select(key, "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy(key, "part").orderBy(by)
    return rows.withColumn("nth", F.row_number().over(inside)).join(shift, [key, "part"]).withColumn("nth", F.col("shift") + F.col("nth") - 1).drop("shift", "part")


def numbered(placed: DataFrame, count: int, shards: int) -> DataFrame:
    """Adds ``slot``: 0.. within each shard, without one task for a whole shard.

    Rows of a shard are dealt into parts by id; parts are numbered apart and shifted by the rows of the parts before.
    """
    parts = max(1, -(-count // (shards * ROWS_A_TASK)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("nth", F.row_number().over(inside))
        .join(shift, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("shift") + F.col("nth") - 1).cast("long").alias("slot"))
    )


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = shard(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
