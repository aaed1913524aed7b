import random
import zlib
from collections import Counter, defaultdict

from conftest_llm import ODD

from docloom.llm.sharding import Tree, balanced, best_fit_decreasing, shard, stepped


def brute(sizes, capacity):
    """Best fit decreasing by looking at every bin."""
    free, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(f, b) for b, f in enumerate(free) if f >= sizes[i]]
        if fits:
            b = min(fits)[1]
        else:
            b = len(free)
            free.append(capacity)
        free[b] -= sizes[i]
        out[i] = b
    return out


def counted(sizes):
    return sorted(Counter(sizes).items(), reverse=True)


def flat(places):
    return [b for bins in places for b, n in bins for _ in range(n)]


def test_best_fit_decreasing_is_the_plain_rule():
    rng = random.Random(1)
    for k in range(400):
        sizes = sorted((rng.randint(1, 60 if k % 2 else 9) for _ in range(rng.randint(0, 90))), reverse=True)
        assert flat(best_fit_decreasing(counted(sizes), 60)) == brute(sizes, 60)


def test_the_tree_is_a_sorted_set():
    rng, tree, plain = random.Random(2), Tree(), []
    for k in range(6000):
        if rng.random() < 0.55:
            key = (rng.randint(0, 300), k)
            tree.add(key)
            plain.append(key)
        else:
            key = (rng.randint(0, 300), -1)
            want = min((x for x in plain if x >= key), default=None)
            assert tree.take(key) == want
            if want:
                plain.remove(want)

    def depth(node):
        return 0 if node is None else 1 + max(depth(node[2]), depth(node[3]))

    for k in range(4000):
        tree.add((1000 + k, k))
    assert depth(tree.root) < 60


def test_too_large_or_too_many_is_refused():
    assert best_fit_decreasing([(70, 1), (5, 1)], 60) is None
    assert best_fit_decreasing([(60, 3)], 60, 2) is None


def test_balanced_is_near_equal_also_beside_a_huge_item():
    rng = random.Random(2)
    sizes = sorted([rng.randint(1, 50) for _ in range(5000)] + [100_000], reverse=True)
    load = [0] * 10
    for s, b in zip(sizes, flat(balanced(counted(sizes), 10)), strict=True):
        load[b] += s
    rest = sorted(load)[:-1]
    assert max(load) == 100_000 and max(rest) - min(rest) <= 50
    assert balanced([], 4) == [] and flat(balanced([(9, 2)], 4)) == [0, 1]


def test_weights_are_rounded_up_by_a_thousandth(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    sizes = [1, 16, 1023, 1024, 1025, 2047, 2048, 2049] + [rng.randint(1, 10**rng.randint(1, 13)) for _ in range(500)]
    for r in spark.createDataFrame([(x,) for x in sizes], "w long").select("w", stepped(F.col("w")).alias("c")).collect():
        assert r["w"] <= r["c"] <= r["w"] * (1 + 1 / 1024)
        assert r["w"] > 2048 or r["w"] == r["c"]


def test_rows_are_whole_and_slots_gapless(spark, make, words):
    rows = [(i, words(5 + i % 60, i % 700)) for i in range(1500)] + [(2000 + i, "the same text") for i in range(700)] + ODD
    got = shard(make(rows, extra=True), 7).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) == set(range(7))
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    load = [sum(r["size"] for r in rs) for rs in by.values()]
    assert max(load) < 1.35 * min(load)
    text = defaultdict(set)
    for r in got:
        text[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in text.values())
    want = sorted((i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == want


def test_empty_table(make):
    assert shard(make([]), 4).collect() == []
