import random
from collections import Counter

import pytest

from docloom.llm import ranking

COLUMNS = "vendor long, part string, first int, second long, sale long, line int"


def brute(rows, k):
    """The rows that stay, as (vendor, part, first, second, sale, line, pos, tied)."""
    last = (1, 0)

    def up(v):
        return last if v is None else (0, v)

    groups, out = {}, []
    for r in rows:
        groups.setdefault(r[:2], []).append(r)
    for own in groups.values():
        own.sort(key=lambda r: (last if r[2] is None else (0, -r[2]), up(r[3]), up(r[4]), up(r[5])))
        tied = Counter(r[2:4] for r in own)
        out += [(*r, n, tied[r[2:4]]) for n, r in enumerate(own[:k], 1)]
    return sorted(map(repr, out))


def ranked(df, k=2):
    out = ranking.top_places(df, ["vendor", "part"], "first", "second", ["sale", "line"], k)
    assert out.columns == ["vendor", "part", "first", "second", "sale", "line", "pos", "tied"]
    return sorted(repr(tuple(r)) for r in out.collect())


def lines(n, seed=1):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.08 else v
    out = []
    for _ in range(n):
        hot = rng.random() < 0.4  # one group with most of the rows
        out.append((7 if hot else maybe(rng.randrange(40)), "x" if hot else maybe(rng.choice("abc")), maybe(rng.randrange(4)), maybe(rng.randrange(3)), maybe(rng.randrange(50)), maybe(rng.randrange(3))))
    return out + out[: n // 5]  # repeated rows


@pytest.mark.parametrize("k", [1, 2, 5])
def test_against_brute_force(spark, k):
    rows = lines(1500)
    assert ranked(spark.createDataFrame(rows, COLUMNS).repartition(5), k) == brute(rows, k)


def test_one_group_of_equal_lines(spark):
    rows = [(1, "a", 3, 2, 9, 1)] * 400 + [(1, "a", 3, 1, 9, 1)]
    assert ranked(spark.createDataFrame(rows, COLUMNS)) == brute(rows, 2)


def test_wide_pairs_need_more_than_a_long(spark):
    rng = random.Random(3)
    rows = [(v, None, rng.randrange(-(2**31), 2**31), rng.randrange(-(2**62), 2**62), s, 0) for v in range(12) for s in range(9)]
    assert ranked(spark.createDataFrame(rows, COLUMNS)) == brute(rows, 2)


def test_null_pairs_and_null_ties_come_last(spark):
    rows = [(1, "a", None, None, 5, 1), (1, "a", None, None, None, 1), (1, "a", None, 4, 8, 1), (2, None, 3, None, None, None)]
    assert ranked(spark.createDataFrame(rows, COLUMNS)) == brute(rows, 2)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert ranked(empty) == []
    rows = lines(60)
    wide = spark.createDataFrame(rows, COLUMNS)
    for name in ("g0", "g1", "t0", "tag", "nulls", "a", "b", "code", "n", "low", "high", "mid", "grp", "pos", "tied", "salts", "nth", "cell", "all_n", "cut"):
        wide = wide.withColumn(name, ranking.F.lit("clash"))
    assert ranked(wide) == brute(rows, 2)


def test_group_names_that_are_its_own(spark):
    """Columns to rank by may bear the operator's inner names."""
    rows = lines(80)
    df = spark.createDataFrame(rows, "tag long, grp string, b int, a long, g0 long, code int")
    out = ranking.top_places(df, ["tag", "grp"], "b", "a", ["g0", "code"], 2)
    assert sorted(repr(tuple(r)) for r in out.collect()) == brute(rows, 2)


def test_no_group_is_one_task(spark):
    """The plan that reads the dealt lines joins them where they are; nothing sorts or windows a group before the range sort."""
    out = ranking.top_places(spark.createDataFrame(lines(200), COLUMNS), ["vendor", "part"], "first", "second", ["sale", "line"])
    plan = out._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan and "WindowGroupLimit" in plan
