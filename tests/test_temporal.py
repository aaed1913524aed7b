import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import temporal

COLUMNS = "k long, a int, b int, at int, n long, gone boolean, note string"


def writes(n, seed, first=0):
    rng = random.Random(seed)
    out = []
    for i in range(first, first + n):
        a, b = rng.choice([None, *range(30)]), rng.choice([None, None, *range(1, 32)])
        out.append((rng.choice([1, 1, 1, 2, 3]), a, b, i // 2, i, rng.random() < 0.15, f"w{i}"))
    return out


def brute(rows, k, valid, system):
    """The last write whose range holds the valid time."""
    found = [r for r in rows if r[0] == k and r[3] <= system and (r[1] is None or r[1] <= valid) and (r[2] is None or valid < r[2])]
    last = max(found, key=lambda r: (r[3], r[4]), default=None)
    return None if last is None or last[5] else last[6]


def check(rows, history):
    got = history.collect()
    for k in (1, 2, 3):
        mine = [r for r in got if r["k"] == k]
        for valid in range(-1, 34):
            for system in range(-1, max(r[3] for r in rows) + 2):
                here = [r["note"] for r in mine if (r["valid_from"] is None or r["valid_from"] <= valid) and (r["valid_to"] is None or valid < r["valid_to"]) and r["system_from"] <= system and (r["system_to"] is None or system < r["system_to"])]
                want = brute(rows, k, valid, system)
                assert here == ([] if want is None else [want]), (k, valid, system)


def apply(history, df):
    return temporal.applied(history, df, "k", "a", "b", "at", "gone", ("n",))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tiles_against_brute_force(spark, seed):
    rows = writes(60, seed)
    check(rows, apply(None, spark.createDataFrame(rows, COLUMNS).repartition(5)))


def test_writes_that_come_later_change_the_history(spark):
    rows = writes(70, 7)
    history = None
    for a, b in ((0, 30), (30, 31), (31, 70)):
        history = apply(history, spark.createDataFrame(rows[a:b], COLUMNS))
    check(rows, history)


def test_keys_without_writes_pass(spark):
    first = spark.createDataFrame([(1, 0, 9, 1, 1, False, "one"), (2, 0, None, 1, 2, False, "two")], COLUMNS)
    history = apply(apply(None, first), spark.createDataFrame([(2, 5, 7, 3, 3, False, "mid")], COLUMNS))
    got = {(r["note"], r["valid_from"], r["valid_to"], r["system_from"], r["system_to"]) for r in history.collect()}
    assert got == {("one", 0, 9, 1, None), ("two", 0, 5, 1, None), ("two", 7, None, 1, None), ("two", 5, 7, 1, 3), ("mid", 5, 7, 3, None)}
    assert {r["note"] for r in temporal.as_of(history, F.lit(6), F.lit(2)).collect()} == {"one", "two"}
    assert {r["note"] for r in temporal.as_of(history, F.lit(6)).collect()} == {"one", "mid"}


def test_odd_rows(spark):
    rows = [(None, 1, 2, 1, 1, False, "no key"), (1, 1, 2, None, 2, False, "no time"), (1, 5, 5, 1, 3, False, "empty"), (1, 7, 3, 2, 4, False, "backwards"), (1, 1, 4, 3, 5, None, "kept"), (1, 1, 4, 3, 5, None, "kept")]
    history = apply(None, spark.createDataFrame(rows, COLUMNS))
    assert [(r["note"], r["valid_from"], r["valid_to"], r["system_to"]) for r in history.collect()] == [("kept", 1, 4, None)]
    assert apply(None, spark.createDataFrame([], COLUMNS)).count() == 0


def test_rows_and_names_are_those_of_the_writes(spark):
    df = spark.createDataFrame([(1, 0, 9, 1, 1, False, "one")], COLUMNS)
    assert apply(None, df).columns == [*df.columns, *temporal.ENDS]
