"""Row queries over a view of JSON documents: berths of harbours. Wanted results are computed from the same rows in plain Python."""

import datetime
import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docloom.operators.documents import blank
from docloom.plans import dsl, filters
from docloom.plans.views import View, ViewColumn, Views

SHIPS = ["Tern", "Gannet", "Puffin of Skye", "Petrel", "Kestrel", "Grey Heron", "Curlew", "Skua", "Redshank", "Turnstone", "Sanderling", "Osprey"]
QUAYS = ["north", "north", "west", "west", "west", "old", "west", "north", "west", "old", "west", "west"]


def berths():
    """Twelve berths; draught and lit are missing in some."""
    out = []
    for n, (ship, quay) in enumerate(zip(SHIPS, QUAYS, strict=True)):
        doc = {"berth": 70 + 3 * n, "quay": quay, "ship": ship, "arrived": f"2019-1{n % 3}-0{1 + n % 4}", "tons": n * n % 17 * 100}
        if n % 3:
            doc["draught"] = 2.5 + n / 4
        if n % 4 == 1:
            doc["lit"] = n % 8 == 1
        if n == 9:
            doc["crest"] = "c2VhYmlyZA=="
        out.append(doc)
    return out


VIEW = View(
    "Harbour",
    "Berths",
    (
        ViewColumn("berth", "long", nullable=False), ViewColumn("quay", "string", nullable=False), ViewColumn("ship", "string"), ViewColumn("arrived", "date"), ViewColumn("tons", "int"),
        ViewColumn("draught", "double"), ViewColumn("lit", "boolean"), ViewColumn("crest", "base64Binary"),
    ),
    collections=("berths",),
)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(f"/berth/{d['berth']}.json", json.dumps(d).encode(), "JSON", ["berths"]) for d in berths()]
    rows.append(("/other.json", b'{"berth": 1}', "JSON", ["else"]))
    return VIEW.rows(blank(spark.createDataFrame(rows, "URI string, content binary, format string, collections array<string>")), "").drop("__uri")


CONDITIONS = [
    (("eq", "quay", "old"), lambda d: d["quay"] == "old"),
    (("not", ("eq", "quay", "old")), lambda d: d["quay"] != "old"),
    (("gt", "tons", 800), lambda d: d["tons"] > 800),
    (("ge", "tons", 800), lambda d: d["tons"] >= 800),
    (("lt", "draught", 4.0), lambda d: "draught" in d and d["draught"] < 4),
    (("le", "berth", 79), lambda d: d["berth"] <= 79),
    (("and", [("eq", "quay", "west"), ("gt", "tons", 300)]), lambda d: d["quay"] == "west" and d["tons"] > 300),
    (("or", [("eq", "quay", "old"), ("lt", "berth", 75)]), lambda d: d["quay"] == "old" or d["berth"] < 75),
    (("not", ("in", "quay", ["west", "north"])), lambda d: d["quay"] == "old"),
    (("in", "berth", [73, 100, 4]), lambda d: d["berth"] in (73, 100)),
    (("is_null", "lit"), lambda d: "lit" not in d),
    (("is_not_null", "draught"), lambda d: "draught" in d),
    (("null_safe_eq", "lit", False), lambda d: d.get("lit") is False),
    (("null_safe_eq", "lit", None), lambda d: "lit" not in d),
    (("contains", "ship", "an"), lambda d: "an" in d["ship"]),
    (("starts_with", "ship", "Grey"), lambda d: d["ship"].startswith("Grey")),
    (("ends_with", "ship", "el"), lambda d: d["ship"].endswith("el")),
    (("contains", "ship", "_"), lambda d: False),
    (("eq", "arrived", datetime.date(2019, 10, 1)), lambda d: d["arrived"] == "2019-10-01"),
]


@pytest.mark.parametrize(("condition", "plain"), CONDITIONS)
def test_filters(table, condition, plain):
    got = sorted(r["berth"] for r in table.filter(filters.column(condition)).collect())
    assert got == [d["berth"] for d in berths() if plain(d)]


def frame(spark, table, text):
    v = Views(spark)
    v.register("Harbour", "Berths", table)
    return dsl.Builder(v).frame(text)


def test_aggregates(spark, table):
    df = frame(spark, table, "op.fromView('Harbour','Berths').groupBy('quay', [op.sum('all','tons'), op.avg('mean','tons'), op.count('n'), op.min('least','tons'), op.max('most','tons')]).orderBy('quay')")
    by = defaultdict(list)
    for d in berths():
        by[d["quay"]].append(d["tons"])
    assert [tuple(r) for r in df.collect()] == [(q, sum(t), sum(t) / len(t), len(t), min(t), max(t)) for q, t in sorted(by.items())]


def test_pivot(table):
    got = {r["berth"]: r.asDict() for r in table.groupBy("berth").pivot("quay").agg(F.max("tons")).collect()}
    for d in berths():
        assert {k: v for k, v in got[d["berth"]].items() if v is not None} == {"berth": d["berth"], d["quay"]: d["tons"]}


def test_top_n(spark, table):
    df = frame(spark, table, "op.fromView('Harbour','Berths','').orderBy([op.desc('quay'), 'berth']).limit(4).select(['berth'])")
    assert [r[0] for r in df.collect()] == [d["berth"] for d in sorted(berths(), key=lambda d: ([-ord(c) for c in d["quay"]], d["berth"]))][:4]


def test_schema(table):
    kinds = {"berth": "bigint", "quay": "string", "ship": "string", "arrived": "date", "tons": "int", "draught": "double", "lit": "boolean", "crest": "binary"}
    assert VIEW.struct().simpleString() == "struct<" + ",".join(f"Harbour.Berths.{n}:{k}" for n, k in kinds.items()) + ">"
    assert [bytes(r[0]) for r in table.select("crest").filter("crest is not null").collect()] == [b"seabird"]


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 k", "cast(id as string) t").write.parquet(str(tmp_path / "x"))
    df = frame(spark, spark.read.parquet(str(tmp_path / "x")), "op.fromView('Harbour','Berths','').where(op.gt(op.col('k'), 3)).groupBy('k', op.count('n'))")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,3)" in plan and "ReadSchema: struct<k:bigint>" in plan and "partial_count" in plan
    top = frame(spark, spark.read.parquet(str(tmp_path / "x")), "op.fromView('Harbour','Berths','').orderBy(op.desc('id')).limit(5)")
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
