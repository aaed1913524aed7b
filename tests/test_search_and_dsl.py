import pytest

from docloom.options import Options
from docloom.plans import dsl, search
from docloom.plans.search import Both, Constraints, Either, In, Not, Word
from docloom.plans.views import TYPE_OF, View, ViewColumn, Views, data_type
from docloom.schemas import DOCUMENT

DOCS = [
    ("/a/1.json", b'{"ShipName": "Fernway", "HomePort": "Dalby", "n": 1, "day": "2020-01-02", "raw": "aGk="}', ["fleet", "x"]),
    ("/a/2.json", b'{"ShipName": "Ostrid", "HomePort": "Fernhill", "n": "bad"}', ["fleet"]),
    ("/b/3.xml", b"<doc><ShipName>Fern</ShipName><note>apache license</note></doc>", ["other"]),
    ("/b/4.txt", b"plain text about fern and license apache", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(u, c, None, cs, None, None, None, None) for u, c, cs in DOCS], DOCUMENT)


def found(docs, query, filtered=True):
    return sorted(r["URI"] for r in search.matching(docs, query, filtered).collect())


def test_string_queries():
    q = search.string_query
    assert q("a b OR c") == Either((Both((Word("a"), Word("b"))), Word("c")))
    assert q('"a b" -c') == Both((Word("a b"), Not(Word("c")))) and q("(a OR b) c") == Both((Either((Word("a"), Word("b"))), Word("c")))
    assert q("in:x y", Constraints({"in": ("collection", "")})) == Both((In("collection", ("x",)), Word("y")))
    with pytest.raises(search.SearchError):
        q("(a")


def test_words_phrases_and_wildcards(docs):
    assert found(docs, search.string_query("fern")) == ["/b/3.xml", "/b/4.txt"]
    assert found(docs, search.string_query("fern*")) == ["/a/1.json", "/a/2.json", "/b/3.xml", "/b/4.txt"]
    assert found(docs, search.string_query('"apache license"')) == ["/b/3.xml"]
    assert found(docs, search.string_query("shipname")) == []


def test_a_filtered_property_query_has_no_false_hits(docs):
    q = search.structured_query('{"ctsquery":{"jsonPropertyWordQuery":{"property":["ShipName"],"propertyName":"ShipName","text":["Fern*"]}}}'.replace('"property":["ShipName"],', ""))
    assert found(docs, q) == ["/a/1.json", "/b/3.xml"]
    assert found(docs, q, filtered=False) == ["/a/1.json", "/a/2.json", "/b/3.xml", "/b/4.txt"]


def test_options(docs):
    q = lambda **o: search.of_options(Options.of({f"read.documents.{k}": v for k, v in o.items()}))
    assert found(docs, q(collections="x,other")) == ["/a/1.json", "/b/3.xml"]
    assert found(docs, q(directory="/a")) == ["/a/1.json", "/a/2.json"]
    assert found(docs, q(uris="/a/1.json\n/b/4.txt", collections="other")) == ["/a/1.json", "/b/4.txt"]
    assert found(docs, q(uris="/a/1.json\n/b/4.txt", stringQuery="license")) == ["/b/4.txt"]


def test_other_queries_are_refused():
    with pytest.raises(search.SearchError):
        search.structured_query('{"ctsquery":{"geoQuery":{"text":["x"]}}}')


def test_view_rows_keep_invalid_values_as_null(docs):
    v = View("m", "people", (ViewColumn("ShipName"), ViewColumn("n", "int"), ViewColumn("day", "date"), ViewColumn("raw", "base64Binary"), ViewColumn("gone", "int", hidden=True)), collections=("fleet",))
    rows = {r["people.ShipName"]: r for r in v.rows(docs, "people").collect()}
    assert rows["Fernway"]["people.n"] == 1 and str(rows["Fernway"]["people.day"]) == "2020-01-02" and bytes(rows["Fernway"]["people.raw"]) == b"hi"
    assert rows["Ostrid"]["people.n"] is None and len(rows) == 2
    assert [f.name for f in v.struct()] == ["m.people.ShipName", "m.people.n", "m.people.day", "m.people.raw"]


def test_types():
    assert data_type("unsignedLong").simpleString() == "bigint" and data_type("decimal").simpleString() == "double" and data_type("gYear").simpleString() == "string"
    assert data_type("no such type").simpleString() == "string" and len(TYPE_OF) > 30


@pytest.fixture(scope="module")
def run(spark, docs):
    v = Views(spark)
    v.register("m", "a", spark.createDataFrame([(i, i % 5, None if i % 4 == 0 else f"n{i}") for i in range(1, 16)], "id int, cit int, name string"))
    return lambda text, **params: dsl.Builder(v, docs, params).frame(text).collect()


@pytest.mark.parametrize(
    ("condition", "n"),
    [
        ("op.eq(op.col('cit'), 1)", 3), ("op.gt(op.col('cit'), 3)", 3), ("op.or(op.eq(op.col('cit'),1), op.eq(op.col('cit'),2))", 6),
        ("op.and([op.lt(op.col('cit'),4), op.not(op.isDefined(op.col('name')))])", 2), ("op.in(op.col('cit'), [3,4])", 6), ('op.sqlCondition("name like \'n1%\'")', 6),
    ],
)
def test_conditions(run, condition, n):
    assert len(run(f"op.fromView('m','a','').where({condition})")) == n


def test_chains(run):
    assert [tuple(r) for r in run("op.fromView('m','a').groupBy('cit', [op.count('count'), op.sum('s','id')]).orderBy(op.desc('m.a.cit')).limit(2)")] == [(4, 3, 27), (3, 3, 24)]
    assert [r[0] for r in run("op.fromView('m','a','').orderBy('id').offset(3).limit(2).select(['id'])")] == [4, 5]
    assert run("op.fromView('m','a','').where(op.eq(op.col('id'), op.param('x'))).select('name')", x=3)[0][0] == "n3"
    assert len(run("op.fromSearchDocs(cts.wordQuery('license'))")) == 2
    assert {r["c"] for r in run("op.fromLexicons({c: cts.collectionReference()})")} == {"fleet", "x", "other", None}


@pytest.mark.parametrize("text", ["op.nothing()", "op.fromView('m','a').where(", "op.fromView('m','a','').select(['zz'])", "op.fromView('m','a','').orderBy('id').fly()"])
def test_bad_queries(run, text):
    with pytest.raises(ValueError):
        run(text)
