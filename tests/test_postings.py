import pytest
from pyspark.sql import functions as F

from docloom.operators import documents, postings, store
from docloom.plans import search

TEXTS = {
    "/a/1.txt": "The quick brown fox. Apache License applies",
    "/a/2.txt": "quick the apache, license; LICENSED under",
    "/a/3.json": '{"title":"Brown fox","body":{"note":"apache license 2","n":42},"tags":[{"t":"red"},{"t":"green fox"}]}',
    "/b/4.xml": "<r xmlns:p='urn:p'><p:title lang='en'>Quick licences</p:title><note>apache <b>license</b></note><title>fox two</title></r>",
    "/b/5.txt": "",
    "/b/6.json": '{"title":"under licensed","a\\"b":"fox","empty":""}',
    "/b/7.txt": None,
    "/b/8.txt": "Ünïcode wörter 42 fox-trot fox_hunt",
}
QUERIES = [
    {"stringQuery": "fox"}, {"stringQuery": '"apache license"'}, {"stringQuery": "licen*"}, {"stringQuery": "quick -license"}, {"stringQuery": "fox OR under"}, {"stringQuery": '-"apache license"'},
    {"stringQuery": '"quick bro*"'}, {"stringQuery": "missing"}, {"stringQuery": "42 fox"}, {"stringQuery": "wörter"}, {"stringQuery": '"fox trot"'}, {"stringQuery": "title"}, {"stringQuery": "--"},
    {"stringQuery": "fox", "collections": "odd"}, {"stringQuery": "fox", "directory": "/b/"}, {"stringQuery": "fox", "uris": "/a/1.txt\n/b/6.json\n/b/5.txt"},
    {"query": '{"query":{"queries":[{"or-query":{"queries":[{"term-query":{"text":["quick"]}},{"collection-query":{"uri":["odd"]}}]}}]}}'},
    {"query": '{"ctsquery":{"jsonPropertyWordQuery":{"property":"title","propertyName":"title","text":["fox"]}}}'},
    {"query": '{"ctsquery":{"jsonPropertyWordQuery":{"propertyName":"t","text":["green"]}}}'},
    {"query": '{"ctsquery":{"jsonPropertyWordQuery":{"propertyName":"note","text":["apache license"]}}}'},
    {"query": '{"ctsquery":{"notQuery":{"query":{"jsonPropertyWordQuery":{"propertyName":"title","text":["fox"]}}}}}'},
    {"query": '{"ctsquery":{"jsonPropertyWordQuery":{"propertyName":"n","text":["42"]}}}'},
]


def rows(spark, texts, odd=True):
    made = [(u, None if t is None else t.encode(), u.rpartition(".")[2].upper().replace("TXT", "TEXT"), ["odd"] if int(u.split("/")[2][0]) % 2 and odd else []) for u, t in texts.items()]
    return documents.blank(spark.createDataFrame(made, "URI string, content binary, format string, collections array<string>"))


def opened(spark, path, index):
    s = store.Store(spark, str(path), buckets=3, index=index)
    s.write(rows(spark, TEXTS))
    s.write(rows(spark, {"/a/1.txt": "rewritten without those words", "/a/9.txt": "apache license fox"}))
    s.delete(spark.createDataFrame([("/a/2.txt",)], "URI string"))
    s.write(rows(spark, {"/b/5.txt": "quick quick fox"}), merge_metadata=True)
    return s


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    return opened(spark, tmp_path_factory.mktemp("indexed"), True), opened(spark, tmp_path_factory.mktemp("plain"), False)


@pytest.mark.parametrize("at", range(len(QUERIES)))
@pytest.mark.parametrize("filtered", ["true", "false"])
def test_the_index_finds_what_the_scan_finds(both, at, filtered):
    options = {f"read.documents.{k}": v for k, v in QUERIES[at].items()} | {"read.documents.filtered": filtered, "read.documents.categories": "content,collections"}
    indexed, plain = ([tuple(r) for r in s.search(options).orderBy("URI").collect()] for s in both)
    assert indexed == plain


@pytest.mark.parametrize("query", ["fox", "-license", "quick apache"])
def test_an_earlier_version_has_its_own_words(both, query):
    found = [[r[0] for r in s.search({"read.documents.stringQuery": query}, version=1).orderBy("URI").collect()] for s in both]
    assert found[0] == found[1] and found[0]


def test_the_plan_reads_postings_and_no_content(both):
    found = both[0].located(search.of_options(store.Options.of({"read.documents.stringQuery": '"apache license" -fox'})))
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("positions" in s for s in scans) and not any("content" in s for s in scans)
    assert "PushedFilters: [" in plan and "PartitionFilters: [" in plan and "bucket" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_unfiltered_is_answered_by_the_index_alone(both, monkeypatch):
    monkeypatch.setattr(search, "has_words", lambda *_: (_ for _ in ()).throw(AssertionError("read the text")))
    found = both[0].search({"read.documents.stringQuery": "fox", "read.documents.filtered": "false"})
    assert found.count() == 6


def test_positions_and_lexicon(spark, both):
    s = both[0]
    got = {(r["URI"], r["within"]): r["positions"] for r in s.postings(1).filter("term = 'fox'").collect()}
    assert got["/a/1.txt", ""] == [3] and got["/a/3.json", ""] == [1, 8] and got["/a/3.json", "t"] == [2] and got["/b/4.xml", "title"] == [2]
    assert got["/b/8.txt", ""] == [3, 5]
    words = {r["term"]: (r["documents"], r["occurrences"]) for r in s.lexicon(1).filter("within = ''").collect()}
    assert words["fox"] == (5, 7) and words["license"] == (4, 4)


def test_compacting_keeps_the_index(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"), buckets=2, index=True, fold=3)
    for k in range(7):
        s.write(rows(spark, {"/a/1.txt": f"round {k}", f"/a/{k + 2}.txt": f"text number{k}"}))
    assert s.indexed() and len(s._commits(s.latest())) < 3
    one = lambda q: sorted(r[0] for r in s.search({"read.documents.stringQuery": q}).select("URI").collect())
    assert one("round 6") == ["/a/1.txt"] and one("3") == [] and one("number*") == [f"/a/{k}.txt" for k in range(2, 9)]
    assert s.read().count() == 8


def test_two_writers_follow_each_other(spark, tmp_path):
    a, b = (store.Store(spark, str(tmp_path / "s"), buckets=2) for _ in range(2))
    a.write(rows(spark, {"/a/1.txt": "one"}))
    assert not b._publish(1, [])  # the version is there and stays
    assert a._commits(1) and a.latest() == 1
    real, raced = b._publish, []

    def late(version, commits):
        if not raced:
            raced.append(a.write(rows(spark, {"/a/3.txt": "three"})))
        return real(version, commits)

    b._publish = late
    b.write(rows(spark, {"/a/2.txt": "two"}))
    assert sorted(r[0] for r in a.read().select("URI").collect()) == ["/a/1.txt", "/a/2.txt", "/a/3.txt"] and a.latest() == 3


def test_the_order_says_which_row_is_the_last(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"), buckets=2)
    many = [(f"/d/{i % 5}.txt", str(i).encode(), i) for i in range(200)]
    df = spark.createDataFrame(many, "URI string, content binary, at long").repartition(7, F.rand(1))
    d = documents.blank(df.select("URI", "content")).columns
    s.write(documents.blank(df.select("URI", "content")).limit(0).unionByName(df.select(*[F.col(c) if c in ("URI", "content") else F.lit(None).cast(t).alias(c) for c, t in documents.blank(df.select("URI", "content")).dtypes], "at"), allowMissingColumns=True), order="at")
    assert d and {r["URI"]: bytes(r["content"]).decode() for r in s.read().collect()} == {f"/d/{k}.txt": str(195 + k) for k in range(5)}


def test_few_documents_are_fetched_by_name(both):
    uris = both[0].read().select("URI").limit(2)
    plan = both[0].lookup(uris)._jdf.queryExecution().executedPlan().toString()
    assert "In(URI" in plan or "EqualTo(URI" in plan
