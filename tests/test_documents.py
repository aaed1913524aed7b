import json
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from docloom.api import Engine
from docloom.operators import documents, enrich, sinks, triples
from docloom.options import OptionError, Options
from docloom.schemas import DOCUMENT, TRIPLE
from docloom.sources import custom, files, readers


@pytest.fixture
def engine(spark, tmp_path):
    return Engine(spark, str(tmp_path / "store"))


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "Ann", None), (2, "Bob", "x")], "id int, name string, note string")


def content(rows):
    return {r["URI"]: bytes(r["content"]).decode() for r in rows.collect()}


def test_rows_become_json(people):
    got = content(documents.of_rows(people, {"write.uriTemplate": "/p/{id}.json"}))
    assert got["/p/1.json"] == '{"id":1,"name":"Ann","note":null}'
    assert content(documents.of_rows(people, {"write.uriTemplate": "/p/{id}.json", "write.jsonRootName": "p"}))["/p/2.json"] == '{"p":{"id":2,"name":"Bob","note":"x"}}'


def test_missing_template_values(people):
    with pytest.raises(Exception, match="Did not find value for note"):
        documents.of_rows(people, {"write.uriTemplate": "/{note}"}).collect()
    made = content(documents.of_rows(people, {"write.uriTemplate": "/{note}", "write.uriTemplate.warnOnMissingField": "true"}))
    assert "/x" in made and any(u.startswith("/UNRESOLVED-") for u in made)


def test_both_roots_are_refused(people):
    with pytest.raises(OptionError):
        documents.of_rows(people, {"write.jsonRootName": "a", "write.xmlRootName": "b"})


def test_versions_and_last_write(engine, people):
    o = {"write.uriTemplate": "/p/{id}.json", "write.collections": "a,b", "write.permissions": "r,read,r,update", "write.metadataValues.k": "v"}
    assert engine.write(people, o) == {"success": 2, "failed": 0, "skipped": 0}
    one = engine.store.latest()
    engine.write(people.filter("id = 1").withColumn("name", F.lit("New")), o)
    assert json.loads(content(engine.store.read())["/p/1.json"])["name"] == "New"
    assert json.loads(content(engine.store.read(one))["/p/1.json"])["name"] == "Ann"
    row = engine.read({"read.documents.collections": "a", "read.documents.categories": "content,metadata"}).filter("URI = '/p/2.json'").first()
    assert row["collections"] == ["a", "b"] and row["permissions"] == {"r": ["read", "update"]} and row["metadataValues"] == {"k": "v"}
    engine.store.compact()
    assert engine.store.read().count() == 2


def test_categories(engine, people):
    engine.write(people, {"write.uriTemplate": "/{id}", "write.collections": "a"})
    r = engine.read({"read.documents.collections": "a", "read.documents.categories": "collections"}).first()
    assert r["content"] is None and r["format"] is None and r["collections"] == ["a"]


def test_incremental(engine, people):
    o = {"write.uriTemplate": "/p/{id}.json", "write.incremental": "true", "write.incremental.jsonExclusions": "/note", "write.incremental.timestampKeyName": "at"}
    assert engine.write(people, o)["success"] == 2
    assert engine.write(people.withColumn("note", F.lit("other")), o) == {"success": 0, "failed": 0, "skipped": 2}
    assert engine.write(people.withColumn("name", F.concat("name", F.col("id").cast("string"))).filter("id = 2"), o)["success"] == 1
    assert set(engine.store.read().first()["metadataValues"]) == {documents.HASH_KEY, "at"}


def test_failures(spark, engine, tmp_path):
    docs = documents.blank(spark.createDataFrame([("/a.json", b"{}", "JSON"), ("/b.json", b"{oops", "JSON"), ("/c.txt", b"x", "TEXT")], "URI string, content binary, format string"))
    with pytest.raises(ValueError, match="/b.json"):
        engine.write(docs)
    done = engine.write(docs, {"write.abortOnFailure": "false", "write.archivePathForFailedDocuments": str(tmp_path / "bad")})
    assert done == {"success": 2, "failed": 1, "skipped": 0}
    (name,) = (tmp_path / "bad").iterdir()
    assert zipfile.ZipFile(name).namelist() == ["/b.json"]


def test_transform(spark, engine, people):
    documents.register_transform("upper", lambda text, p: text.upper() + p.get("end", ""))
    engine.write(people, {"write.uriTemplate": "/{id}.txt", "write.documentType": "TEXT", "write.transform": "upper", "write.transformParams": "end,!"})
    assert content(engine.store.read())["/2.txt"].endswith('"X"}!')
    with pytest.raises(OptionError):
        documents.params(Options.of({"write.transformParams": "a,b,c"}), "write.transform")


def test_secondary_documents(spark, engine):
    from docloom.operators.store import sharing_key, with_secondary

    rows = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, k int")
    engine.write(rows, {"write.uriTemplate": "/{id}"})
    docs = engine.store.read()
    key = F.get_json_object(F.decode("content", "UTF-8"), "$.k")
    got = with_secondary(docs.filter("URI in ('/0', '/3')"), docs, sharing_key(docs, key))
    assert sorted(r["URI"] for r in got.select("URI").collect()) == ["/0", "/3", "/6"]


def test_triples_through_the_store(spark, engine):
    rows = [(f"http://s/{i}", "http://p", f"v & {i}", None if i % 2 else "http://t", "en" if i % 2 else None, "http://g/1" if i < 250 else "g2") for i in range(260)]
    t = spark.createDataFrame(rows, TRIPLE)
    engine.write(t, {"write.collections": "extra"})
    assert engine.store.read().filter("array_contains(collections, 'graphs')").count() == 2
    assert engine.store.read().filter("array_contains(collections, 'extra')").select(F.max(F.size(F.regexp_extract_all(F.decode("content", "UTF-8"), F.lit("<triple>"), F.lit(0))))).first()[0] <= 100
    back = engine.read({"read.triples.graphs": "http://g/1"})
    got = sorted(map(tuple, back.collect()))
    from docloom.sources.rdf import LANG_STRING

    assert got == sorted((s, p, o, LANG_STRING if lang else d, lang, g) for s, p, o, d, lang, g in rows if g == "http://g/1")
    base = engine.read({"read.triples.graphs": "g2", "read.triples.baseIri": "http://base/"}).select("graph").distinct().collect()
    assert [r[0] for r in base] == ["http://base/g2"]


def test_archives_old_and_new(spark, tmp_path):
    from docloom.functions.metadata import to_xml

    meta = to_xml({"collections": ["c"], "quality": 4})
    with zipfile.ZipFile(tmp_path / "old.zip", "w") as z:
        for n, c in (("a.xml", "<a/>"), ("a.xml.metadata", meta), ("b.txt", "b"), ("b.txt.metadata", meta)):
            z.writestr(n, c)
    with zipfile.ZipFile(tmp_path / "new.zip", "w") as z:
        for n, c in (("a.xml.XML.metadata", meta), ("a.xml", "<a/>"), ("gone.json.JSON.metadata", meta)):
            z.writestr(n, c)
    read = lambda name, **o: {r["URI"]: r for r in files.read(spark, str(tmp_path / name), {"read.files.type": "archive", **o}).collect()}
    assert read("old.zip")["b.txt"]["quality"] == 4 and set(read("old.zip")) == {"a.xml", "b.txt"}
    new = read("new.zip", **{"read.archives.categories": "collections"})
    assert new["gone.json"]["content"] is None and new["gone.json"]["format"] == "JSON" and new["a.xml"]["collections"] == ["c"] and new["a.xml"]["quality"] is None


def test_bulk_archive():
    text = """<m xmlns="urn:m"><format><name>xml</name></format><collectionsList><string>c1</string></collectionsList><quality>2</quality>
    <permissionsList><permission><capability>READ</capability><role-id>7</role-id></permission></permissionsList><roles><role><role-id>7</role-id><role-name>admin</role-name></role></roles></m>"""
    got = readers.bulk_metadata(text)
    assert got["collections"] == ["c1"] and got["quality"] == 2 and got["permissions"] == {"admin": ["read"]}


def test_tolerant_reading(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<all><p><id>1</id></p><p/><p><id>3</id></p></all>")
    (tmp_path / "b.xml").write_text("<all><p><id>9</id></p>")
    o = {"read.aggregates.xml.element": "p", "read.aggregates.xml.uriElement": "id"}
    with pytest.raises(Exception, match="URI element|Unable to read XML"):
        files.read(spark, str(tmp_path), o).collect()
    got = files.read(spark, str(tmp_path), o | {"read.files.abortOnFailure": "false"}).collect()
    assert sorted(r["URI"] for r in got) == ["1", "3", "9"]


def test_late_reading(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("x.txt", "one")
        z.writestr("y.txt", "two")
    o = {"read.files.compression": "zip", "streamFiles": "true"}
    rows = files.read(spark, str(tmp_path), o)
    assert rows.first()["content"] is None
    assert sorted(bytes(r["content"]) for r in files.late(rows, o).collect()) == [b"one", b"two"]


@pytest.mark.parametrize("o", [{"read.files.type": "nope"}, {"read.files.compression": "rar"}, {"read.files.encoding": "no-such"}])
def test_bad_file_options(spark, tmp_path, o):
    (tmp_path / "a").write_text("x")
    with pytest.raises(OptionError):
        files.read(spark, str(tmp_path), o)


def test_paths_stay_inside(tmp_path):
    with pytest.raises(OptionError):
        sinks._Folder(str(tmp_path)).put("../out.txt", b"")


def test_splitting():
    text = "One two three. Four five six.\n\nSeven eight.\nNine ten eleven twelve."
    got = enrich.recursive_split(text, 20)
    assert all(len(p) <= 20 for p in got) and " ".join(" ".join(got).split()) == " ".join(text.split())
    assert enrich.recursive_split("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]
    assert enrich.recursive_split("  ", 10) == []
    over = enrich.recursive_split("a b c d e f g h i j", 7, 3)
    assert all(len(p) <= 7 for p in over) and over[1].startswith(over[0][-3:].strip())


def test_pattern_splitting(spark):
    df = spark.createDataFrame([("a,b,,c,dd",)], "t string")
    assert df.select(enrich.split_on(F.col("t"), ",", 3, ";")).first()[0] == ["a;b", "c", "dd"]
    with pytest.raises(Exception, match="longer than 1 characters"):
        df.select(enrich.split_on(F.col("t"), ",", 1)).collect()


def test_enrichment_of_json(spark):
    docs = documents.blank(spark.createDataFrame([("/a.json", b'{"t": "one two three four", "chunks": 1}', "JSON"), ("/b.txt", b"plain words here", "TEXT")], "URI string, content binary, format string"))
    o = {"write.splitter.jsonPointers": "/t", "write.splitter.maxChunkSize": "9", "write.splitter.sidecar.maxChunks": "0", "write.embedder.prompt": "say: "}

    def model(texts):
        return [[float(len(t))] for t in texts]

    got = {r["URI"]: bytes(r["content"]).decode() for r in enrich.pipeline(docs, o, model=model).collect()}
    made = json.loads(got["/a.json"])["splitter-chunks"]
    assert [c["text"] for c in made] == ["one two", "three", "four"] or [c["text"] for c in made] == ["one two", "three four"[:10]]
    assert made[0]["_vector"] == [12.0] and json.loads(got["/a.json"])["chunks"] == 1


def test_token_refresh():
    calls = []

    def call(token, texts):
        calls.append(token)
        if token == "t1":
            raise RuntimeError("HTTP 401")
        return [b"ok"] * len(texts)

    tokens = iter(["t1", "t2"])
    assert enrich.Refreshing(lambda: next(tokens), call)(["a"]) == [b"ok"] and calls == ["t1", "t2"]


def test_service(spark):
    class Mock(enrich.Service):
        def send(self, name, content):
            if content == b"bad":
                raise RuntimeError("no")
            return name

        def poll(self, ticket):
            return iter([{"text": "all"}, {"text": "c1", "embedding": [1.0, 2.0]}, {"text": "c2", "embedding": [3.0, 4.0]}])

    docs = documents.blank(spark.createDataFrame([("/a.txt", b"x", "TEXT"), ("/b.txt", b"bad", "TEXT")], "URI string, content binary, format string"))
    got = {r["URI"]: [c["text"] for c in r["chunks"]] for r in enrich.served(docs, Mock(), pause=0).collect()}
    assert got == {"/a.txt": ["c1", "c2"], "/b.txt": []}


def test_extraction():
    text, meta = enrich.extract(b"<html><head><title>T &amp; U</title><meta name='k' content='v'></head><body><p>One</p><script>no</script><p>Two</p></body></html>", "/a.html")
    assert text == "One\nTwo" and meta["dc:title"] == "T & U" and meta["k"] == "v"
    assert enrich.extract(b"", "a") is None and enrich.extract(b"\xff\xfe\x00", "a.bin") is None


def test_extracted_documents(spark):
    docs = documents.blank(spark.createDataFrame([("/a.txt", b"hello", "TEXT")], "URI string, content binary, format string"))
    got = content(enrich.extracted(docs, {"write.extractedText.documentType": "json"}))
    assert json.loads(got["/a.txt-extracted-text.json"])["content"] == "hello" and "/a.txt" in got
    assert len(content(enrich.extracted(docs, {"write.extractedText.documentType": "xml", "write.extractedText.dropSource": "true"}))) == 1


def test_vector_base64():
    assert enrich.vector_of_base64(enrich.vector_base64([1.0, -2.5])) == [1.0, -2.5]


def test_custom_code(spark, tmp_path):
    script = tmp_path / "code.py"
    script.write_text("def items(v):\n    return [{'n': int(v.get('PARTITION', 0)) * 10 + int(v['x'])}]\n\ndef parts(v):\n    return [1, 2, 3]\n")
    from pyspark.sql.types import StructType

    o = {"read.file": f"{script}:items", "read.partitions.file": f"{script}:parts", "read.vars.x": "5"}
    assert sorted(r["n"] for r in custom.read(spark, o, StructType.fromDDL("n int")).collect()) == [15, 25, 35]
    one = custom.read(spark, {"read.file": f"{script}:items", "read.vars.x": "5"}).collect()
    assert [r["URI"] for r in one] == ['{"n": 5}']


def test_row_query_rebinds_parameters(spark, tmp_path):
    e = Engine(spark)
    e.views.register("s", "v", spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string"))
    o = {"read.query": "op.fromView('s','v','').where(op.eq(op.col('k'), op.param('want')))", "read.param.want": "a"}
    assert [tuple(r) for r in e.read(o).collect()] == [(1, "a", "a")]
    assert [tuple(r) for r in e.read(o, want="b").collect()] == [(2, "b", "b")]


def test_dispatch_needs_something(spark):
    with pytest.raises(OptionError):
        Engine(spark).read({})


def test_document_row_shape():
    assert DOCUMENT.names == ["URI", "content", "format", "collections", "permissions", "quality", "properties", "metadataValues"]
    assert triples.GROUP == 100


def test_bytes_that_are_no_zip_have_no_rows(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(b"not a zip")
    assert files.read(spark, str(tmp_path), {"read.files.compression": "zip"}).collect() == []


def test_nested_rows_become_json_and_xml(spark):
    df = spark.createDataFrame([(1, {"color": "blue", "numbers": [1, 2]})], "id int, data struct<color:string,numbers:array<int>>")
    assert content(documents.of_rows(df, {"write.uriTemplate": "/{/data/color}/{id}"})) == {"/blue/1": '{"id":1,"data":{"color":"blue","numbers":[1,2]}}'}
    xml = content(documents.of_rows(df, {"write.uriTemplate": "/{id}", "write.xmlRootName": "row"}))["/1"]
    assert "<color>blue</color>" in xml and xml.count("<numbers>") == 2


def test_hashes_of_json_are_of_its_values(spark):
    """Order and white space make no difference, values do; nothing of it runs in Python unless values are excluded."""
    texts = ['{"b":[1,{"y":null,"x":"é"}],"a":1.5}', ' {"a" : 1.5,\n"b":[1, {"x":"\\u00e9","y":null}]} ', '{"a":1.5,"b":[{"x":"é","y":null},1]}', "{broken", '{"a":1,"a":2}', "", '"text"']
    rows = [(str(i), t.encode(), "JSON") for i, t in enumerate(texts)] + [("t", texts[0].encode(), "TEXT"), ("n", None, "JSON")]
    df = spark.createDataFrame(rows, "URI string, content binary, format string").withColumn("h", documents.content_hash())
    got = {r["URI"]: r["h"] for r in df.collect()}
    assert got["0"] == got["1"] and len({got[k] for k in ("1", "2", "3", "4", "5", "6", "t")}) == 7
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and "Arrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_extracted_metadata_as_xml(spark):
    """Known prefixes become namespaces; names and values are fit for XML whatever they hold."""
    from docloom.functions import metadata

    values = {"dc:title": "A & <b>", "xmp:a:b": "x", "odd:name": "y", "plain": 'q"\x01', "1 st?": "z", "pdf:": "none", "n": None}
    df = spark.createDataFrame([(values,)], "m map<string,string>").select(metadata.xml_elements(F.col("m")).alias("x"))
    found = {e.tag: e.text for e in ET.fromstring(f"<r>{df.first()['x']}</r>")}
    assert found == {"{http://purl.org/dc/elements/1.1/}title": "A & <b>", "{http://ns.adobe.com/xap/1.0/}a-b": "x", "odd-name": "y", "plain": 'q"', "_1-st-": "z", "{http://ns.adobe.com/pdf/1.3/}_": "none", "n": None}
    page = b"<html><head><title>T &amp; t</title><meta name='dcterms:x' content='v'></head><body>Hello &lt;x&gt;</body></html>"
    docs = documents.blank(spark.createDataFrame([("/p&.html", page)], "URI string, content binary"))
    made = enrich.extracted(docs, {"write.extractedText.documentType": "xml", "write.extractedText.dropSource": "true"}).first()
    root = ET.fromstring(bytes(made["content"]).decode())
    assert made["URI"] == "/p&.html-extracted-text.xml" and root.findtext("source-uri") == "/p&.html" and root.findtext("content") == "Hello <x>"
    assert root.find("extracted-metadata/{http://purl.org/dc/elements/1.1/}title").text == "T & t" and root.find("extracted-metadata/{http://purl.org/dc/terms/}x").text == "v"
