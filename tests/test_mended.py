"""Cases that once gave wrong rows, and sources that only files can show."""

import gzip
import zipfile

from docloom.operators.documents import blank
from docloom.operators.store import Store
from docloom.plans import search
from docloom.options import Options
from docloom.sources import files, rdf, readers


def docs(spark, rows):
    return blank(spark.createDataFrame([(u, t.encode(), f) for u, t, f in rows], "URI string, content binary, format string"))


def test_words_of_text_documents_stand_between_any_signs(spark):
    rows = docs(
        spark,
        [
            ("/1", 'She said "hello": then left', "TEXT"), ("/2", "if a < hello and c > d", "TEXT"), ("/3", '{"hello": "x"}', "JSON"), ("/4", "<hello>x</hello>", "XML"),
            ("/5", '{"a": "say hello"}', "JSON"), ("/6", "<a>hello</a>", "XML"), ("/7", '{"a": "if x < hello > y"}', "JSON"), ("/8", '<a b="c">"hello": d</a>', "XML"), ("/9", "hello", None),
        ],
    )
    found = search.matching(rows, search.of_options(Options.of({"read.documents.stringQuery": "hello"})))
    assert sorted(r["URI"] for r in found.collect()) == ["/1", "/2", "/5", "/6", "/7", "/8", "/9"]


def test_blank_nodes_of_different_files_are_different(spark, tmp_path):
    for n in ("a.nt", "b.nt"):
        (tmp_path / n).write_text(f'_:x <http://e/p> "{n}" .\n_:x <http://e/q> _:y .\n')
    (tmp_path / "c.ttl").write_text('[] <http://e/p> "c" .')
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("1.ttl", '[] <http://e/p> "1" .')
        z.writestr("2.ttl", '[] <http://e/p> "2" .')
    got = files.read(spark, str(tmp_path / "*.nt"), {"read.files.type": "rdf"}).collect()
    got += files.read(spark, str(tmp_path / "c.ttl"), {"read.files.type": "rdf"}).collect()
    got += files.read(spark, str(tmp_path / "d.zip"), {"read.files.type": "rdf", "read.files.compression": "zip"}).collect()
    assert all(r["subject"].startswith(rdf.BLANK) for r in got)
    assert len({r["subject"] for r in got}) == 5 and len(got) == 7
    for r in got:
        if r["predicate"].endswith("q"):
            assert r["object"].startswith(rdf.BLANK) and r["object"] != r["subject"]


def test_aggregate_xml_keeps_its_bytes():
    source = b"""<?xml version="1.0"?><r xmlns:n="urn:n" xmlns:o="urn:o"><n:e b='2'><![CDATA[x<y]]><!-- c --></n:e>\n<n:e/><k><n:e xmlns:n="urn:n"><o:i>5</o:i>&amp;</n:e ></k></r>"""
    got = [r["content"] for r in readers.aggregate_xml("f.xml", source, "e", "urn:n")]
    assert got == [b"""<n:e xmlns:n="urn:n" b='2'><![CDATA[x<y]]><!-- c --></n:e>""", b'<n:e xmlns:n="urn:n"/>', b'<n:e xmlns:o="urn:o" xmlns:n="urn:n"><o:i>5</o:i>&amp;</n:e >']
    latin = '<?xml version="1.0" encoding="ISO-8859-1"?><r><e>é</e><e><e>in</e></e></r>'.encode("latin-1")
    assert [r["content"].decode() for r in readers.aggregate_xml("f.xml", latin, "e")] == ["<e>é</e>", "<e><e>in</e></e>"]
    assert [r["URI"] for r in readers.aggregate_xml("f.xml", b"<r xmlns='urn:d'><e><id>7</id></e></r>", "e", "urn:d", "id", "urn:d")] == ["7"]
    assert len(list(readers.aggregate_xml("f.xml", b"<r><e>1</e><e>2</e><", "e", tolerant=True))) == 2


def test_zipped_aggregate_xml_and_zipped_rdf(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("a.xml", "<r><e>1</e><e>2</e></r>")
        z.writestr("b.xml", "<r><e>3</e></r>")
    got = files.read(spark, str(tmp_path / "x.zip"), {"read.aggregates.xml.element": "e", "read.files.compression": "zip"}).collect()
    assert sorted((r["URI"].rpartition("/")[2], bytes(r["content"])) for r in got) == [("x.zip-1-1.xml", b"<e>1</e>"), ("x.zip-1-2.xml", b"<e>2</e>"), ("x.zip-2-1.xml", b"<e>3</e>")]


def test_json_lines_are_numbered_in_their_file_by_many_tasks(spark, tmp_path):
    lines = ['{"n": %d, "t": "é  %s"}' % (k, "x" * (k % 50)) if k % 7 else "  " for k in range(1, 4001)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines), encoding="utf-8")
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress("\r\n".join(lines[:100]).encode()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = files.read(spark, str(tmp_path), {"read.files.type": "json_lines"})
        assert rows.rdd.getNumPartitions() > 3 or rows.count()
        got = {r["URI"].rpartition("/")[2]: bytes(r["content"]).decode() for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {f"a.jsonl-{n}.json": x for n, x in enumerate(lines, 1) if x.strip()} | {f"b.jsonl.gz-{n}.json": x for n, x in enumerate(lines[:100], 1) if x.strip()}
    assert got == want


def test_listing_options_and_partitions(spark, tmp_path):
    for n in range(6):
        (tmp_path / f"{n}.txt").write_text(str(n))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.txt").write_text("deep")
    (tmp_path / "sub" / "y.csv").write_text("no")
    names = lambda o: sorted(r["URI"].rpartition("/")[2] for r in files.read(spark, str(tmp_path), o).collect())
    assert names({"recursiveFileLookup": "true", "pathGlobFilter": "*.txt"}) == ["0.txt", "1.txt", "2.txt", "3.txt", "4.txt", "5.txt", "x.txt"]
    assert names({"pathGlobFilter": "*.txt", "modifiedAfter": "2100-01-01T00:00:00"}) == []
    packed = files.read(spark, str(tmp_path), {"pathGlobFilter": "*.txt", "read.numPartitions": "3"})
    sizes = packed.rdd.glom().map(len).collect()
    assert len(sizes) == 3 and min(sizes) > 0


def test_files_are_read_late_without_their_names_on_the_driver(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.txt").write_text(f"text {n}")
    rows = files.read(spark, str(tmp_path), {"streamFiles": "true"})
    got = files.late(rows.filter("URI not like '%1.txt'"))
    assert sorted(bytes(r["content"]).decode() for r in got.collect()) == ["text 0", "text 2"]


def test_a_lookup_reads_its_buckets_alone_and_the_last_commit_wins(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.write(docs(spark, [(f"/{k}", f"first {k}", "TEXT") for k in range(40)]))
    store.write(docs(spark, [(f"/{k}", f"second {k}", "TEXT") for k in range(0, 40, 3)]))
    store.delete(spark.createDataFrame([("/5",), ("/6",)], "URI string"))
    store.write(docs(spark, [("/6", "third 6", "TEXT")]))
    want = {f"/{k}": f"second {k}" if k % 3 == 0 else f"first {k}" for k in range(40) if k != 5} | {"/6": "third 6"}
    assert {r["URI"]: bytes(r["content"]).decode() for r in store.read().collect()} == want
    found = store.lookup(spark.createDataFrame([("/6",), ("/7",), ("/5",), ("/none",)], "URI string"))
    assert {r["URI"]: bytes(r["content"]).decode() for r in found.collect()} == {"/6": "third 6", "/7": "first 7"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket), ", "") or "bucket IN" in plan or "bucket#" in plan.split("PartitionFilters")[1][:200]
    assert store.read(1).count() == 40
    store.compact()
    assert {r["URI"]: bytes(r["content"]).decode() for r in store.read().collect()} == want


def test_what_is_paid_for_is_called_once(spark, tmp_path):
    from docloom.operators import documents, enrich

    calls = tmp_path / "calls"

    def classifier(texts):
        with open(calls, "a") as f:
            f.write("x" * len(texts))
        return [b"<topic><name>sea</name></topic>"] * len(texts)

    rows = docs(spark, [("/1.json", '{"t": "one"}', "JSON"), ("/2.xml", "<a><b>two</b></a>", "XML"), ("/3.txt", "three", "TEXT")])
    store = Store(spark, f"file://{tmp_path}/s")
    done = documents.write(rows, store, {"write.abortOnFailure": "false", "write.incremental": "true"}, enrich=lambda d: enrich.pipeline(d, {}, classifier=classifier))
    assert done == {"success": 3, "failed": 0, "skipped": 0} and calls.read_text() == "xxx"
    got = {r["URI"]: bytes(r["content"]).decode() for r in store.read().collect()}
    assert got == {"/1.json": '{"t": "one", "classification": {"topic": {"name": "sea"}}}', "/2.xml": "<a><b>two</b><classification><topic><name>sea</name></topic></classification></a>", "/3.txt": "three"}


def test_xml_answers_as_json():
    from docloom.operators.enrich import as_json, xml_of

    assert as_json(xml_of(b'<r a="1"><x>u</x><x>v</x><y b="2">w</y><z/></r>')) == {"a": "1", "x": ["u", "v"], "y": {"b": "2", "content": "w"}, "z": ""}
    assert xml_of(b"plain") is None and xml_of(b"<broken") is None


def test_an_equality_on_a_parameter_binds_it_anew(spark):
    from docloom.api import Engine

    engine = Engine(spark)
    engine.views.register("t", "n", spark.range(10).selectExpr("id", "id % 3 AS k"))
    asked = {"read.query": "op.fromView('t','n','').where(op.eq(op.col('k'), op.param('want')))", "read.param.want": "1", "read.param.type.want": "int"}
    assert {r["id"] for r in engine.read(asked).collect()} == {1, 4, 7}
    got = engine.read(asked, where=[("eq", "want", 2), ("gt", "id", 2)]).collect()
    assert {(r["id"], r["want"]) for r in got} == {(5, 2), (8, 2)}


def test_a_task_that_runs_again_leaves_one_file(spark, tmp_path):
    from docloom.operators import sinks

    rows = docs(spark, [(f"/{k}.txt", f"t{k}", "TEXT") for k in range(20)]).repartition(3)
    assert sinks.write_files(rows, str(tmp_path / "z"), {"write.files.compression": "zip"}) == 20
    names = sorted(p.name for p in (tmp_path / "z").iterdir())
    assert len(names) == 3 and len({n.rpartition("-")[0] for n in names}) == 1 and all(n.endswith(".zip") for n in names)
    folder = sinks._Folder(str(tmp_path / "y"))
    for text in (b"first", b"again"):
        with folder.opened("a.zip") as f:
            f.write(text)
    try:
        with folder.opened("b.zip") as f:
            f.write(b"half")
            raise ValueError
    except ValueError:
        pass
    assert [(p.name, p.read_bytes()) for p in (tmp_path / "y").iterdir()] == [("a.zip", b"again")]


def test_pieces_close_when_full(spark):
    import random

    from pyspark.sql import functions as F

    from docloom.operators.enrich import split_on

    rng = random.Random(2)
    texts = [" ".join("w" * rng.randint(1, 12) for _ in range(rng.randint(0, 60))) for _ in range(60)]

    def plain(text, size):
        out = []
        for w in text.split():
            if out and len(out[-1]) + 1 + len(w) <= size:
                out[-1] += " " + w
            else:
                out.append(w)
        return out

    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", split_on(F.col("t"), r"\s+", 40).alias("p"))
    assert all(r["p"] == plain(r["t"], 40) for r in df.collect())


def test_progress_and_skipped_documents_are_logged(spark, tmp_path, caplog):
    from docloom.operators import documents

    store = Store(spark, f"file://{tmp_path}/s")
    rows = docs(spark, [(f"/{k}.txt", f"t{k}", "TEXT") for k in range(5)])
    o = {"write.incremental": "true", "write.logSkippedDocuments": "true", "write.logProgress": "2"}
    assert documents.write(rows, store, o)["success"] == 5
    with caplog.at_level("INFO", logger="docloom.operators.documents"):
        assert documents.write(rows, store, o) == {"success": 0, "failed": 0, "skipped": 5}
    assert "skipped 5 documents" in caplog.text


def test_packed_pieces_of_the_query(spark, tmp_path):
    from docloom.queries import QUERIES

    texts = ["", " ", "one", "a b " * 3000, "x" * 5000 + " tail", None, "w " + "y" * 1999 + " z", "p\n" * 2500]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for k, t in enumerate(texts):
        words, out = (t or "").split(), []
        most = max([2000, *map(len, words)])
        for w in words:
            if out and len(out[-1]) + 1 + len(w) <= most:
                out[-1] += " " + w
            else:
                out.append(w)
        want += [(k, n, len(p)) for n, p in enumerate(out)]
    assert sorted(map(tuple, QUERIES["split_regex_packed"](spark, str(tmp_path)).collect())) == want


def test_words_are_runs_of_letters_and_digits(spark):
    rows = docs(spark, [("/1", "Foo_bar, baz", "TEXT"), ("/2", "foobar", "TEXT"), ("/3", "FOO -- BAR baz9", "TEXT"), ("/4", "éfoo bar", "TEXT"), ("/5", "foo bars", "TEXT")])
    found = lambda q: sorted(r["URI"] for r in search.matching(rows, search.of_options(Options.of({"read.documents.stringQuery": q}))).collect())
    assert found('"foo bar"') == ["/1", "/3"] and found('"foo bar*"') == ["/1", "/3", "/5"] and found("foo*") == ["/1", "/2", "/3", "/5"] and found("baz") == ["/1"]


def test_rows_with_a_file_path_are_named_by_it(spark):
    from docloom.functions import uris
    from docloom.operators import documents

    rows = spark.createDataFrame([("/in/a.csv", 1), ("/in/b.csv", 2)], f"{uris.FILE_PATH_COLUMN} string, n int")
    got = documents.of_rows(rows, Options.of({"write.uriPrefix": "/p", "write.uriSuffix": ".x"})).collect()
    assert sorted(r["URI"].rpartition("/")[0] for r in got) == ["/p/in/a.csv", "/p/in/b.csv"] and all(r["URI"].endswith(".x") for r in got)
    assert sorted(bytes(r["content"]) for r in got) == [b'{"n":1}', b'{"n":2}'] and len({r["URI"] for r in got}) == 2


def test_metadata_keys_as_json_names(spark):
    from pyspark.sql import functions as F

    from docloom.functions.metadata import json_keys

    one = spark.range(1).select(json_keys(F.create_map(F.lit("dc:title"), F.lit("a:b"), F.lit("plain"), F.lit("c"))).alias("m")).first()
    assert one["m"] == {"dc-title": "a:b", "plain": "c"}


def test_a_transform_runs_on_streamed_binary_files_of_listed_extensions(spark):
    from docloom.operators import documents

    documents.TRANSFORMS["upper"] = lambda text, given: text.upper() + given.get("end", "")
    rows = docs(spark, [("/a.bin", "one", "BINARY"), ("/b.dat", "two", "BINARY"), ("/c.bin", "three", "TEXT")])
    o = Options.of({"write.transform": "upper", "write.transformParams": "end,!", "streamTransformBinaryExtensions": "bin, .xyz"})
    got = {r["URI"]: bytes(r["content"]) for r in documents.transformed(rows, o, only=documents.streamable(o)).collect()}
    assert got == {"/a.bin": b"ONE!", "/b.dat": b"two", "/c.bin": b"three"}


def test_text_of_pages_as_in_sql(spark, tmp_path):
    import duckdb

    from docloom.queries import ORACLE_SQL, QUERIES

    pages = ["<p>cut at&amp\nand&amp;</p>&lt;b&gt; &am", "<p>a&nbsp;</p><p>&nbsp;</p>\r\n<p>x\x0by</p>", "<head>&copy;</head><script>no</script>&amp;lt; &copy 2 &notit;", "<!-- <script> --> kept </script> end", " ", " a\u0085b"]
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame([(k, f"u{k}", h) for k, h in enumerate(pages)], "page_id long, url string, html string").coalesce(1).write.parquet(path)
    with duckdb.connect() as db:
        db.execute(f"create view pages as select * from '{path}/*.parquet'")
        want = sorted(db.execute(ORACLE_SQL["html_text"]).fetchall())
    assert sorted(map(tuple, QUERIES["html_text"](spark, str(tmp_path)).collect())) == want


def test_long_partitions_become_several_files(spark, tmp_path, monkeypatch):
    from docloom.operators import sinks
    from docloom.sources import files, rdf

    monkeypatch.setattr(sinks, "ZIP_BYTES", 1000)
    monkeypatch.setattr(sinks, "RDF_BYTES", 1000)
    monkeypatch.setattr(sinks, "RDF_BLOCK", 10)
    folder = sinks._Folder(str(tmp_path / "x"))
    try:
        with folder.together() as begin:
            begin("a.zip").write(b"1")
            begin("b.zip").write(b"2")
            raise ValueError
    except ValueError:
        assert list((tmp_path / "x").iterdir()) == []
    rows = docs(spark, [(f"/{k}.txt", f"text {k} " * 9, "TEXT") for k in range(60)]).coalesce(1)
    assert sinks.write_files(rows, str(tmp_path / "z"), {"write.files.compression": "zip"}) == 60
    assert len(list((tmp_path / "z").glob("*.zip"))) > 1
    assert {r["URI"] for r in files.read(spark, str(tmp_path / "z"), {"read.files.type": "archive"}).collect()} == {f"/{k}.txt" for k in range(60)}
    for syntax, blank in (("trix", False), ("nq", False), ("trix", True)):
        node = rdf.BLANK if blank else "http://s/"
        made = spark.createDataFrame([(f"{node}{k}", "http://p", "o", rdf.XSD + "string", None, f"http://g/{k % 3}") for k in range(90)], "subject string, predicate string, object string, datatype string, lang string, graph string").coalesce(1)
        path = tmp_path / f"{syntax}{blank}"
        assert sinks.write_rdf(made, str(path), {"write.files.rdf.format": syntax}) == 90
        assert (len(list(path.iterdir())) == 1) == blank  # blank nodes are known inside one file alone
        got = files.read(spark, str(path), {"read.files.type": "rdf"})
        assert got.count() == 90 and got.select("subject").distinct().count() == 90 and {r[0] for r in got.select("graph").distinct().collect()} == {f"http://g/{k}" for k in range(3)}


def test_graph_named_after_its_triples():
    from docloom.sources import rdf

    t = "<triple><uri>s{0}</uri><uri>p</uri><plainLiteral>o</plainLiteral></triple>"
    text = f"<TriX><graph>{t.format(1)}<uri>g</uri>{t.format(2)}</graph><graph>{t.format(3)}</graph></TriX>"
    assert [(r["subject"], r["graph"]) for r in rdf.parse("a.trix", text.encode())] == [("s1", "g"), ("s2", "g"), ("s3", "urn:x-arq:DefaultGraphNode")]


def test_batches_of_python_functions_are_bounded(spark):
    from docloom import shared

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    shared.bounded(spark)
    assert int(spark.conf.get(name).removesuffix("b")) == 4 << 20
    sizes = spark.range(0, 400, 1, 1).selectExpr("repeat('x', 100000) AS t").mapInPandas(lambda found: (f.assign(n=len(f))[["n"]].head(1) for f in found), "n long").collect()
    assert max(r["n"] for r in sizes) < 60


def test_whole_documents_are_written_without_reading_the_store(spark, tmp_path):
    from pyspark.sql import functions as F

    from docloom.operators import documents

    store = Store(spark, f"file://{tmp_path}/s")
    seen = []
    real = store.write
    store.write = lambda rows, merge_metadata=False, order=None: seen.append(merge_metadata) or real(rows, merge_metadata, order)
    documents.write(docs(spark, [("/1.txt", "a", "TEXT")]), store)
    documents.write(docs(spark, [("/2.txt", "b", "TEXT")]), store)
    documents.write(docs(spark, [("/1.txt", "", "TEXT")]).withColumn("content", F.lit(None).cast("binary")), store)
    assert seen == [False, False, True] and sorted((r["URI"], bytes(r["content"])) for r in store.read().collect()) == [("/1.txt", b"a"), ("/2.txt", b"b")]


def test_postings_are_one_row_a_word_of_a_document(spark):
    from docloom.operators import postings

    rows = docs(spark, [("/1.txt", "One two, ONE--two one", "TEXT"), ("/2.txt", " _ ", "TEXT")])
    got = sorted((r["within"], r["term"], r["URI"], r["positions"]) for r in postings.of(rows).collect())
    assert got == [("", "one", "/1.txt", [0, 2, 4]), ("", "two", "/1.txt", [1, 3])]
