import json

import pytest

from docloom.sources import rdf

XSD = rdf.XSD
EX = "http://e/"


def got(name, text):
    return sorted((r["subject"], r["predicate"], r["object"], r["datatype"], r["lang"], r["graph"]) for r in rdf.parse(name, text.encode()))


def test_ntriples_terms():
    rows = got("a.nt", '# note\n<http://e/s> <http://e/p> "x\\n\\"\\u00e9" .\n<http://e/s> <http://e/p> "y"@en-GB . # end\n_:b1 <http://e/p> "3"^^<http://www.w3.org/2001/XMLSchema#integer> .\n<http://e/s> <http://e/q> _:b1 .\n')
    assert rows == sorted(
        [
            (EX + "s", EX + "p", 'x\n"é', XSD + "string", None, None),
            (EX + "s", EX + "p", "y", rdf.LANG_STRING, "en-GB", None),
            (rdf.BLANK + "b1", EX + "p", "3", XSD + "integer", None, None),
            (EX + "s", EX + "q", rdf.BLANK + "b1", None, None, None),
        ]
    )


def test_nquads_default_graph():
    rows = got("a.nq", '<http://e/s> <http://e/p> "x" <http://e/g> .\n<http://e/s> <http://e/p> "y" .\n')
    assert [r[5] for r in rows] == ["http://e/g", rdf.DEFAULT_GRAPH]


def test_turtle():
    text = """@prefix : <http://e/> . PREFIX x: <http://x/>
    @base <http://base/> .
    :s a x:T ; :p "a", "b"@fr , 3, 4.5, 1e3, true, '''long "text" here''' ; :q <rel> ;.
    :s :list (1 :two) . [ :in [ :deep "v" ] ] :out :s . x:a.b :p :c\\.d ."""
    rows = got("a.ttl", text)
    assert (EX + "s", rdf.RDF + "type", "http://x/T", None, None, None) in rows
    assert (EX + "s", EX + "q", "http://base/rel", None, None, None) in rows
    objects = {r[2]: (r[3], r[4]) for r in rows if r[1] == EX + "p"}
    assert objects["3"][0] == XSD + "integer" and objects["4.5"][0] == XSD + "decimal" and objects["1e3"][0] == XSD + "double" and objects["true"][0] == XSD + "boolean"
    assert objects["b"] == (rdf.LANG_STRING, "fr") and 'long "text" here' in objects
    assert sum(r[1] in (rdf.RDF + "first", rdf.RDF + "rest") for r in rows) == 4
    assert ("http://x/a.b", EX + "p", EX + "c.d", None, None, None) in rows
    assert sum(r[1] in (EX + "in", EX + "deep", EX + "out") for r in rows) == 3


def test_trig():
    rows = got("a.trig", "@prefix : <http://e/> . :g { :s :p 1 ; :q 2 . :t :p 3 } { :d :p 4 . } GRAPH :h { :s :p 5 }")
    assert sorted((r[2], r[5]) for r in rows) == [("1", EX + "g"), ("2", EX + "g"), ("3", EX + "g"), ("4", rdf.DEFAULT_GRAPH), ("5", EX + "h")]


def test_rdfxml():
    text = f"""<rdf:RDF xmlns:rdf="{rdf.RDF}" xmlns:e="http://e/" xml:base="http://b/">
    <e:T rdf:about="s" e:attr="v"><e:p xml:lang="de">x</e:p><e:q rdf:resource="o"/><e:n rdf:datatype="{XSD}int">3</e:n>
    <e:r><rdf:Description rdf:about="http://e/in"><e:p>deep</e:p></rdf:Description></e:r><e:c rdf:parseType="Resource"><e:p>y</e:p></e:c></e:T></rdf:RDF>"""
    rows = got("a.rdf", text)
    assert ("http://b/s", rdf.RDF + "type", EX + "T", None, None, None) in rows
    assert ("http://b/s", EX + "p", "x", rdf.LANG_STRING, "de", None) in rows
    assert ("http://b/s", EX + "q", "http://b/o", None, None, None) in rows
    assert (EX + "in", EX + "p", "deep", XSD + "string", None, None) in rows and len(rows) == 9


def test_rdfjson_and_trix():
    text = json.dumps({"http://e/s": {"http://e/p": [{"type": "literal", "value": "x", "lang": "en"}, {"type": "uri", "value": "http://e/o"}, {"type": "bnode", "value": "_:z"}]}})
    assert {r[2] for r in got("a.json", text)} == {"x", "http://e/o", rdf.BLANK + "z"}
    trix = "<TriX xmlns='http://www.w3.org/2004/03/trix/trix-1/'><graph><uri>http://e/g</uri><triple><uri>http://e/s</uri><uri>http://e/p</uri><plainLiteral xml:lang='en'>x</plainLiteral></triple></graph></TriX>"
    assert got("a.trix", trix) == [(EX + "s", EX + "p", "x", rdf.LANG_STRING, "en", EX + "g")]


@pytest.mark.parametrize("syntax", ["nt", "nq", "ttl", "trig", "trix"])
def test_what_is_written_is_read(syntax):
    rows = [
        {"subject": EX + "s", "predicate": EX + "p", "object": 'a "q" \\ \n é', "datatype": XSD + "string", "lang": None, "graph": EX + "g"},
        {"subject": EX + "s", "predicate": EX + "p", "object": "b", "datatype": rdf.LANG_STRING, "lang": "fr", "graph": EX + "g"},
        {"subject": rdf.BLANK + "n1", "predicate": EX + "p", "object": "4", "datatype": XSD + "int", "lang": None, "graph": EX + "h"},
        {"subject": EX + "s", "predicate": EX + "q", "object": rdf.BLANK + "n1", "datatype": None, "lang": None, "graph": EX + "g"},
    ]
    back = list(rdf.parse("x." + syntax, rdf.serialized(rows, syntax)))
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    want = rows if syntax in ("nq", "trig", "trix") else [r | {"graph": None} for r in rows]
    assert sorted(back, key=key) == sorted(want, key=key)


@pytest.mark.parametrize(("name", "text"), [("a.nt", "<http://e/s> <http://e/p> ."), ("a.ttl", ":s :p :o ."), ("a.ttl", "<http://e/s> <http://e/p>"), ("a.trdf", "x")])
def test_bad_files(name, text):
    with pytest.raises(rdf.RdfError):
        list(rdf.parse(name, text.encode()))


def test_what_stands_before_an_error_is_read():
    text = "@prefix : <http://e/> . :g { :s :p 1 . :s :p 2 . :t :p ?? }"
    rows = []
    with pytest.raises(rdf.RdfError):
        for r in rdf.parse("a.trig", text.encode()):
            rows.append(r["object"])
    assert rows == ["1", "2"]


@pytest.mark.parametrize("syntax", ["nt", "nq", "ttl", "trig", "trix"])
@pytest.mark.parametrize("squeezed", ["", "gzip"])
def test_files_are_written_block_by_block(spark, tmp_path, monkeypatch, syntax, squeezed):
    from docloom.operators import sinks
    from docloom.schemas import TRIPLE
    from docloom.sources import files

    monkeypatch.setattr(sinks, "RDF_BLOCK", 3)
    graphs = syntax in ("nq", "trig", "trix")
    rows = [(f"{EX}s{i % 4}", EX + "p", f"v{i} <&>", XSD + "string", None, f"{EX}g{i % 2}" if graphs else rdf.DEFAULT_GRAPH) for i in range(20)]
    df = spark.createDataFrame(rows, TRIPLE).coalesce(1)
    assert sinks.write_rdf(df if graphs else df.withColumn("graph", df["graph"].substr(1, 0)), str(tmp_path / "o"), {"write.files.rdf.format": syntax, "write.files.compression": squeezed}) == 20
    back = files.read(spark, str(tmp_path / "o"), {"read.files.type": "rdf"} | ({"read.files.compression": "gzip"} if squeezed else {}))
    shown = {(r["subject"], r["object"], r["graph"] if graphs else None) for r in back.collect()}
    assert shown == {(r[0], r[2], r[5] if graphs else None) for r in rows}
