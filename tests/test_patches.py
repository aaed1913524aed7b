import json
import xml.etree.ElementTree as ET

import pytest

from docloom.operators import documents, enrich, patches

MODEL = lambda texts: [[float(len(t)), 0.5] for t in texts]


def piped(spark, content, kind="JSON", **options):
    docs = documents.blank(spark.createDataFrame([(f"/d.{kind.lower()}", content.encode(), kind)], "URI string, content binary, format string"))
    rows = enrich.pipeline(docs, {"write.embedder.batchSize": "2"} | {k.replace("_", "."): v for k, v in options.items()}, model=MODEL).collect()
    assert len(rows) == 1
    return bytes(rows[0]["content"]).decode()


def test_vectors_go_into_the_chunks(spark):
    got = json.loads(piped(spark, '{"a":1,"chunks":[{"text":"one"},{"text":"three","x":[1]}],"z":null}'))
    assert list(got) == ["a", "chunks", "z"] and [c["_vector"] for c in got["chunks"]] == [[3.0, 0.5], [5.0, 0.5]] and got["chunks"][1]["x"] == [1]
    assert all("model-name" in c for c in got["chunks"])


@pytest.mark.parametrize("chunks, text, document, want", [
    ("/a~1b/0/c", "/t/v", {"a/b": [{"c": [{"t": {"v": "xx"}}, {"t": 1}, {"t": {"v": ""}}, {"t": {"v": 77}}]}]}, [2.0, None, None, 2.0]),
    ("/one", "/text", {"one": {"text": "word"}}, [4.0]),
    ("/none", "/text", {"one": {"text": "word"}}, []),
    ("/list", "/text", {"list": ["no object", {"text": "ab"}, None]}, [2.0]),
])
def test_pointers(spark, chunks, text, document, want):
    places = patches.Places(chunks, text)
    raw = json.dumps(document).encode()
    texts = patches.texts(raw, "JSON", places)
    out = json.loads(patches.patched(raw, "JSON", [{"_vector": v} for v in MODEL(texts)], places))
    found = patches.at_pointer(out, chunks)
    each = [c for c in (found if isinstance(found, list) else [found]) if isinstance(c, dict)]
    assert [c.get("_vector", [None])[0] for c in each] == want


def test_names_and_base64(spark):
    got = json.loads(piped(spark, '{"chunks":[{"text":"one"}]}', write_embedder_embedding_name="v", write_embedder_base64Encode="true"))
    assert enrich.vector_of_base64(got["chunks"][0]["v"]) == [3.0, 0.5]


XML = """<?xml version="1.0"?>
<!-- stays --><r xmlns="urn:r" xmlns:p='urn:p'><chunks><chunk><text>one</text></chunk><chunk><p:text>th&amp;ee</p:text><more a="1"/></chunk><chunk/><chunk><text> </text></chunk></chunks><p:tail/></r>
"""


def test_xml_keeps_its_bytes(spark):
    got = piped(spark, XML, "XML")
    kept = got
    while "<model-name" in kept:
        kept = kept[: kept.index("<model-name")] + kept[kept.index("</_vector>") + len("</_vector>") :]
    assert kept == XML
    vectors = [e.text for e in ET.fromstring(got).iter(f"{{{patches.CHUNK_NS}}}_vector")]
    assert vectors == ["[3.0, 0.5]", "[5.0, 0.5]"]


def test_xml_paths(spark):
    content = "<a xmlns:p='urn:p'><p:b><c n='1'><d>xx</d><d>yyy</d></c><c n='2'><d>z</d></c></p:b></a>"
    got = piped(spark, content, "XML", write_embedder_chunks_xpath="/a/q:b/c[@n='1']", write_embedder_text_xpath="d", xpath_q="urn:p", write_embedder_embedding_namespace="urn:v", write_embedder_embedding_name="e")
    root = ET.fromstring(got)
    assert [(e.text, e.attrib) for e in root.iter("{urn:v}e")] == [("[6.0, 0.5]", {"{http://www.w3.org/XML/1998/namespace}lang": "zxx"})]
    assert root.find("{urn:p}b/c[1]/{urn:v}e") is not None


def test_what_can_not_be_read_stays(spark):
    for content, kind in (("{broken", "JSON"), ("<broken", "XML"), ("text", "TEXT"), ("[1]", "JSON"), ("", "JSON")):
        assert piped(spark, content, kind) == content
    assert patches.texts(None, "JSON", patches.Places()) == [] and patches.patched(None, "JSON", [], patches.Places()) is None
