import pytest

from docloom.functions import metadata, uris
from docloom.functions.pointers import json_path, xpath_values
from docloom.options import OptionError, Options
from docloom.plans import names
from docloom.plans.buckets import LARGEST, Bucket, Partition, plan
from docloom.schemas import DOCUMENT, FILE, TRIPLE, kind_of


def test_blank_is_absent_and_booleans_are_lenient():
    o = Options.of({"a": "  ", "b": " x ", "c": "TRUE", "d": "yes", "e": True})
    assert o.text("a") is None and o.text("b") == "x" and o.flag("c") and not o.flag("d", True) and o.flag("e")


def test_numbers():
    o = Options.of({"n": "0", "m": "x", "k": "5"}, )
    assert o.number("k", 1, 1) == 5 and o.number("none", 7, 1) == 7
    with pytest.raises(OptionError, match="The value of 'n' must be 1 or greater."):
        o.number("n", 100, 1)
    with pytest.raises(OptionError, match="must be numeric"):
        Options(o.values, {"m": "--batch"}).number("m", 100)


def test_families_and_exclusion():
    o = Options.of({"read.vars.a": "1", "read.vars.b": "2", "write.graph": "x", "write.graphOverride": "y"})
    assert o.family("read.vars.") == {"a": "1", "b": "2"}
    with pytest.raises(OptionError):
        o.exclusive("write.graph", "write.graphOverride")


def test_names():
    assert names.qualified("s", "v", "c") == "s.v.c" and names.qualified("", "v", "c") == "v.c" and names.qualified("", "", "c") == "c"
    assert names.parts("`a.b`.c") == ("a", "b", "c") and names.parts("c") == ("", "", "c")
    assert names.resolve(["t.v.x", "t.v.y"], "v.x") == "t.v.x" and names.quoted("a.b") == "`a.b`"
    with pytest.raises(ValueError, match="ambiguous"):
        names.resolve(["t.v.x", "t.w.x"], "x")


@pytest.mark.parametrize(("partitions", "batch"), [(1, 0), (1, 5), (2, 0), (2, 7), (3, 4), (4, 15), (5, 1), (16, 1), (40, 3)])
def test_buckets_tile_the_row_ids(partitions, batch):
    flat = [b for p in plan(partitions, batch, 15) for b in p.buckets]
    assert flat[0].lower == 0 and flat[-1].upper == LARGEST
    assert all(a.upper + 1 == b.lower for a, b in zip(flat, flat[1:], strict=False))


def test_buckets_of_no_rows_and_merged():
    assert plan(4, 100, 0) == []
    assert Partition((Bucket(0, 4), Bucket(5, 9))).merged() == Partition((Bucket(0, 9),))


def test_shapes():
    assert kind_of(FILE) == "file" and kind_of(TRIPLE) == "triple" and kind_of(DOCUMENT) == "document"
    from pyspark.sql.types import StructType

    assert kind_of(StructType([*DOCUMENT.fields, *TRIPLE.fields])) == "document" and kind_of(StructType(TRIPLE.fields[:3])) == "row"


@pytest.mark.parametrize("template", ["/a{b", "/a}b", "/{}x", "/{a{b}}"])
def test_bad_templates(template):
    with pytest.raises(OptionError):
        uris.template_parts(template)


def test_replace_pairs():
    assert uris.replace_pairs(r".*/data,'',\.x$,'.y'") == [(".*/data", ""), (r"\.x$", ".y")]
    with pytest.raises(OptionError):
        uris.replace_pairs("only-a-pattern")


def test_permissions():
    assert metadata.permissions("a,read, a,UPDATE,b,node-update") == {"a": ["read", "update"], "b": ["node-update"]}
    with pytest.raises(OptionError, match="not a capability"):
        metadata.permissions("a,fly")
    with pytest.raises(OptionError, match="pairs"):
        metadata.permissions("a,read,b")


def test_metadata_xml_round_trip():
    row = {"collections": ["a", "b"], "permissions": {"r": ["read", "update"]}, "quality": 3, "properties": "<p><x>1</x></p>", "metadataValues": {"k": "v & w"}}
    assert metadata.from_xml(metadata.to_xml(row)) == row


def test_pointers():
    assert json_path("/a/0/b~1c") == "$['a'][0]['b/c']" and json_path("") == "$"
    doc = "<r xmlns:n='urn:n'><n:a id='1'>x<b>y</b></n:a><n:a>z</n:a></r>"
    assert xpath_values(doc, "/r/m:a", {"m": "urn:n"}) == ["xy", "z"] and xpath_values(doc, "/r/m:a/@id", {"m": "urn:n"}) == ["1"]
    assert xpath_values(doc, "//b/text()", {}) == ["y"]
