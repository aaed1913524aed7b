"""RDF syntaxes without a library: N-Triples, N-Quads, Turtle, TriG, N3's Turtle part, RDF/XML, RDF/JSON and TriX; and writers."""

from __future__ import annotations

import gzip
import io
import hashlib
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from urllib.parse import urljoin

#: Fixed values of the RDF and XSD vocabularies.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
XSD_STRING = XSD + "string"
LANG_STRING = RDF + "langString"
XML_NS = "{http://www.w3.org/XML/1998/namespace}"
#: What a blank node's label follows in a row.
BLANK = "http://docloom.dev/blank/"
#: Fixed value: the graph of quads that name none.
DEFAULT_GRAPH = "urn:x-arq:DefaultGraphNode"

QUADS = {"nq": "nquads", "trig": "trig", "trix": "trix"}
TRIPLES = {"nt": "ntriples", "ttl": "turtle", "n3": "turtle", "rdf": "rdfxml", "xml": "rdfxml", "owl": "rdfxml", "json": "rdfjson", "rj": "rdfjson"}
REFUSED = {"thrift", "trdf", "rt", "binpb", "pbrdf", "rpb"}


class RdfError(ValueError):
    pass


class Iri(NamedTuple):
    value: str


class Blank(NamedTuple):
    label: str


class Literal(NamedTuple):
    value: str
    datatype: str | None = None
    lang: str | None = None


Term = Iri | Blank | Literal


def row(s: Term, p: Term, o: Term, g: Term | None, quads: bool, scope: str = "") -> dict:
    """A triple as a row: a literal's language makes its datatype langString, none makes it xsd:string; IRIs and blank nodes have no datatype.

    A blank node's label holds in one file alone, so ``scope``, which names the file, goes before it."""

    def name(t: Term) -> str:
        return BLANK + scope + t.label if isinstance(t, Blank) else t.value

    datatype = lang = None
    if isinstance(o, Literal):
        lang, datatype = o.lang, LANG_STRING if o.lang else o.datatype or XSD_STRING
    graph = name(g) if g is not None else DEFAULT_GRAPH if quads else None
    return {"subject": name(s), "predicate": name(p), "object": name(o), "datatype": datatype, "lang": lang, "graph": graph}


def syntax_of(name: str) -> tuple[str, bool]:
    """(syntax, whether it has graphs) by a file's extension; Turtle where it says nothing."""
    ext = re.sub(r"\.(gz|gzip)$", "", name.lower()).rpartition(".")[2]
    if ext in REFUSED:
        raise RdfError(f"RDF files of type {ext} are not supported")
    return (QUADS[ext], True) if ext in QUADS else (TRIPLES.get(ext, "turtle"), False)


def scope_of(path: str, entry: str = "") -> str:
    """What tells the blank nodes of one file, or of one entry of a zip, from those of others."""
    return "f" + hashlib.sha256(f"{path}\n{entry}".encode("utf-8", "surrogateescape")).hexdigest()[:16] + "-"


def parse(name: str, content: bytes, scope: str = "") -> Iterator[dict]:
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    syntax, quads = syntax_of(name)
    reader = {"ntriples": _lines, "nquads": _lines, "turtle": _turtle, "trig": _turtle, "rdfxml": _rdfxml, "rdfjson": _rdfjson, "trix": _trix}[syntax]
    for s, p, o, g in reader(content):
        yield row(s, p, o, g, quads, scope)


_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def unescaped(text: str) -> str:
    return re.sub(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _ESCAPES.get(m[3], m[3]), text, flags=re.DOTALL) if "\\" in text else text


_NT = re.compile(r'\s*(?:<(?P<iri>[^<>"{}|^`\x00-\x20]*)>|_:(?P<blank>[^\s<>"]+?)(?=[\s<]|\.\s*$|$)|"(?P<text>(?:[^"\\\n]|\\.)*)"(?:\^\^<(?P<type>[^>]*)>|@(?P<lang>[A-Za-z]+(?:-[A-Za-z0-9]+)*))?)')


def _lines(content: bytes) -> Iterator[tuple]:
    for n, line in enumerate(content.decode().splitlines(), 1):
        text = line.strip()
        if not text or text.startswith("#"):
            continue
        terms, at = [], 0
        while m := _NT.match(text, at):
            at = m.end()
            if m["iri"] is not None:
                terms.append(Iri(unescaped(m["iri"])))
            elif m["blank"]:
                terms.append(Blank(m["blank"]))
            else:
                terms.append(Literal(unescaped(m["text"]), m["type"], m["lang"]))
        if len(terms) not in (3, 4) or not re.fullmatch(r"\s*\.\s*(#.*)?", text[at:]):
            raise RdfError(f"line {n} is not a statement: {text[:80]}")
        yield (*terms[:3], terms[3] if len(terms) == 4 else None)


_TTL = re.compile(
    r"""(?P<skip>[\s]+|\#[^\n]*)
    |<(?P<iri>[^<>"{}|^`\x00-\x20]*)>
    |(?P<long>\"\"\"(?:\"{0,2}(?:[^"\\]|\\.))*\"\"\"|'''(?:'{0,2}(?:[^'\\]|\\.))*''')
    |(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<type>\^\^)
    |_:(?P<blank>[\w\u00b7-]+(?:\.+[\w\u00b7-]+)*)
    |(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))(?![\w:])
    |(?P<name>[\w-]*(?:\.+[\w-]+)*:(?:(?:[\w:-]|%[0-9A-Fa-f]{2}|\\[_~.!$&'()*+,;=/?\#@%-])|\.(?=[\w:%\\.-]*[\w:%-]))*)
    |(?P<word>[A-Za-z]+)
    |(?P<mark>[.;,\[\](){}])""",
    re.VERBOSE | re.DOTALL,
)


class _turtle:  # noqa: N801
    """Statements of a Turtle or TriG document."""

    def __init__(self, content: bytes):
        text, at = content.decode("utf-8-sig"), 0
        self.tokens: list[tuple[str, str]] = []
        while at < len(text):
            m = _TTL.match(text, at)
            if not m or m.end() == at:
                self.tokens.append(("bad", text[at : at + 30]))  # an error only when it is reached: what stands before is read
                break
            at = m.end()
            if m.lastgroup != "skip":
                self.tokens.append((m.lastgroup, m[m.lastgroup]))
        self.pos, self.prefixes, self.base, self.count = 0, {}, "", 0

    def peek(self) -> tuple[str, str]:
        token = self.tokens[self.pos] if self.pos < len(self.tokens) else ("end", "")
        if token[0] == "bad":
            raise RdfError(f"can't read {token[1]!r}")
        return token

    def take(self, mark: str | None = None) -> tuple[str, str]:
        token = self.peek()
        if mark is not None and token != ("mark", mark):
            raise RdfError(f"expected {mark!r}, found {token[1]!r}")
        self.pos += 1
        return token

    def fresh(self) -> Blank:
        self.count += 1
        return Blank(f"b{self.count}")

    def iri(self, text: str) -> Iri:
        text = unescaped(text)
        return Iri(urljoin(self.base, text) if self.base else text)

    def named(self, text: str) -> Iri:
        prefix, _, name = text.partition(":")
        if prefix not in self.prefixes:
            raise RdfError(f"unknown prefix {prefix}:")
        return Iri(self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", name))

    def __iter__(self) -> Iterator[tuple]:
        while self.peek()[0] != "end":
            kind, word = self.peek()
            if (kind, word.lower()) in (("at", "@prefix"), ("word", "prefix")):
                self.take()
                name = self.take()[1]
                self.prefixes[name.removesuffix(":")] = self.iri(self.take()[1]).value
                if kind == "at":
                    self.take(".")
            elif (kind, word.lower()) in (("at", "@base"), ("word", "base")):
                self.take()
                self.base = self.iri(self.take()[1]).value
                if kind == "at":
                    self.take(".")
            elif (kind, word) == ("mark", "{"):
                yield from self.block(None)
            elif (kind, word.upper()) == ("word", "GRAPH"):
                self.take()
                yield from self.block(self.term([], None))
            else:
                out: list[tuple] = []
                subject = self.term(out, None)
                if self.peek() == ("mark", "{"):
                    yield from self.block(subject)
                    continue
                if self.peek() != ("mark", "."):
                    self.predicates(subject, out, None)
                self.take(".")
                yield from out

    def block(self, graph: Term | None) -> Iterator[tuple]:
        self.take("{")
        while self.peek() != ("mark", "}"):
            out: list[tuple] = []
            subject = self.term(out, graph)
            if self.peek() not in (("mark", "."), ("mark", "}")):
                self.predicates(subject, out, graph)
            if self.peek() == ("mark", "."):
                self.take()
            yield from out
        self.take("}")
        if self.peek() == ("mark", "."):
            self.take()

    def predicates(self, subject: Term, out: list[tuple], graph: Term | None) -> None:
        while True:
            kind, word = self.peek()
            if (kind, word) == ("word", "a"):
                self.take()
                predicate: Term = Iri(RDF + "type")
            else:
                predicate = self.term(out, graph)
            while True:
                out.append((subject, predicate, self.term(out, graph), graph))
                if self.peek() != ("mark", ","):
                    break
                self.take()
            while self.peek() == ("mark", ";"):
                self.take()
                again = True
            else:
                again = self.tokens[self.pos - 1] == ("mark", ";")
            if not again or self.peek() in (("mark", "."), ("mark", "]"), ("mark", "}")):
                return

    def term(self, out: list[tuple], graph: Term | None) -> Term:
        kind, word = self.take()
        if kind == "iri":
            return self.iri(word)
        if kind == "name":
            return self.named(word)
        if kind == "blank":
            return Blank(word)
        if kind in ("text", "long"):
            value = unescaped(word[3:-3] if kind == "long" else word[1:-1])
            if self.peek()[0] == "at":
                return Literal(value, None, self.take()[1][1:])
            if self.peek()[0] == "type":
                self.take()
                return Literal(value, self.term(out, graph).value)
            return Literal(value)
        if kind == "number":
            return Literal(word, XSD + ("double" if "e" in word.lower() else "decimal" if "." in word else "integer"))
        if kind == "word" and word in ("true", "false"):
            return Literal(word, XSD + "boolean")
        if (kind, word) == ("mark", "["):
            node = self.fresh()
            if self.peek() != ("mark", "]"):
                self.predicates(node, out, graph)
            self.take("]")
            return node
        if (kind, word) == ("mark", "("):
            items = []
            while self.peek() != ("mark", ")"):
                items.append(self.term(out, graph))
            self.take(")")
            rest: Term = Iri(RDF + "nil")
            for item in reversed(items):
                node = self.fresh()
                out += [(node, Iri(RDF + "first"), item, graph), (node, Iri(RDF + "rest"), rest, graph)]
                rest = node
            return rest
        raise RdfError(f"unexpected {word!r}")


def _rdfxml(content: bytes) -> Iterator[tuple]:
    root = ET.fromstring(content)
    count = 0

    def fresh() -> Blank:
        nonlocal count
        count += 1
        return Blank(f"x{count}")

    def iri(tag: str) -> Iri:
        return Iri(tag[1:].replace("}", "", 1) if tag.startswith("{") else tag)

    r = lambda n: f"{{{RDF}}}{n}"
    syntax = {r(n) for n in ("about", "ID", "nodeID", "resource", "datatype", "parseType", "type")}

    def node(e: ET.Element, base: str, lang: str | None) -> Iterator:
        base, lang = e.get(XML_NS + "base", base), e.get(XML_NS + "lang", lang)
        if e.get(r("about")) is not None:
            subject: Term = Iri(urljoin(base, e.get(r("about"))))
        elif e.get(r("ID")) is not None:
            subject = Iri(urljoin(base, "#" + e.get(r("ID"))))
        else:
            subject = Blank(e.get(r("nodeID"))) if e.get(r("nodeID")) else fresh()
        yield subject
        if e.tag != r("Description"):
            yield subject, Iri(RDF + "type"), iri(e.tag), None
        yield from attributes(e, subject, base, lang)
        nth = 0
        for p in e:
            nth += p.tag == r("li")
            yield from prop(p, subject, Iri(f"{RDF}_{nth}") if p.tag == r("li") else iri(p.tag), base, lang)

    def attributes(e, subject, base, lang):
        if e.get(r("type")):
            yield subject, Iri(RDF + "type"), Iri(urljoin(base, e.get(r("type")))), None
        for k, v in e.attrib.items():
            if k not in syntax and not k.startswith(XML_NS) and k.startswith("{"):
                yield subject, iri(k), Literal(v, None, lang), None

    def nested(e, base, lang, out):
        found = node(e, base, lang)
        subject = next(found)
        out.extend(found)
        return subject

    def prop(p, subject, predicate, base, lang):
        base, lang = p.get(XML_NS + "base", base), p.get(XML_NS + "lang", lang)
        kind, out = p.get(r("parseType")), []
        if kind == "Literal":
            value: Term = Literal((p.text or "") + "".join(ET.tostring(c, encoding="unicode") for c in p), RDF + "XMLLiteral")
        elif kind == "Resource":
            value = fresh()
            for c in p:
                out.extend(prop(c, value, iri(c.tag), base, lang))
        elif kind == "Collection":
            value = Iri(RDF + "nil")
            for c in reversed(list(p)):
                item, cell = nested(c, base, lang, out), fresh()
                out += [(cell, Iri(RDF + "first"), item, None), (cell, Iri(RDF + "rest"), value, None)]
                value = cell
        elif p.get(r("resource")) is not None:
            value = Iri(urljoin(base, p.get(r("resource"))))
            out.extend(attributes(p, value, base, lang))
        elif p.get(r("nodeID")) is not None:
            value = Blank(p.get(r("nodeID")))
        elif len(p):
            value = nested(p[0], base, lang, out)
        elif any(k not in syntax and k.startswith("{") and not k.startswith(XML_NS) for k in p.attrib):
            value = fresh()
            out.extend(attributes(p, value, base, lang))
        else:
            value = Literal(p.text or "", p.get(r("datatype")), None if p.get(r("datatype")) else lang)
        yield subject, predicate, value, None
        yield from out

    for e in root if root.tag == r("RDF") else [root]:
        found = node(e, root.get(XML_NS + "base", ""), root.get(XML_NS + "lang"))
        next(found)
        yield from found


def _rdfjson(content: bytes) -> Iterator[tuple]:
    name = lambda t: Blank(t[2:]) if t.startswith("_:") else Iri(t)
    for s, predicates in json.loads(content).items():
        for p, objects in predicates.items():
            for o in objects:
                value = Literal(o["value"], o.get("datatype"), o.get("lang")) if o["type"] == "literal" else name(o["value"])
                yield name(s), Iri(p), value, None


def _trix(content: bytes) -> Iterator[tuple]:
    local = lambda e: e.tag.rpartition("}")[2]

    def term(e) -> Term:
        text = e.text or ""
        kind = local(e)
        if kind == "uri":
            return Iri(text.strip())
        if kind == "id":
            return Blank(text.strip())
        return Literal(text, e.get("datatype"), e.get(XML_NS + "lang"))

    depth, root, graph, named, waiting = 0, None, None, None, []
    for event, e in ET.iterparse(io.BytesIO(content), ("start", "end")):
        if event == "start":
            depth += 1
            if depth == 1:
                root = e
            elif depth == 2:
                graph, named = e, None
            continue
        if depth == 3:
            if named is None and local(e) in ("uri", "id"):
                named = term(e)
            elif local(e) == "triple":
                waiting.append(tuple(map(term, e)))
            graph.clear()
        if waiting and (depth == 2 or depth == 3 and named is not None):  # a graph's name may come after its triples
            yield from ((s, p, o, named) for s, p, o in waiting)
            waiting = []
        if depth == 2:
            root.clear()
        depth -= 1


# writing


def _escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t")


def term_text(value: str, datatype: str | None = None, lang: str | None = None) -> str:
    """A row's value in N-Triples form."""
    if lang:
        return f'"{_escape(value)}"@{lang}'
    if datatype:
        return f'"{_escape(value)}"' + ("" if datatype == XSD_STRING else f"^^<{datatype}>")
    return f"_:{value.removeprefix(BLANK)}" if value.startswith(BLANK) else f"<{value}>"


def statement(r: dict) -> str:
    return f"{term_text(r['subject'])} {term_text(r['predicate'])} {term_text(r['object'], r.get('datatype'), r.get('lang'))}"


def serialized(rows: Iterable[dict], syntax: str = "ttl", graph: str | None = None) -> bytes:
    """Rows in ttl, nt, trig, nq or trix; graphs are kept where the syntax has them; ``graph`` replaces them."""
    rows = [dict(r) | ({"graph": graph} if graph else {}) for r in rows]
    if syntax == "nt":
        return "".join(statement(r) + " .\n" for r in rows).encode()
    if syntax == "nq":
        return "".join(statement(r) + (f" {term_text(r['graph'])}" if r.get("graph") else "") + " .\n" for r in rows).encode()
    if syntax == "trix":
        return _trix_text(rows)
    if syntax not in ("ttl", "trig"):
        raise RdfError(f"can't write RDF as {syntax}")

    def turtle(some: list[dict], indent: str) -> str:
        by: dict[str, list[str]] = {}
        for r in some:
            by.setdefault(term_text(r["subject"]), []).append(f"{term_text(r['predicate'])} {term_text(r['object'], r.get('datatype'), r.get('lang'))}")
        return "".join(f"{indent}{s} {(' ;' + chr(10) + indent + '    ').join(dict.fromkeys(po))} .\n" for s, po in by.items())

    if syntax == "ttl":
        return turtle(rows, "").encode()
    graphs: dict[str | None, list[dict]] = {}
    for r in rows:
        graphs.setdefault(r.get("graph"), []).append(r)
    return "".join(turtle(rs, "") if g is None else f"{term_text(g)} {{\n{turtle(rs, '    ')}}}\n" for g, rs in graphs.items()).encode()


def _trix_text(rows: list[dict]) -> bytes:
    root = ET.Element("TriX", xmlns="http://www.w3.org/2004/03/trix/trix-1/")
    graphs: dict[str | None, ET.Element] = {}

    def add(parent, value, datatype=None, lang=None):
        if datatype or lang:
            typed = bool(datatype) and datatype not in (XSD_STRING, LANG_STRING)
            e = ET.SubElement(parent, "typedLiteral" if typed else "plainLiteral")
            if typed:
                e.set("datatype", datatype)
            elif lang:
                e.set("xml:lang", lang)
            e.text = value
        elif value.startswith(BLANK):
            ET.SubElement(parent, "id").text = value.removeprefix(BLANK)
        else:
            ET.SubElement(parent, "uri").text = value

    for r in rows:
        g = r.get("graph")
        if g not in graphs:
            graphs[g] = ET.SubElement(root, "graph")
            if g:
                add(graphs[g], g)
        t = ET.SubElement(graphs[g], "triple")
        add(t, r["subject"])
        add(t, r["predicate"])
        add(t, r["object"], r.get("datatype"), r.get("lang"))
    return ET.tostring(root, encoding="utf-8", xml_declaration=True)
