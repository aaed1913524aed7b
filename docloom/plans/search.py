"""Document search: string, structured, serialized and combined queries become one tree, and the tree a column.

Supported: terms, phrases, OR, implicit AND, NOT, trailing wildcards, word and property-word queries, collections, directories, URIs
and named constraints. Anything else is refused.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import uris
from ..options import Options


class SearchError(ValueError):
    pass


@dataclass(frozen=True)
class Word:
    """A word or phrase, in one JSON property or XML element if one is named."""

    text: str
    within: str | None = None


@dataclass(frozen=True)
class Both:
    parts: tuple


@dataclass(frozen=True)
class Either:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: Any


@dataclass(frozen=True)
class In:
    """kind: collection, directory or uri."""

    kind: str
    names: tuple[str, ...]


@dataclass(frozen=True)
class Constraints:
    """Named constraints of string queries: name -> (kind, target); kind is word, collection or directory."""

    named: dict[str, tuple[str, str]] = field(default_factory=dict)


_TERM = re.compile(r'\s*(?:(?P<open>\()|(?P<close>\))|(?:(?P<name>[\w-]+):)?(?:"(?P<phrase>[^"]*)"|(?P<word>[^\s()"]+)))')


def string_query(text: str, constraints: Constraints = Constraints()):
    """``a b OR c -d name:value "a phrase"``: AND binds closer than OR."""
    tokens = []
    at = 0
    while at < len(text.rstrip()):
        m = _TERM.match(text, at)
        if not m:
            raise SearchError(f"can't read the query at {at}")
        at = m.end()
        tokens.append(m)
    pos = 0

    def either():
        nonlocal pos
        parts = [both()]
        while pos < len(tokens) and tokens[pos]["word"] == "OR" and not tokens[pos]["name"]:
            pos += 1
            parts.append(both())
        return parts[0] if len(parts) == 1 else Either(tuple(parts))

    def both():
        nonlocal pos
        parts = []
        while pos < len(tokens) and not tokens[pos]["close"] and not (tokens[pos]["word"] == "OR" and not tokens[pos]["name"]):
            m = tokens[pos]
            pos += 1
            if m["word"] in ("AND",) and not m["name"]:
                continue
            if m["word"] == "NOT" and not m["name"]:
                parts.append(Not(one()))
            else:
                pos -= 1
                parts.append(one())
        return parts[0] if len(parts) == 1 else Both(tuple(parts))

    def one():
        nonlocal pos
        m = tokens[pos]
        pos += 1
        if m["open"]:
            inner = either()
            if pos >= len(tokens) or not tokens[pos]["close"]:
                raise SearchError("a parenthesis is not closed")
            pos += 1
            return inner
        text = m["phrase"] if m["phrase"] is not None else m["word"]
        if m["name"] and m["name"] in constraints.named:
            kind, target = constraints.named[m["name"]]
            return Word(text, target) if kind == "word" else In(kind, (text,))
        if m["name"]:
            return Word(f"{m['name']} {text}")
        if m["phrase"] is None and text.startswith("-") and len(text) > 1:
            return Not(Word(text[1:]))
        return Word(text)

    if not tokens:
        return Both(())
    found = either()
    if pos != len(tokens):
        raise SearchError("a parenthesis is not opened")
    return found


def _list(value) -> list:
    return value if isinstance(value, list) else [] if value is None else [value]


def structured_query(text: str):
    """A structured or serialized query, JSON if it starts with a brace, else XML."""
    text = text.strip()
    if text.startswith("{"):
        found = json.loads(text)
        found = found.get("search", found)
        parts = [string_query(found["qtext"])] if found.get("qtext") else []
        inner = found.get("query", found.get("ctsquery"))
        if inner is None and not parts:
            inner = found
        if inner is not None:
            parts += [_json(q) for q in (_list(inner["queries"]) if "queries" in inner else [inner])]
        return parts[0] if len(parts) == 1 else Both(tuple(parts))
    root = ET.fromstring(text)
    local = lambda e: e.tag.rpartition("}")[2]
    if local(root) == "search":
        parts = [string_query(e.text or "") for e in root if local(e) == "qtext"] + [_xml(q) for e in root if local(e) == "query" for q in e]
        return parts[0] if len(parts) == 1 else Both(tuple(parts))
    if local(root) == "query":
        parts = [_xml(q) for q in root]
        return parts[0] if len(parts) == 1 else Both(tuple(parts))
    return _xml(root)


def _json(query: dict):
    kinds = [k for k in query if k not in ("options", "weight")]
    if len(kinds) != 1:
        raise SearchError(f"one kind of query is expected, found {kinds}")
    kind, body = kinds[0], query[kinds[0]]
    name = re.sub(r"([a-z])([A-Z])", r"\1-\2", kind).lower().removesuffix("-query")
    body = body if isinstance(body, dict) else {"text": body}
    if name in ("and", "or"):
        parts = tuple(_json(q) for q in _list(body.get("queries")))
        return Both(parts) if name == "and" else Either(parts)
    if name == "not":
        return Not(_json(body.get("query", body)))
    return _leaf(name, [str(t) for t in _list(body.get("text", body.get("value")))], [str(u) for u in _list(body.get("uri", body.get("uris")))], body.get("propertyName", body.get("property-name", body.get("json-property", body.get("element")))))


def _xml(e: ET.Element):
    local = lambda x: x.tag.rpartition("}")[2]
    name = local(e).removesuffix("-query")
    if name in ("and", "or"):
        parts = tuple(_xml(c) for c in e)
        return Both(parts) if name == "and" else Either(parts)
    if name == "not":
        return Not(_xml(e[0]))
    texts = [c.text or "" for c in e if local(c) in ("text", "value")]
    uris = [c.text or "" for c in e if local(c) == "uri"]
    within = next((c.get("name") or c.text for c in e if local(c) in ("json-property", "property", "element")), None)
    return _leaf(name, texts, uris, within)


def _leaf(name: str, texts: list[str], uris: list[str], within):
    within = _list(within)[0] if _list(within) else None
    if name in ("term", "word", "json-property-word", "element-word", "json-property-value", "element-value", "container"):
        if name.startswith(("json", "element")) and not within:
            raise SearchError(f"{name} needs a property")
        parts = tuple(Word(t, within) for t in texts)
        return parts[0] if len(parts) == 1 else Either(parts)
    if name in ("collection", "directory", "document"):
        return In({"document": "uri"}.get(name, name), tuple(uris))
    raise SearchError(f"{name} queries are not supported")


#: A character of a word, and one of none.
_IN, _OUT = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]"


def has_words(text: Column, wanted: str) -> Column:
    """Whether the words stand in the text one after the other; a trailing * in a word matches any ending.

    Words are runs of letters and digits, cases apart no difference. A text without the longest of the words is passed over before it is searched for all.
    """
    words = re.findall(r"[^\W_]+\*?", wanted.lower())
    if not words:
        return F.lit(True)
    low = F.lower(text)
    each = [f"{w[:-1]}{_IN}*+" if w.endswith("*") else w for w in words]
    return low.contains(max((w.rstrip("*") for w in words), key=len)) & low.rlike(f"(?<!{_IN}){f'{_OUT}++'.join(each)}(?!{_IN})")


def property_text(text: Column, name: str | Column) -> Column:
    """The texts of a JSON property or an XML element anywhere in a document, joined by spaces."""
    key = F.lit(re.escape(name)) if isinstance(name, str) else F.concat(F.lit(r"\Q"), name, F.lit(r"\E"))

    def pattern(*parts: str) -> Column:
        return F.concat(*[x for part in parts for x in (key, F.lit(part))][1:])

    as_json = F.regexp_extract_all(text, pattern('"', r'"\s*:\s*(?:"((?:[^"\\]++|\\.)*+)"|(-?[\w.]+))'), F.lit(0))
    as_xml = F.regexp_extract_all(text, pattern(r"(?s)<(?:\w+:)?", r"(?:\s[^>]*)?>(.*?)</(?:\w+:)?", ">"), F.lit(1))
    as_json = F.transform(as_json, lambda m: F.regexp_replace(m, pattern('^"', r'"\s*:\s*'), F.lit("")))
    return F.array_join(F.concat(as_json, as_xml), " ")


def plain_text(text: Column, kind: Column) -> Column:
    """A document's words: of JSON without the names of properties, of XML without those of elements, of any other format all."""
    kind = F.upper(kind)
    names = r'(?<!\\)"(?:[^"\\]++|\\.)*+"\s*+:'
    return F.when(kind == "JSON", F.regexp_replace(text, names, " ")).when(kind == "XML", F.regexp_replace(text, r"<[^>]*+>", " ")).otherwise(text)


def predicate(query, text: Column, uri: Column, collections: Column, kind: Column, filtered: bool = True) -> Column:
    """The tree as a column. Unfiltered, a property's words may stand anywhere in the document, as an index without properties would say."""

    def words(query: Word) -> Column:
        if query.within and filtered:
            return has_words(property_text(text, query.within), query.text)
        return has_words(plain_text(text, uris.format_of(uri, kind)), query.text)

    return condition(query, words, uri, collections)


def condition(query, words, uri: Column, collections: Column) -> Column:
    """The tree as a column, given one for each of its words or phrases."""
    again = lambda q: condition(q, words, uri, collections)
    if isinstance(query, Word):
        return words(query)
    if isinstance(query, Both):
        return reduce(lambda a, b: a & b, map(again, query.parts), F.lit(True))
    if isinstance(query, Either):
        return reduce(lambda a, b: a | b, map(again, query.parts), F.lit(False))
    if isinstance(query, Not):
        return ~again(query.part)
    if query.kind == "collection":
        return F.coalesce(F.arrays_overlap(collections, F.array(*[F.lit(n) for n in query.names])), F.lit(False))
    if query.kind == "directory":
        return reduce(lambda a, b: a | b, [uri.startswith(n if n.endswith("/") else n + "/") for n in query.names], F.lit(False))
    return uri.isin(*query.names)


def of_options(options: Options, constraints: Constraints = Constraints()):
    """The tree of the ``read.documents.*`` options; URIs replace every other condition but the string query."""
    text = options.text("read.documents.stringQuery")
    parts = [string_query(text, constraints)] if text else []
    if uris := options.lines("read.documents.uris"):
        return Both((*parts, In("uri", tuple(uris))))
    if query := options.text("read.documents.query"):
        parts.append(structured_query(query))
    if names := options.listed("read.documents.collections"):
        parts.append(In("collection", tuple(names)))
    if directory := options.text("read.documents.directory"):
        parts.append(In("directory", (directory,)))
    return Both(tuple(parts))


def matching(documents: DataFrame, query, filtered: bool = True) -> DataFrame:
    """Document rows that a tree selects."""
    return documents.filter(predicate(query, F.decode(F.coalesce("content", F.lit(b"")), "UTF-8"), F.col("URI"), F.col("collections"), F.col("format"), filtered))


def query_column(value) -> Column:
    """A query call inside a row query, over document rows."""
    from .dsl import Chain

    def tree(v):
        if not isinstance(v, Chain):
            return Word(str(v))
        call = v.calls[-1]
        if call.name in ("andQuery", "orQuery"):
            parts = tuple(tree(x) for x in (call.args[0] if call.args else []))
            return Both(parts) if call.name == "andQuery" else Either(parts)
        if call.name == "notQuery":
            return Not(tree(call.args[0]))
        listed = lambda x: tuple(x) if isinstance(x, list) else (x,)
        if call.name == "wordQuery":
            return Either(tuple(Word(t) for t in listed(call.args[0])))
        if call.name in ("jsonPropertyWordQuery", "jsonPropertyValueQuery", "elementWordQuery"):
            return Either(tuple(Word(str(t), call.args[0]) for t in listed(call.args[1])))
        if call.name in ("collectionQuery", "directoryQuery", "documentQuery"):
            return In({"collectionQuery": "collection", "directoryQuery": "directory", "documentQuery": "uri"}[call.name], listed(call.args[0]))
        raise SearchError(f"{call.name} is not supported")

    return predicate(tree(value), F.decode("content", "UTF-8"), F.col("URI"), F.col("collections"), F.col("format"))
