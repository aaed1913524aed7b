"""Readers of one file's bytes: generators of document rows, or of triples, without Spark.

A document row is a dict with the document columns that are known. An item that can't be read raises ReadError, or with
``tolerant`` is passed over: a bad element alone, or what is left of a bad file.
"""

from __future__ import annotations

import gzip
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from xml.parsers import expat
from xml.sax.saxutils import quoteattr

from ..functions.metadata import from_xml, local

FORMATS = {"json": "JSON", "xml": "XML", "txt": "TEXT", "text": "TEXT"}


class ReadError(ValueError):
    pass


def decoded(content: bytes, encoding: str | None) -> bytes:
    """Bytes of another encoding as UTF-8."""
    return content if not encoding or encoding.lower().replace("-", "") == "utf8" else content.decode(encoding).encode()


def generic(path: str, content: bytes, encoding: str | None = None) -> Iterator[dict]:
    yield {"URI": path, "content": decoded(content, encoding)}


def gzipped(path: str, content: bytes, encoding: str | None = None) -> Iterator[dict]:
    yield {"URI": re.sub(r"\.(gz|gzip)$", "", path), "content": decoded(gzip.decompress(content), encoding)}


def zip_entries(content: bytes) -> Iterator[tuple[str, bytes]]:
    """The entries that are files; bytes that are no zip have none."""
    if not zipfile.is_zipfile(io.BytesIO(content)):
        return
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for info in z.infolist():
            if not info.is_dir():
                yield info.filename, z.read(info)


def zipped(path: str, content: bytes, encoding: str | None = None) -> Iterator[dict]:
    for name, data in zip_entries(content):
        yield {"URI": f"{path}/{name}", "content": decoded(data, encoding)}


_ENTRY = re.compile(r"^(.*?)(?:\.(JSON|XML|TEXT|BINARY|UNKNOWN))?\.metadata$", re.DOTALL)


def archive(path: str, content: bytes, categories: tuple[str, ...] = (), encoding: str | None = None) -> Iterator[dict]:
    """Documents with metadata. An entry ``uri.FORMAT.metadata`` comes before its document; ``uri.metadata`` of older archives after it."""
    waiting: dict | None = None
    older: bool | None = None
    for name, data in zip_entries(content):
        m = _ENTRY.match(name)
        if older is None:
            older = m is None
        if older:
            if m is None:
                if waiting:
                    yield waiting
                waiting = {"URI": name, "content": decoded(data, encoding)}
            elif waiting is None or m[1] != waiting["URI"]:
                raise ReadError(f"Could not find metadata for {waiting['URI'] if waiting else m[1]} in {path}")
            else:
                yield waiting | _wanted(from_xml(data.decode()), categories)
                waiting = None
        elif m:
            if waiting:  # the one before had metadata alone
                yield waiting
            waiting = {"URI": m[1], "content": None, "format": m[2]} | _wanted(from_xml(data.decode()), categories)
        elif waiting is not None:
            yield waiting | {"URI": name, "content": decoded(data, encoding), "format": waiting["format"] or _format(name)}
            waiting = None
        else:
            raise ReadError(f"Could not find metadata for {name} in {path}")
    if waiting:
        yield waiting


def _format(name: str) -> str | None:
    return FORMATS.get(name.rpartition(".")[2].lower())


def _wanted(metadata: dict, categories: tuple[str, ...]) -> dict:
    if not categories or "metadata" in categories:
        return metadata
    columns = {"metadatavalues": "metadataValues"}
    kept = {columns.get(c, c) for c in categories}
    return {k: v if k in kept else None for k, v in metadata.items()}


def bulk_archive(path: str, content: bytes, categories: tuple[str, ...] = (), encoding: str | None = None) -> Iterator[dict]:
    """Archives of the bulk loader: each document's ``.metadata`` entry first; ``.naked`` entries are metadata alone."""
    waiting: dict | None = None
    for name, data in zip_entries(content):
        if name.endswith(".metadata"):
            waiting = bulk_metadata(data.decode(), categories)
            if name.endswith(".naked.metadata"):
                yield {"URI": name.removesuffix(".naked.metadata"), "content": None} | waiting
                waiting = None
        elif name.endswith(".naked"):
            yield {"URI": name.removesuffix(".naked"), "content": None} | bulk_metadata(data.decode(), categories)
        else:
            yield {"URI": name, "content": decoded(data, encoding)} | (waiting or {})
            waiting = None


def bulk_metadata(text: str, categories: tuple[str, ...] = ()) -> dict:
    """Their metadata XML: collections, quality, properties, values, and permissions whose role ids are named in a list of their own."""
    root = ET.fromstring(text)
    flat = {local(e): e for e in root}
    out: dict = dict.fromkeys(("collections", "permissions", "quality", "properties", "metadataValues", "format"))
    if (e := flat.get("format")) is not None:
        name = next((local(x) for x in e.iter() if x is not e), None) or e.text
        out["format"] = (name or "").upper() or None
    if (e := flat.get("collectionsList")) is not None:
        out["collections"] = [x.text or "" for x in e] or None
    if (e := flat.get("quality")) is not None and (e.text or "").strip():
        out["quality"] = int(e.text)
    if (e := flat.get("properties")) is not None and len(e):
        out["properties"] = ET.tostring(e[0], encoding="unicode")
    if (e := flat.get("meta")) is not None:
        out["metadataValues"] = {(x.get("key") or local(x)): x.text or "" for x in e} or None
    names = {x.findtext("{*}role-id"): x.findtext("{*}role-name") for x in root.iter() if x.find("{*}role-id") is not None and x.find("{*}role-name") is not None}
    given: dict[str, list[str]] = {}
    for x in root.iter():
        cap, role = x.find("{*}capability"), x.find("{*}role-id")
        if cap is not None and role is not None:
            given.setdefault(x.findtext("{*}role-name") or names.get(role.text) or role.text, []).append((cap.text or "").lower())
    out["permissions"] = given or None
    fmt = out.pop("format")
    return _wanted(out, categories) | {"format": fmt}


def json_lines(path: str, content: bytes, encoding: str | None = None) -> Iterator[dict]:
    """A document for each line, as it stands, numbered from 1; compressed files are recognised."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    for n, line in enumerate(decoded(content, encoding).splitlines(), 1):
        if line.strip():
            yield {"URI": f"{path}-{n}.json", "content": line, "format": "JSON"}


def aggregate_xml(
    path: str, content: bytes, element: str, namespace: str | None = None, uri_element: str | None = None, uri_namespace: str | None = None, encoding: str | None = None, tolerant: bool = False, prefix: str | None = None
) -> Iterator[dict]:
    """A document for each element of a name, as its bytes stand, at any depth but not inside another such one. Its URI is the text of the first
    ``uri_element`` inside it, or the path and a number from 1."""
    wanted = f"{namespace}\n{element}" if namespace else element
    uri_tag = (f"{{{uri_namespace}}}{uri_element}" if uri_namespace else uri_element) if uri_element else None
    content = decoded(content, encoding)
    found: list[tuple[int, int, dict[str, str]]] = []  # where each element begins and ends, and the prefixes that hold there
    scopes: list[dict[str, str]] = [{}]
    fresh: dict[str, str] = {}
    begin, depth, source = 0, 0, "utf-8"
    parser = expat.ParserCreate(namespace_separator="\n")
    parser.buffer_text = True

    def declared(_version, encoding_, _standalone):
        nonlocal source
        source = encoding_ or source

    def opened(name, _attributes):
        nonlocal begin, depth
        scopes.append(scopes[-1] | fresh if fresh else scopes[-1])
        fresh.clear()
        if name == wanted:
            if not depth:
                begin = parser.CurrentByteIndex
            depth += 1

    def closed(name):
        nonlocal depth
        here = scopes.pop()
        if name == wanted:
            depth -= 1
            if not depth:
                at = parser.CurrentByteIndex
                found.append((begin, content.index(b">", at) + 1 if content.startswith(b"</", at) else at, here))

    parser.XmlDeclHandler, parser.StartElementHandler, parser.EndElementHandler = declared, opened, closed
    parser.StartNamespaceDeclHandler = lambda p, u: fresh.__setitem__(p or "", u or "")
    problem = None
    try:
        parser.Parse(content, True)
    except expat.ExpatError as e:
        problem = e
    for n, (a, b, scope) in enumerate(found, 1):
        text = content[a:b].decode(source).encode()
        uri = f"{prefix or path}-{n}.xml"
        if uri_tag:
            inner = next(ET.fromstring(_standing(text, scope)).iter(uri_tag), None)
            if inner is None:
                if tolerant:
                    continue
                raise ReadError(f"No occurrence of URI element {uri_element} found in aggregate element {n} in file {path}")
            uri = "".join(inner.itertext())
        yield {"URI": uri, "content": _standing(text, scope), "format": "XML"}
    if problem is not None and not tolerant:
        raise ReadError(f"Unable to read XML from {path}: {problem}") from problem


def _standing(element: bytes, scope: dict[str, str]) -> bytes:
    """The element as it stands in its file, with the prefixes declared that it uses and only elements around it declare."""
    head = re.match(rb"<[^\s/>]+", element)
    tag = re.match(rb"""<(?:[^"'>]|"[^"]*"|'[^']*')*>""", element)[0]
    missing = b""
    for name, uri in scope.items():
        key = b"xmlns:" + name.encode() if name else b"xmlns"
        used = re.search(rb"[</\s]" + name.encode() + b":", element) if name else uri
        if used and name != "xml" and not re.search(rb"\s" + re.escape(key) + rb"\s*=", tag):
            missing += b" " + key + b"=" + quoteattr(uri).encode()
    return element[: head.end()] + missing + element[head.end() :]


def zipped_aggregate_xml(path: str, content: bytes, **options) -> Iterator[dict]:
    for entry, (_name, data) in enumerate(zip_entries(content), 1):
        yield from aggregate_xml(path, data, prefix=f"{path}-{entry}", **options)
