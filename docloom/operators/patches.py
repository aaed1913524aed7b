"""Vectors put into chunks that documents already hold, where they stand: JSON by pointer, XML by path."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from dataclasses import dataclass
from xml.parsers import expat
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metadata import local
from ..functions.pointers import local_path
from ..options import Options

CHUNK_NS = "http://docloom.dev/chunks"
_MISSING = object()


@dataclass(frozen=True)
class Places:
    """Where chunks and their texts are, and what the vector is called there."""

    chunks: str = "/chunks"
    text: str = "/text"
    chunks_path: str | None = None
    text_path: str | None = None
    name: str = "_vector"
    namespace: str = CHUNK_NS
    namespaces: tuple[tuple[str, str], ...] = ()

    @classmethod
    def of(cls, options: Options) -> Places:
        at = "write.embedder."
        return cls(
            options.text(f"{at}chunks.jsonPointer", "/chunks"), options.text(f"{at}text.jsonPointer", "/text"), options.text(f"{at}chunks.xpath"), options.text(f"{at}text.xpath"),
            options.text(f"{at}embedding.name", "_vector"), options.text(f"{at}embedding.namespace", CHUNK_NS), tuple(sorted(options.family("xpath.").items())),
        )


def at_pointer(value, pointer: str):
    """The value at a JSON Pointer, ``_MISSING`` if there is none."""
    for part in pointer.split("/")[1:] if pointer.startswith("/") else []:
        part = part.replace("~1", "/").replace("~0", "~")
        if isinstance(value, dict) and part in value:
            value = value[part]
        elif isinstance(value, list) and part.isdigit() and int(part) < len(value):
            value = value[int(part)]
        else:
            return _MISSING
    return value


def _shown(value) -> str:
    """A scalar as text; what is no scalar has none."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value) if isinstance(value, str | int | float) else ""


def json_chunks(document, places: Places) -> list[tuple[dict, str]]:
    """The chunk objects that have a text, and the text."""
    found = at_pointer(document, places.chunks)
    each = [c for c in (found if isinstance(found, list) else [found]) if isinstance(c, dict)]
    return [(c, t) for c in each if (t := _shown(at_pointer(c, places.text))).strip()]


def tree(content: bytes) -> tuple[ET.Element, dict[int, int]]:
    """The root element, and by element (its id) the byte at which its end tag begins."""
    parser, builder, ends = expat.ParserCreate(namespace_separator="}"), ET.TreeBuilder(), {}

    def tag(name: str) -> str:
        return "{" + name if "}" in name else name

    def end(name: str) -> None:
        ends[id(builder.end(tag(name)))] = parser.CurrentByteIndex

    parser.StartElementHandler = lambda name, attrs: builder.start(tag(name), {tag(k): v for k, v in attrs.items()})
    parser.EndElementHandler, parser.CharacterDataHandler = end, builder.data
    parser.Parse(content, True)
    return builder.close(), ends


def _selected(root: ET.Element, path: str, namespaces: dict[str, str], absolute: bool) -> list[ET.Element]:
    """Elements on a path of child and descendant steps; node() is any element."""
    path, last = local_path(path.replace("/node()", "/*"), namespaces)
    if last:
        raise ValueError(f"the path must select elements: {path}")
    if not absolute or not path.startswith("/"):
        return root.findall(path, namespaces)
    holder = ET.Element("holder")
    holder.append(root)
    return holder.findall("." + path, namespaces)


def xml_chunks(root: ET.Element, places: Places) -> list[tuple[ET.Element, str]]:
    """The chunk elements that have a text, and the text: by default the children of the root's ``chunks``, and their ``text``, in any namespace."""
    names = dict(places.namespaces)
    if places.chunks_path:
        each = _selected(root, places.chunks_path, names, True)
    else:
        each = [c for holder in root if local(holder) == "chunks" for c in holder]

    def text_of(chunk: ET.Element) -> str:
        texts = _selected(chunk, places.text_path, names, False) if places.text_path else [e for e in chunk if local(e) == "text"]
        return " ".join("".join(e.itertext()) for e in texts).strip()

    return [(c, t) for c in each if (t := text_of(c))]


def texts(content: bytes | None, kind: str | None, places: Places) -> list[str]:
    """The texts of a document's chunks, in order; none for content that can't be read."""
    try:
        if content and kind == "JSON":
            return [t for _, t in json_chunks(json.loads(content), places)]
        if content and kind == "XML":
            return [t for _, t in xml_chunks(tree(content)[0], places)]
    except (ValueError, expat.ExpatError):
        pass
    return []


def patched(content: bytes | None, kind: str | None, made: list[dict], places: Places) -> bytes | None:
    """The document with the i-th chunk's model name and vector put into the i-th chunk that has a text. An XML document's own bytes stay as they are."""
    if not content or not made:
        return content
    if kind == "JSON":
        document = json.loads(content)
        for (chunk, _), new in zip(json_chunks(document, places), made, strict=True):
            if new.get(places.name) is not None:
                chunk |= {k: new[k] for k in ("model-name", places.name) if new.get(k) is not None}
        return json.dumps(document, ensure_ascii=False).encode()
    root, ends = tree(content)
    out, at = [], 0
    for end, new in sorted((ends[id(chunk)], k) for k, (chunk, _) in enumerate(xml_chunks(root, places))):
        vector, model = made[new].get(places.name), made[new].get("model-name")
        if vector is not None:
            shown = vector if isinstance(vector, str) else "[" + ", ".join(map(repr, vector)) + "]"
            name = f'<model-name xmlns="{escape(places.namespace)}">{escape(model)}</model-name>' if model else ""
            out += [content[at:end], f'{name}<{places.name} xmlns="{escape(places.namespace)}" xml:lang="zxx">{escape(shown)}</{places.name}>'.encode()]
            at = end
    return b"".join([*out, content[at:]])


def existing_chunks(docs: DataFrame, options: Options | dict | None = None) -> DataFrame:
    """``docs`` and the chunks they hold: JSON at ``write.embedder.chunks.jsonPointer`` (an array of objects or one object), XML on ``write.embedder.chunks.xpath``; those without text are left out."""
    places = Places.of(Options.of(options))

    @F.pandas_udf("array<string>")
    def run(content: pd.Series, kind: pd.Series) -> pd.Series:
        return pd.Series([texts(None if c is None else bytes(c), k, places) for c, k in zip(content, kind, strict=True)], dtype=object)

    null = {"embedding": "array<float>", "classification": "binary", "modelName": "string", "metadata": "string"}
    return docs.withColumn("chunks", F.transform(run("content", "format"), lambda t: F.struct(t.alias("text"), *[F.lit(None).cast(kind).alias(name) for name, kind in null.items()])))


def in_place(docs: DataFrame, chunks, options: Options | dict | None = None) -> DataFrame:
    """The documents with their chunks' vectors in them. chunks: an array of structs as ``enrich.chunk_objects`` makes them, in the order of ``existing_chunks``."""
    places = Places.of(Options.of(options))

    @F.pandas_udf("binary")
    def put(content: pd.Series, kind: pd.Series, made: pd.Series) -> pd.Series:
        return pd.Series([patched(None if c is None else bytes(c), k, json.loads(m or "[]"), places) for c, k, m in zip(content, kind, made, strict=True)], dtype=object)

    return docs.withColumn("content", put("content", "format", F.to_json(chunks)))
