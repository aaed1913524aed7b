"""Values inside JSON and XML documents."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def json_path(pointer: str) -> str:
    """A JSON Pointer as a JSON path."""
    if pointer in ("", "/"):
        return "$"
    out = "$"
    for part in pointer.lstrip("/").split("/"):
        part = part.replace("~1", "/").replace("~0", "~")
        out += f"[{part}]" if part.isdigit() else f"['{part}']"
    return out


def json_pointer(document: Column, pointer: str) -> Column:
    """The value at a pointer as text; objects and arrays as JSON, missing places as null."""
    return F.get_json_object(document, json_path(pointer))


def joined_pointers(document: Column, pointers: list[str]) -> Column:
    """The values at several pointers, joined by spaces; missing ones are left out."""
    return F.concat_ws(" ", *[json_pointer(document, p) for p in pointers])


def local_path(path: str, namespaces: dict[str, str]) -> tuple[str, str | None]:
    """An element path for ElementTree, and what its last step takes: text, an attribute, or the node."""
    last = None
    if path.endswith("/text()"):
        path, last = path.removesuffix("/text()"), "text"
    elif "/@" in path:
        path, _, name = path.rpartition("/@")
        last = "@" + name
    path = path.replace("/node()", "/*")
    return path, last


def xpath_values(document: str | None, path: str, namespaces: dict[str, str]) -> list[str]:
    """The text of each node on an XPath 1.0 path of child and descendant steps, with namespace prefixes."""
    if not document:
        return []
    root = ET.fromstring(document)
    path, last = local_path(path, namespaces)
    holder = ET.Element("holder")
    holder.append(root)
    found = holder.findall("." + path if path.startswith("/") else path, namespaces)
    if last and last != "text":
        return [e.get(last[1:]) for e in found if e.get(last[1:]) is not None]
    if last == "text":
        return [e.text for e in found if e.text and e.text.strip()]
    return ["".join(e.itertext()) for e in found]


def xpath_text(document: Column, path: str, namespaces: dict[str, str] | None = None) -> Column:
    """Texts of the nodes on a path, joined by spaces. Without namespaces Spark's own xpath() does it; else an Arrow batch function."""
    if not namespaces and path.endswith("/text()"):
        return F.array_join(F.xpath(document, F.lit(path)), " ")
    names = dict(namespaces or {})

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: " ".join(xpath_values(t, path, names)))

    return run(document)


def pretty_json(text: str) -> str:
    return json.dumps(json.loads(text), indent=2, ensure_ascii=False)
