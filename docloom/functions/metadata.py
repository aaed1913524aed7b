"""Document metadata: delimited options, XML forms, key spellings."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import OptionError

CAPABILITIES = ("read", "update", "insert", "execute", "node-update")
#: Namespace of the metadata entries of archives.
NS = "http://docloom.dev/metadata"


def permissions(text: str | None) -> dict[str, list[str]]:
    """``role,capability,role,capability`` as capabilities by role, in order of first mention."""
    parts = [p.strip() for p in (text or "").split(",") if p.strip()]
    if len(parts) % 2:
        raise OptionError(f"Unable to parse permissions: {text}; it must be pairs of a role and a capability.")
    out: dict[str, list[str]] = {}
    for role, capability in zip(parts[::2], parts[1::2], strict=True):
        if capability.lower() not in CAPABILITIES:
            raise OptionError(f"Unable to parse permissions: {text}; not a capability: {capability}.")
        out.setdefault(role, []).append(capability.lower())
    return out


def permissions_column(text: Column) -> Column:
    """The same for a column, as a map of arrays; capabilities of a role are in order."""
    parts = F.transform(F.split(text, ","), lambda c: F.trim(c))
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(parts) / 2).cast("int") - 1), lambda i: F.struct(F.element_at(parts, 2 * i + 1).alias("role"), F.lower(F.element_at(parts, 2 * i + 2)).alias("cap")))
    roles = F.array_distinct(F.transform(pairs, lambda p: p["role"]))
    return F.map_from_entries(F.transform(roles, lambda r: F.struct(r, F.transform(F.filter(pairs, lambda p: p["role"] == r), lambda p: p["cap"]))))


def collections(text: str | None) -> list[str]:
    return [c.strip() for c in (text or "").split(",") if c.strip()]


def collections_column(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda c: F.trim(c)), lambda c: c != "")


def json_keys(values: Column) -> Column:
    """Metadata keys as JSON names: a colon becomes a dash."""
    return F.transform_keys(values, lambda k, _: F.replace(k, F.lit(":"), F.lit("-")))


#: The namespaces that prefixes of metadata keys stand for in XML.
PREFIXES = {
    "dc": "http://purl.org/dc/elements/1.1/",
    "dcterms": "http://purl.org/dc/terms/",
    "exif": "http://ns.adobe.com/exif/1.0/",
    "pdf": "http://ns.adobe.com/pdf/1.3/",
    "tiff": "http://ns.adobe.com/tiff/1.0/",
    "xhtml": "http://www.w3.org/1999/xhtml",
    "xmp": "http://ns.adobe.com/xap/1.0/",
}


def xml_text(text: Column) -> Column:
    """Text for an XML element or attribute; characters that XML can't hold are left out."""
    text = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]", "")
    for raw, made in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(made))
    return text


def xml_elements(values: Column) -> Column:
    """Metadata as XML elements, by column functions: a known prefix of a key gives its namespace, other colons and what no name may hold become dashes."""

    def one(entry: Column) -> Column:
        key, prefix = entry["key"], F.substring_index(entry["key"], ":", 1)
        space = F.when(key.contains(":"), F.try_element_at(F.create_map(*[F.lit(x) for pair in PREFIXES.items() for x in pair]), prefix))
        name = F.when(space.isNotNull(), F.substring(key, F.length(prefix) + 2, F.length(key))).otherwise(key)
        name = F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}._-]", "-"), r"^(?=[^\p{L}_])|^$", "_")
        opened = F.concat(F.lit("<"), name, F.coalesce(F.concat(F.lit(' xmlns="'), space, F.lit('"')), F.lit("")), F.lit(">"))
        return F.concat(opened, F.coalesce(xml_text(entry["value"]), F.lit("")), F.lit("</"), name, F.lit(">"))

    return F.array_join(F.transform(F.map_entries(values), one), "")


def to_xml(row: dict) -> str:
    """The five metadata columns as one XML document."""
    root = ET.Element(f"{{{NS}}}metadata")
    holder = ET.SubElement(root, f"{{{NS}}}collections")
    for c in row.get("collections") or []:
        ET.SubElement(holder, f"{{{NS}}}collection").text = c
    holder = ET.SubElement(root, f"{{{NS}}}permissions")
    for role, caps in (row.get("permissions") or {}).items():
        one = ET.SubElement(holder, f"{{{NS}}}permission")
        ET.SubElement(one, f"{{{NS}}}role-name").text = role
        for cap in caps:
            ET.SubElement(one, f"{{{NS}}}capability").text = cap
    if row.get("quality") is not None:
        ET.SubElement(root, f"{{{NS}}}quality").text = str(row["quality"])
    if row.get("properties"):
        ET.SubElement(root, f"{{{NS}}}properties").append(ET.fromstring(row["properties"]))
    holder = ET.SubElement(root, f"{{{NS}}}metadata-values")
    for k, v in (row.get("metadataValues") or {}).items():
        ET.SubElement(holder, f"{{{NS}}}metadata-value", key=k).text = v
    return ET.tostring(root, encoding="unicode")


def local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def from_xml(text: str) -> dict:
    """The metadata columns of such a document, whatever its namespace; parts that are absent are None."""
    out: dict = dict.fromkeys(("collections", "permissions", "quality", "properties", "metadataValues"))
    for part in ET.fromstring(text):
        kind = local(part)
        if kind == "collections":
            out["collections"] = [e.text or "" for e in part] or None
        elif kind == "permissions":
            found: dict[str, list[str]] = {}
            for one in part:
                role = next((e.text for e in one if local(e) == "role-name"), None)
                if role:
                    found.setdefault(role, []).extend((e.text or "").lower() for e in one if local(e) == "capability")
            out["permissions"] = found or None
        elif kind == "quality":
            out["quality"] = int(part.text or 0)
        elif kind == "properties":
            inner = list(part)
            out["properties"] = ET.tostring(inner[0], encoding="unicode") if inner else None
        elif kind == "metadata-values":
            out["metadataValues"] = {e.get("key"): e.text or "" for e in part} or None
    return out
