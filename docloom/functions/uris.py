"""Building and reading document URIs as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import OptionError, Options
from ..plans.names import column
from .pointers import json_pointer

#: A column of this name gives a row's file path; the row's URI is the path and a unique name, and the column is not content.
FILE_PATH_COLUMN = "docloom_file_path"


def template_parts(template: str) -> list[tuple[bool, str]]:
    """(is a field, text) of a URI template such as ``/{lang}/{/a/b}.json``."""
    out, at, open_ = [], 0, None
    for i, c in enumerate(template):
        if c == "{":
            if open_ is not None:
                raise OptionError(f"Invalid URI template: {template}; a left brace stands inside braces.")
            if template[at:i]:
                out.append((False, template[at:i]))
            open_ = i
        elif c == "}":
            if open_ is None:
                raise OptionError(f"Invalid URI template: {template}; a right brace stands without a left one.")
            if not template[open_ + 1 : i].strip():
                raise OptionError(f"Invalid URI template: {template}; there is no name within braces.")
            out.append((True, template[open_ + 1 : i]))
            at, open_ = i + 1, None
    if open_ is not None:
        raise OptionError(f"Invalid URI template: {template}; a brace is not closed.")
    if template[at:]:
        out.append((False, template[at:]))
    return out


def from_template(template: str, columns: list[str], json: Column | None = None, warn: bool = False) -> Column:
    """A URI from a row's columns, or from places in its JSON for names that start with a slash.

    A missing or blank value is an error, or with ``warn`` becomes UNRESOLVED- and a unique name.
    """
    pieces = []
    for is_field, text in template_parts(template):
        if not is_field:
            pieces.append(F.lit(text))
            continue
        if text.startswith("/"):
            value = json_pointer(json, text) if json is not None else F.lit(None).cast("string")
        elif text in columns:
            value = column(text).cast("string")
        elif json is not None:
            value = json_pointer(json, "/" + text)
        else:
            value = F.lit(None).cast("string")
        missing = F.concat(F.lit("UNRESOLVED-"), F.uuid()) if warn else F.raise_error(F.lit(f"Did not find value for {text} in URI template {template}"))
        pieces.append(F.when(value.isNotNull() & (F.trim(value) != ""), value).otherwise(missing))
    return F.concat(*pieces)


def replace_pairs(text: str) -> list[tuple[str, str]]:
    """``regex,'replacement',regex,'replacement'`` as pairs."""
    found = re.findall(r"\s*((?:[^,']|(?<=\\),)+?)\s*,\s*'([^']*)'\s*(?:,|$)", text)
    if not found or sum(len(a) + len(b) for a, b in found) + 3 * len(found) > len(text) + len(found):
        raise OptionError(f"Invalid value for uriReplace: {text}; it must have pairs of a pattern and a quoted replacement.")
    return found


def replaced(uri: Column, pairs: str | None) -> Column:
    """Every match of each pattern replaced, in order."""
    for pattern, by in replace_pairs(pairs) if pairs else []:
        uri = F.regexp_replace(uri, pattern, by)
    return uri


def standard(uri: Column, options: Options, suffix: str = "") -> Column:
    """Replacements, then the prefix; a blank URI becomes a unique name; then the suffix."""
    prefix, suffix = options.text("write.uriPrefix", ""), options.text("write.uriSuffix", suffix)
    base = replaced(F.coalesce(uri, F.lit("")), options.text("write.uriReplace"))
    named = F.when(F.trim(base) == "", F.uuid()).otherwise(base)
    return F.concat(F.lit(prefix), named, F.lit(suffix or ""))


def of_rows(df: DataFrame, options: Options, json: Column | None, suffix: str) -> Column:
    """The URI of a row that becomes a document of its own."""
    template = options.text("write.uriTemplate")
    if template:
        return from_template(template, df.columns, json, options.flag("write.uriTemplate.warnOnMissingField"))
    if FILE_PATH_COLUMN in df.columns:
        return standard(F.concat(F.col(FILE_PATH_COLUMN), F.lit("/"), F.uuid()), options, suffix)
    return standard(F.lit(""), options, suffix)


def to_path(uri: Column) -> Column:
    """The file path of a URI: scheme and host of a hierarchical URI go; an opaque URI stays; a path with a colon in its first part gets ``./``."""
    bare = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    opaque = uri.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:[^/]")
    return F.when(opaque, F.concat(F.lit("./"), uri)).otherwise(bare)


def file_name(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def extension(uri: Column) -> Column:
    return F.when(file_name(uri).contains("."), F.lower(F.substring_index(uri, ".", -1))).otherwise(F.lit(""))


def format_of(uri: Column, declared: Column | None = None) -> Column:
    """JSON, XML, TEXT or BINARY: by the URI's extension, else as declared, else binary."""
    ext = extension(uri)
    known = F.when(ext == "json", "JSON").when(ext.isin("xml", "xsl", "xsd", "xhtml", "html"), "XML").when(ext.isin("txt", "text", "csv", "md"), "TEXT")
    return F.coalesce(known, declared if declared is not None else F.lit(None).cast("string"), F.lit("BINARY"))


def metadata_entry(uri: Column, fmt: Column) -> Column:
    """The name of a document's metadata entry in an archive."""
    return F.concat(uri, F.lit("."), F.upper(F.coalesce(fmt, F.lit("BINARY"))), F.lit(".metadata"))


def metadata_entry_uri(entry: Column) -> Column:
    """The URI that a metadata entry is for, with or without a format in its name."""
    return F.regexp_replace(entry, r"(?:\.(?:JSON|XML|TEXT|BINARY|UNKNOWN))?\.metadata$", "")


def metadata_entry_format(entry: Column) -> Column:
    return F.nullif(F.regexp_extract(entry, r"\.(JSON|XML|TEXT|BINARY|UNKNOWN)\.metadata$", 1), F.lit(""))
