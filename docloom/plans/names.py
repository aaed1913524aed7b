"""Qualified column names: schema.view.column, with empty parts left out."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def qualified(schema: str, view: str, column: str) -> str:
    return ".".join(p for p in (schema, view, column) if p)


def quoted(name: str) -> str:
    """A name with dots as one identifier."""
    bare = name.replace("`", "")
    return f"`{bare}`" if re.search(r"\W", bare) else bare


def parts(name: str) -> tuple[str, str, str]:
    """(schema, view, column) of a one, two or three part name; missing parts are empty."""
    found = re.findall(r"`([^`]*)`|([^.`]+)", name)
    flat = [p for a, b in found for p in (a or b).split(".")]
    if not 1 <= len(flat) <= 3:
        raise ValueError(f"a column has one to three name parts: {name}")
    return (*[""] * (3 - len(flat)), *flat)


def column(name: str) -> Column:
    return F.col(quoted(name))


def resolve(columns: list[str], name: str) -> str:
    """The one of ``columns`` that a full or shortened name means."""
    wanted = [p for p in parts(name) if p]
    if ".".join(wanted) in columns:
        return ".".join(wanted)
    found = [c for c in columns if c.split(".")[-len(wanted) :] == wanted]
    if len(found) != 1:
        raise ValueError(f"{'ambiguous' if found else 'unknown'} column: {name}")
    return found[0]
