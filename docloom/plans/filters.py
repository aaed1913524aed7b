"""Filters as data, the way a scan receives them, turned into columns."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import names

#: (kind, column, value) leaves; ("and" | "or", [filters]); ("not", filter); ("sql", text).
Filter = tuple

_LEAF = {
    "eq": lambda c, v: c == F.lit(v),
    "null_safe_eq": lambda c, v: c.eqNullSafe(F.lit(v)),
    "gt": lambda c, v: c > F.lit(v),
    "ge": lambda c, v: c >= F.lit(v),
    "lt": lambda c, v: c < F.lit(v),
    "le": lambda c, v: c <= F.lit(v),
    "in": lambda c, v: c.isin(*v),
    "is_null": lambda c, _: c.isNull(),
    "is_not_null": lambda c, _: c.isNotNull(),
    "contains": lambda c, v: c.contains(v),
    "starts_with": lambda c, v: c.startswith(v),
    "ends_with": lambda c, v: c.endswith(v),
}


def column(f: Filter) -> Column:
    """Literal semantics throughout: marks such as % in a searched text mean themselves, and <=> holds for two nulls."""
    kind = f[0]
    if kind in ("and", "or"):
        return reduce(lambda a, b: a & b if kind == "and" else a | b, map(column, f[1]))
    if kind == "not":
        return ~column(f[1])
    if kind == "sql":
        return F.expr(f[1])
    if kind not in _LEAF:
        raise ValueError(f"unknown filter: {kind}")
    return _LEAF[kind](names.column(f[1]), f[2] if len(f) > 2 else None)


def pushed(filters: list[Filter]) -> Column:
    """The conjunction of filters that arrive one by one."""
    return reduce(lambda a, b: a & b, map(column, filters), F.lit(True))


def typed(value: Any, kind: str) -> Column:
    """A filter value bound as its type."""
    return F.lit(value).cast(kind)
