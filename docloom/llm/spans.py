"""Digest columns of an array of (kind, start, end) spans, for queries over sensitive text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, in the array's order, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*kinds))), 256)
