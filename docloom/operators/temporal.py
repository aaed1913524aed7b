"""Bitemporal history: what was held true about which time, and when. Writes close and split the versions they overlap."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: The columns that hold a rectangle: valid [from, to) and system [from, to); an open end is null.
ENDS = ("valid_from", "valid_to", "system_from", "system_to")
#: Rows of an Arrow batch that leaves the sweep.
BATCH_ROWS = 2000


class Line:
    """What holds now about the valid time of one key: pieces that don't overlap, by start. A start of None is the beginning of time, an end of None never comes."""

    def __init__(self):
        self.starts: list = []  # (0, ) for the beginning, (1, start) else
        self.pieces: dict = {}  # start -> (end, since, row)

    def put(self, start, end, since, row) -> Iterator[tuple]:
        """Takes in a version from ``since`` on (no version, just a gap, if row is None); yields (row, start, end, since, until) of what it closes."""
        a, b = (0,) if start is None else (1, start), (2,) if end is None else (1, end)
        if a >= b:
            return
        low = max(0, bisect_right(self.starts, a) - 1)
        for s in self.starts[low : bisect_left(self.starts, b)]:
            e, began, held = self.pieces[s]
            if e <= a:
                continue
            del self.pieces[s]
            self.starts.pop(bisect_left(self.starts, s))
            if s < a:
                self._add(s, a, began, held)
            if b < e:
                self._add(b, e, began, held)
            if began < since:
                yield held, max(s, a), min(e, b), began, since
        if row is not None:
            self._add(a, b, since, row)

    def _add(self, start, end, since, row) -> None:
        insort(self.starts, start)
        self.pieces[start] = (end, since, row)

    def open(self) -> Iterator[tuple]:
        for s in self.starts:
            e, since, row = self.pieces[s]
            yield row, s, e, since, None


def applied(history: DataFrame | None, writes: DataFrame, key: str, valid_from: str, valid_to: str, system: str, deleted: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """The history after the writes: the writes' columns and ``ENDS``, a row for each rectangle of (valid time x system time) in which a write's version is the one that holds.

    At its system time a write with the valid range [valid_from, valid_to) takes the place of whatever holds there: versions it overlaps are closed for the overlap and
    go on, split, beside it. A null start is the beginning of time, a null end open; an empty range changes nothing. Rows where ``deleted`` is true take versions away and leave none.
    Writes of one system time count in the order of ``ties``. Rows without a key or a system time take no part. The rectangles of a key tile what was ever valid without overlapping.

    history: what an earlier call gave (None at first); its closed rectangles and those of keys without writes pass as they are. A key's writes stream through one task in order of
    system time, which holds the key's open pieces, not its history.
    """
    names, spark = writes.columns, writes.sparkSession
    good = writes.filter(F.col(key).isNotNull() & F.col(system).isNotNull())
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    turns = [F.col(c) for c in ties]
    shape = StructType([*writes.schema.fields, StructField("valid_from", writes.schema[valid_from].dataType), StructField("valid_to", writes.schema[valid_to].dataType), StructField("system_from", writes.schema[system].dataType), StructField("system_to", writes.schema[system].dataType)])
    row = F.struct(*names).alias("__row")
    steps = good.select(F.col(key).alias("__key"), F.lit(1).alias("__new"), F.col(system).alias("__at"), *[t.alias(f"__t{i}") for i, t in enumerate(turns)], F.col(valid_from).alias("__a"), F.col(valid_to).alias("__b"), gone.alias("__gone"), row)
    passed = None
    if history is not None:
        touched = good.select(F.col(key)).distinct()
        now = history.filter("system_to IS NULL")
        passed = history.filter("system_to IS NOT NULL").unionByName(now.join(touched, key, "left_anti").select(*history.columns))
        held = now.join(touched, key, "left_semi")
        ties_then = [F.lit(None).cast(good.schema[c].dataType).alias(f"__t{i}") for i, c in enumerate(ties)]
        steps = steps.unionByName(held.select(F.col(key).alias("__key"), F.lit(0).alias("__new"), F.col("system_from").alias("__at"), *ties_then, F.col("valid_from").alias("__a"), F.col("valid_to").alias("__b"), F.lit(False).alias("__gone"), row))
    order = ["__key", "__new", "__at", *[f"__t{i}" for i in range(len(turns))]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = steps.repartition(parts, "__key").sortWithinPartitions(*order).select("__key", "__at", "__a", "__b", "__gone", "__row")
    arrow = to_arrow_schema(StructType([StructField("__row", steps.schema["__row"].dataType), *shape.fields[-4:]]))

    def sweep(batches):
        current, line, out = None, Line(), []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(arrow)], schema=arrow)

        def end(e):
            return None if e is None or len(e) == 1 else e[1]

        def keep(found) -> None:
            for held, s, e, since, until in found:
                out.append((held, end(s), end(e), since, until))

        for batch in batches:
            for k, at, a, b, gone, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != current:
                    keep(line.open())
                    current, line = k, Line()
                keep(line.put(a, b, at, None if gone else held))
                if len(out) >= BATCH_ROWS:
                    yield made()
                    out.clear()
        keep(line.open())
        if out:
            yield made()

    swept = steps.mapInArrow(sweep, StructType([StructField("__row", steps.schema["__row"].dataType), *shape.fields[-4:]])).select("__row.*", *ENDS)
    return swept if passed is None else passed.select(*swept.columns).unionByName(swept)


def as_of(history: DataFrame, valid: Column | None = None, system: Column | None = None) -> DataFrame:
    """The rectangles that hold at a valid time, as known at a system time (the present if there is none)."""
    if valid is not None:
        history = history.filter((F.coalesce(F.col("valid_from") <= valid, F.lit(True))) & F.coalesce(F.col("valid_to") > valid, F.lit(True)))
    if system is None:
        return history.filter("system_to IS NULL")
    return history.filter((F.col("system_from") <= system) & F.coalesce(F.col("system_to") > system, F.lit(True)))
