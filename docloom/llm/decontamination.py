"""Benchmark decontamination: size-partitioned MinHash containment search over windows, verified by exact shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, slices, table

WORDS = 5
#: The share of an item's distinct shingles that a document must hold.
CONTAINMENT = 0.8
#: Hash functions of a signature; a window is a candidate if it agrees with an item in any of them.
HASHES = 64
#: Items of so many shingles or fewer are found by all their shingles. Larger ones have size classes, each of which doubles this; windows are two such blocks.
LEAST = 8
#: Bytes of benchmark text that one broadcast holds; a larger benchmark is searched block by block.
BLOCK_BYTES = 4 << 20

#: Bytes of a text that are hashed at once, and shingles of a text whose windows are looked up at once; longer texts go part by part.
PART_BYTES, PART_SHINGLES = 1 << 20, 1 << 18

_POWER, _MULTIPLIER = np.uint64(0x9E3779B97F4A7C15), np.random.default_rng(7).integers(0, 1 << 64, HASHES + WORDS, np.uint64, endpoint=False) | np.uint64(1)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def words(text: str | None) -> list[str]:
    """Runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return np.where(_IN_WORD[raw], _FOLD[raw], 32).astype(np.uint8).tobytes().decode("utf-8", "surrogatepass").split(" ") if len(raw) else []


def shingles(text: str | None) -> set[str]:
    """Distinct runs of five words; a shorter text has its whole word sequence, one without words has none."""
    w = [x for x in words(text) if x]
    return {" ".join(w[i : i + WORDS]) for i in range(max(1, len(w) - WORDS + 1))} if w else set()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _POWER), np.full(n + 1, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_TABLES = _powers(1 << 12)


def parts_of(raw: bytes) -> list[bytes]:
    """A text's bytes in parts of about ``PART_BYTES`` that overlap by WORDS - 1 words, so that each shingle of five words is in just one."""
    out, at = [], 0
    while len(raw) - at > PART_BYTES + (PART_BYTES >> 1):
        flags = _IN_WORD[np.frombuffer(raw, np.uint8, PART_BYTES, at)]
        starts = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0) == 1)
        if len(starts) < 2 * WORDS:
            flags = _IN_WORD[np.frombuffer(raw, np.uint8, len(raw) - at, at)]  # very long words: look on
            starts = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0) == 1)
            if len(starts) < 2 * WORDS:
                break
            starts = starts[: 2 * WORDS]
        out.append(raw[at : at + int(starts[-1])])
        at += int(starts[-WORDS])
    return [*out, raw[at:]]


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of each text, in order, and where each text's begin. Long texts are hashed part by part."""
    parts, owner = [], []
    for k, t in enumerate(texts):
        for part in parts_of((t or "").encode("utf-8", "surrogatepass")):
            parts.append(part)
            owner.append(k)
    out, made = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    a = 0
    while a < len(parts):
        b, size = a + 1, len(parts[a])
        while b < len(parts) and size + len(parts[b]) <= 2 * PART_BYTES:
            size += len(parts[b])
            b += 1
        found, begin = _hashed(parts[a:b])
        out.append(found)
        np.add.at(made, owner[a:b], np.diff(begin))
        a = b
    return np.concatenate(out), np.concatenate([[0], np.cumsum(made)])


def _hashed(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of each part and where each part's begin. All words are hashed at once."""
    global _TABLES
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    at = np.concatenate([[0], np.cumsum(lengths + 1)])  # a space after each text keeps words apart
    raw = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    if len(raw) >= len(_TABLES[0]):
        _TABLES = _powers(2 * len(raw))
    inside = _IN_WORD[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_FOLD[raw].astype(np.uint64) + np.uint64(1)) * _TABLES[0][: len(raw)], dtype=np.uint64)])
    word = mixed((run[ends] - run[starts]) * _TABLES[1][starts])
    first = np.searchsorted(starts, at[:-1])
    count = np.diff(np.append(first, len(starts)))
    made = np.where(count >= WORDS, count - WORDS + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(made)])
    pos = np.arange(begin[-1]) + np.repeat(first - begin[:-1], made)
    have = np.repeat(np.minimum(count, WORDS), made)
    out = np.zeros(len(pos), np.uint64)
    for k in range(WORDS):
        out += np.where(have > k, word[np.minimum(pos + k, max(len(word) - 1, 0))] * _MULTIPLIER[HASHES + k], np.uint64(0)) if len(word) else np.uint64(0)
    return mixed(out + have.astype(np.uint64)), begin


class Items:
    """A block of benchmark items: shingle sets, the hashes of small items, and for larger ones size classes, each class's signatures sorted by hash function."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.sets = [shingles(t) for _, t in items]
        self.short = [next(iter(s)) if len(s) == 1 and next(iter(s)).count(" ") < WORDS - 1 else "" for s in self.sets]
        hashes, begin = hashed([t for _, t in items])
        size = np.array([len(s) for s in self.sets], np.int64)
        #: class c holds the items of LEAST * 2**c shingles or fewer that no smaller class holds
        self.of = np.array([max(0, int(np.ceil(np.log2(max(1, n) / LEAST)))) for n in size], np.int64)
        #: the distinct shingle hashes of class 0 by hash, the item of each, and the least number of them that a document must hold
        small = [(h, k) for k in range(len(items)) if self.of[k] == 0 for h in set(hashes[begin[k] : begin[k + 1]].tolist())]
        small.sort()
        self.small, self.owner = np.array([h for h, _ in small], np.uint64), np.array([k for _, k in small], np.int64)
        self.least = np.ceil(CONTAINMENT * size - 1e-9).astype(np.int64)
        self.classes = {}
        for c in sorted({int(c) for c, n in zip(self.of, size, strict=True) if n} - {0}):
            rows = [k for k in range(len(items)) if self.of[k] == c and size[k]]
            sign = np.array([[(hashes[begin[k] : begin[k + 1]] * _MULTIPLIER[j]).min() for j in range(HASHES)] for k in rows], np.uint64)
            order = np.argsort(sign, axis=0, kind="stable")
            seen = np.zeros((HASHES, 1 << 12), bool)  # by low bits, to pass over most windows
            for j in range(HASHES):
                seen[j, (sign[:, j] & np.uint64(4095)).astype(np.int64)] = True
            self.classes[c] = (np.take_along_axis(sign, order, 0), np.array(rows, np.int64)[order], seen)

    def candidates(self, hashes: np.ndarray, begin: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) positions: small items of which the text holds enough shingles, larger ones that agree with a window's signature anywhere.

        A class's windows are two adjacent blocks as long as its largest item, and its items are longer than half a block. So a run of an item's
        shingles as long as a block lies in one window, and what a copy at the containment shares with it is at least 0.8 / 4.2 of both together:
        all 64 functions miss it with odds below two in a million. Block minima of a class come from those of the class below.
        """
        found = self._held(hashes, begin)
        if not self.classes or not len(hashes):
            return found
        # texts of many shingles in parts that overlap by the longest window, so that every window is in one
        reach = 2 * (LEAST << max(self.classes))
        owner, starts, ends = [], [], []
        for t, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
            for first in range(a, b, PART_SHINGLES):
                owner.append(t)
                starts.append(first)
                ends.append(min(b, first + PART_SHINGLES + reach))
        a = 0
        while a < len(starts):
            b, size = a + 1, ends[a] - starts[a]
            while b < len(starts) and size + ends[b] - starts[b] <= PART_SHINGLES + reach:
                size += ends[b] - starts[b]
                b += 1
            part = np.concatenate([hashes[x:y] for x, y in zip(starts[a:b], ends[a:b], strict=True)])
            sizes = np.array([y - x for x, y in zip(starts[a:b], ends[a:b], strict=True)])
            found.update((owner[a + t], k) for t, k in self._near(part, np.concatenate([[0], np.cumsum(sizes)])))
            a = b
        return found

    def _near(self, hashes: np.ndarray, begin: np.ndarray) -> set[tuple[int, int]]:
        """(part, item) positions that agree in a window's signature."""
        found: set[tuple[int, int]] = set()
        made = np.diff(begin)
        blocks = -(-made // LEAST)
        first = np.concatenate([[0], np.cumsum(blocks)])
        text = np.repeat(np.arange(len(made)), blocks)
        starts = begin[:-1][text] + LEAST * (np.arange(first[-1]) - first[text])
        low = [np.minimum.reduceat(hashes * _MULTIPLIER[j], starts) for j in range(HASHES)]
        for c in range(max(self.classes) + 1):
            if c:
                text, first, low = _doubled(text, first, low)
            if c not in self.classes:
                continue
            sign, items, seen = self.classes[c]
            follows = np.append(text[1:] == text[:-1], False)
            for j in range(HASHES):
                window = low[j].copy()
                window[:-1] = np.where(follows[:-1], np.minimum(low[j][:-1], low[j][1:]), low[j][:-1])
                near = np.flatnonzero(seen[j, (window & np.uint64(4095)).astype(np.int64)])
                a, b = np.searchsorted(sign[:, j], window[near]), np.searchsorted(sign[:, j], window[near], side="right")
                for w, x, y in zip(near[a < b].tolist(), a[a < b].tolist(), b[a < b].tolist(), strict=True):
                    found.update((int(text[w]), int(k)) for k in items[x:y, j])
        return found

    def _held(self, hashes: np.ndarray, begin: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) positions where the text holds enough of a small item's shingles: none is missed."""
        if not len(self.small) or not len(hashes):
            return set()
        a = np.searchsorted(self.small, hashes)
        at = np.flatnonzero(self.small[np.minimum(a, len(self.small) - 1)] == hashes)
        text = np.searchsorted(begin, at, side="right") - 1
        _, first = np.unique(np.stack([text.astype(np.uint64), hashes[at]]), axis=1, return_index=True)
        at, text = at[first], text[first]
        many = np.searchsorted(self.small, hashes[at], side="right") - a[at]
        item = self.owner[np.repeat(a[at] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        pairs, shared = np.unique(np.stack([np.repeat(text, many), item]), axis=1, return_counts=True)
        return {(t, k) for t, k in pairs[:, shared >= self.least[pairs[1]]].T.tolist()}

    def contained(self, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared): of the candidates, those that hold enough of the item's shingles."""
        pairs = sorted(self.candidates(*hashed(texts)))
        own, last = "", None
        for t, k in pairs:
            if t != last:
                own, last = " ".join(["", *filter(None, words(texts[t])), ""]), t
            if self.short[k]:  # not five words: the whole text, or nothing
                shared = int(own == f" {self.short[k]} ")
            else:
                shared = sum(f" {s} " in own for s in self.sets[k])
            if shared and shared >= CONTAINMENT * len(self.sets[k]):
                yield t, k, shared


def _doubled(text: np.ndarray, first: np.ndarray, low: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Blocks of twice the length, each from the two (or the last one) that it covers."""
    nth = np.arange(len(text)) - first[text]
    head = np.flatnonzero(nth % 2 == 0)
    pair = np.minimum(head + 1, len(text) - 1)
    pair = np.where(text[pair] == text[head], pair, head)
    half = -(-np.diff(first) // 2)
    return text[head], np.concatenate([[0], np.cumsum(half)]), [np.minimum(x[head], x[pair]) for x in low]


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items with a word, in blocks of about ``BLOCK_BYTES``; the driver holds one block at a time."""
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).distinct().orderBy("i", "t")
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shared, shingles): items of which a row holds at least ``CONTAINMENT`` of the distinct shingles.

    Items without words match nothing, nor do null and empty texts; an item under five words matches only texts of the same words.
    Repeated rows of documents give repeated rows, repeated items count once; other columns are not read, null ids stay. Long texts are searched whole, part by
    part; a worker holds one text and its hashes. Documents are read once for each block of the benchmark; nothing is shuffled. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, shared int, shingles int"
    out = None
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(Items(block))

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                keys, texts = batch.column(0), batch.column(1).to_pylist()
                for a, b in slices(texts):
                    if hits := list(items.contained(texts[a:b])):
                        at = [a + t for t, _, _ in hits]
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array(at)).cast(pa.int64()), pa.array([items.ids[k] for _, k, _ in hits], pa.int64()), pa.array([n for _, _, n in hits], pa.int32()), pa.array([len(items.sets[k]) for _, k, _ in hits], pa.int32())],
                            names=["doc_id", "item_id", "shared", "shingles"],
                        )

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are, whatever their names: see ``leaks``. Rows with a null or empty text, or a null id, are judged
    by their text and so stay, repeated rows are judged alike, and an empty benchmark leaves all."""
    spark = docs.sparkSession
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(Items(block))

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                texts = batch.column(batch.schema.names.index("text")).to_pylist()
                keep = np.ones(len(texts), bool)
                for a, b in slices(texts):
                    for t, _, _ in items.contained(texts[a:b]):
                        keep[a + t] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, rowid AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
  UNION ALL
  SELECT 'b', item_id, rowid, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')
  FROM (SELECT *, row_number() OVER () AS rowid FROM (SELECT DISTINCT item_id, text FROM benchmark))),
s AS (
  SELECT DISTINCT kind, id, r, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT kind, id, r, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
b AS (SELECT id, r, s, count(*) OVER (PARTITION BY r) AS n FROM s WHERE kind = 'b')
SELECT d.id AS doc_id, b.id AS item_id, CAST(count(*) AS INTEGER) AS shared, CAST(any_value(b.n) AS INTEGER) AS shingles
FROM s d JOIN b ON d.s = b.s WHERE d.kind = 'd'
GROUP BY d.id, d.r, b.id, b.r HAVING count(*) >= 0.8 * any_value(b.n)
"""
