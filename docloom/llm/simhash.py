"""SimHash near-duplicates: fingerprints, a segment-popcount grid range-join, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, slices, spread, table, written
from .components import connected, hooked

BITS = 64
SEGMENTS = 32  # two bits each
#: Rows of one cell that a task compares at once; a larger cell is compared block by block.
BLOCK = 4096
#: The chance that two random segments have the same popcount: (1 + 4 + 1) / 16. Neighbours of a segment's popcount: 1.5 on average.
SAME, NEIGHBOURS = 0.375, 1.5
#: Hot cells up to this many go to the executors by broadcast (24 bytes each); beyond, by a join.
HOT_CELLS = 200_000
#: Characters of a text that are hashed at once; longer texts are cut between words, and each part takes the words it needs from the one before.
PART_CHARS = 1 << 20
#: Word shingles and similarity of near copies, and the odds with which two texts just that similar may be missed.
WIDTH, SIMILARITY, MISSED = 5, 0.8, 0.05
#: Bits that a text's distinct shingles are marked in: two texts have at least as many shingles apart as marks apart.
MARKS = 1024
#: Pairs whose marks are compared at once.
PAIRS = 1 << 14
#: Bytes of keys up to which those of the rows that go are broadcast.
BROADCAST_BYTES = 64 << 20


def parts_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text (A-Z lower-cased) in parts of about ``PART_CHARS`` characters."""
    raw = text.encode("utf-8", "surrogatepass")
    at = 0
    while at < len(raw):
        end = at + PART_CHARS
        while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":  # on to the end of the word
            end = min([i for i in (raw.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if i >= 0], default=len(raw))
        yield raw[at:end].lower().split()
        at = end


def shingle_hashes(text: str | None, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``width`` words, part by part; a shorter text has its whole word sequence, one without words nothing."""
    before: list[bytes] = []
    digest, some = xxhash.xxh64_intdigest, False
    for words in parts_of(text or ""):
        words = before + words
        n = len(words)
        if n >= width:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            yield np.array([digest(joined[a:b], seed) for a, b in zip(starts[: n - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)], np.uint64)
            some = True
        before = words[max(0, n - width + 1) :]
    if before and not some:
        yield np.array([digest(b" ".join(before), seed)], np.uint64)


def fingerprint(text: str | None, width: int = 4, seed: int = 42, extra: int = 0) -> np.ndarray:
    """The SimHash of a text's word shingles, repeats counted, as 1 + ``extra`` words of 64 bits; zero for a text without words.

    The first word's hash is that of the shingle; each further word's is a scramble of it.
    """
    ones, n = np.zeros((1 + extra, BITS), np.int64), 0
    for hashes in shingle_hashes(text, width, seed):
        for at in range(0, len(hashes), 1 << 12):
            part = hashes[at : at + (1 << 12)]
            every = np.stack([part, *[mixed(part + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) for k in range(1, 1 + extra)]], axis=1)
            bits = np.unpackbits(every.astype("<u8").view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32).reshape(1 + extra, BITS)
            n += len(part)
    return np.packbits(2 * ones > n, axis=1, bitorder="little").reshape(-1).view("<u8")


def marked(text: str | None) -> tuple[bytes, int]:
    """``MARKS`` bits, of which each shingle of ``WIDTH`` words sets one, and the number of shingles, repeats counted."""
    flags, n = np.zeros(MARKS, bool), 0
    for hashes in shingle_hashes(text, WIDTH, 42):
        flags[(hashes % np.uint64(MARKS)).astype(np.int64)] = True
        n += len(hashes)
    return np.packbits(flags).tobytes(), n


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp): each row's fingerprint as a signed long, and the hash of its text; null and empty texts have fingerprint 0."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in slices(texts):
                found = np.fromiter((fingerprint(t, width)[0] for t in texts[a:b]), np.uint64, b - a).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(found)], names=["doc_id", "text_hash", "fp"])

    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def unary(fp: np.ndarray) -> np.ndarray:
    """Each two-bit segment's popcount in unary (00, 01, 11): the Manhattan distance of popcounts is then that of bits."""
    low = np.uint64(0x5555555555555555)
    up = fp >> np.uint64(1)
    return ((fp | up) & low) | ((fp & up & low) << np.uint64(1))


def grids(count: int, distance: int) -> list[int]:
    """Masks of the grids: segments are split into g groups, and a grid's axes are the popcounts of the segments in g + 1 - distance of them.

    Popcounts that differ by ``distance`` in all differ by one at most in that many groups, so every link is a pair within Manhattan distance one in some
    grid. More groups mean more rows but far fewer pairs; g follows from the number of fingerprints, and the links found are the same for each.
    """

    def cost(g: int) -> float:
        axes, number = SEGMENTS * (g + 1 - distance) / g, comb(g, distance - 1)
        rows = count * number * (1 + NEIGHBOURS / 2 * axes)
        return rows * 2e-6 + count**2 / 2 * number * SAME**axes * (1 + NEIGHBOURS * axes) * 5e-9

    g = min(range(distance, distance + 6), key=cost)
    cuts = [round(k * SEGMENTS / g) for k in range(g + 1)]
    group = [sum(3 << (2 * s) for s in range(cuts[k], cuts[k + 1])) for k in range(g)]
    return [sum(group[k] for k in kept) for kept in combinations(range(g), g + 1 - distance)]


def visits(fp: np.ndarray, masks: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray, bool]]:
    """(position, fingerprint, grid, cell, visitor): each fingerprint lives in its cell of each grid and visits the cells one step below on one axis.

    Two cells one step apart thus meet in the lower one, so a pair in range meets once in a grid.
    """
    code, every = unary(fp), np.arange(len(fp))
    for k, m in enumerate(masks):
        cell = code & np.uint64(m)
        yield every, fp, k, cell, False
        for segment in range(SEGMENTS):
            two = np.uint64(3 << (2 * segment))
            if not m & int(two):
                continue
            high = np.uint64(2 << (2 * segment))
            at = np.flatnonzero(cell & two)
            lower = np.where(cell[at] & high, cell[at] & ~high, cell[at] & ~two)
            yield at, fp[at], k, lower, True


def _links(left: np.ndarray, right: np.ndarray | None, distance: int):
    """Pairs (i, j) of positions within ``distance``, in blocks: Manhattan distance of popcounts first, then all bits."""
    u, other = unary(left), left if right is None else right
    v = u if right is None else unary(right)
    step = max(1, (1 << 19) // max(1, len(other)))
    for a in range(0, len(left), step):
        near = np.bitwise_count(u[a : a + step, None] ^ v[None, :]) <= distance
        i, j = np.nonzero(near)
        i += a
        if right is None:
            i, j = i[i < j], j[i < j]
        true = np.bitwise_count(left[i] ^ other[j]) <= distance
        yield i[true], j[true]


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Edges (a, b) that connect just the distinct fingerprints (column fp) within ``distance`` bits: of each cell, a spanning forest.

    A cell's members are compared inside one task, at most two blocks of ``BLOCK`` at a time; its pairs never become rows.
    """
    masks = grids(fps.count(), distance)

    def run(batches):
        for batch in (b.slice(at, 2048) for b in batches for at in range(0, len(b), 2048)):
            for _, fp, k, cell, visitor in visits(batch.column(0).to_numpy().view(np.uint64), masks):
                yield _row_batch(fp, k, cell, visitor)

    cells = fps.select("fp").mapInArrow(run, "fp long, grid int, cell long, visitor boolean")
    return _compared(cells, distance)


def _row_batch(fp: np.ndarray, grid: int, cell: np.ndarray, visitor: bool) -> pa.RecordBatch:
    n = len(fp)
    return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(np.full(n, grid, np.int32)), pa.array(cell.view(np.int64)), pa.array(np.full(n, visitor))], names=["fp", "grid", "cell", "visitor"])


def _compared(cells: DataFrame, distance: int, across: bool = False) -> DataFrame:
    """The links (a, b) within ``distance`` of residents with each other and with visitors, of the rows (fp, grid, cell, visitor): of each cell a spanning forest.

    ``across``: every link instead, between the ids of rows (..., id, class, marks, shingles) of different classes, but for those that can't have the similarity.
    """
    more = ("id", "class", "marks", "shingles") if across else ()
    sizes = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
    hot = written(sizes.select("grid", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "hot-cells")
    many = hot.count()
    if many:
        keyed = cells.join(F.broadcast(hot) if many <= HOT_CELLS else hot, ["grid", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    else:
        keyed = cells.withColumn("blocks", F.lit(1))
    # A cell of one block is one task (0, 0). Of a larger one, the residents of blocks p <= q meet in (p, q) and those of p meet the visitors of q in (p, blocks + q).
    # place: of residents 0 or 1 for the left and right side; visitors are a right side that is not compared with itself either
    p, others = F.pmod(F.xxhash64("fp", *more), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("visitor").alias("right")))
    among = F.transform(others, lambda q: F.struct(F.least(p, q).alias("i"), F.greatest(p, q).alias("j"), (p > q).alias("right")))
    toward = F.transform(others, lambda q: F.struct(p.alias("i"), (F.col("blocks") + q).alias("j"), F.lit(False).alias("right")))
    coming = F.transform(others, lambda q: F.struct(q.alias("i"), (F.col("blocks") + p).alias("j"), F.lit(True).alias("right")))
    tasks = F.when(F.col("blocks") == 1, alone).when(F.col("visitor"), coming).otherwise(F.concat(among, toward))
    dealt = keyed.select("fp", "grid", "cell", *more, F.explode(tasks).alias("t")).select("fp", "grid", "cell", "t.i", "t.j", "t.right", *more)

    def compared(rows: dict) -> Iterator[np.ndarray]:
        among = bool(rows["i"][0] == rows["j"][0])
        if across:
            yield from _across(rows, among, distance)
        elif len(found := _forest(rows["fp"], rows["right"], among, distance)):
            yield found

    def run(batches):
        kept: dict | None = None
        for batch in batches:
            now = {n: batch.column(k).to_numpy(zero_copy_only=False) for k, n in enumerate(("fp", "grid", "cell", "i", "j", "right", *more))}
            if kept is not None:
                now = {n: np.concatenate([kept[n], now[n]]) for n in now}
            size = len(now["fp"])
            change = np.zeros(size, bool)
            for n in ("grid", "cell", "i", "j"):
                change[1:] |= now[n][1:] != now[n][:-1]
            cuts = [0, *np.flatnonzero(change).tolist()]
            out, held = [], 0
            for a, b in zip(cuts, cuts[1:], strict=False):
                for found in compared({n: c[a:b] for n, c in now.items()}) if b - a > 1 else ():
                    out.append(found)
                    held += len(found)
                    if held > 1 << 18:
                        yield _edges(np.concatenate(out))
                        out, held = [], 0
            kept = {n: c[cuts[-1] :] for n, c in now.items()}
            if out:
                yield _edges(np.concatenate(out))
        if kept is not None and len(kept["fp"]) > 1:
            for found in compared(kept):
                yield _edges(found)

    return dealt.repartition("grid", "cell", "i", "j").sortWithinPartitions("grid", "cell", "i", "j").mapInArrow(run, "a long, b long")


def _across(rows: dict, among: bool, distance: int) -> Iterator[np.ndarray]:
    """All links of left rows with right ones, and with each other if ``among``, between rows of different classes."""
    bits, ids, of, size = rows["fp"].view(np.uint64), rows["id"], rows["class"], rows["shingles"]
    marks = np.frombuffer(b"".join(rows["marks"]), "<u8").reshape(len(bits), MARKS // 64)
    left, other = np.flatnonzero(~rows["right"]), np.flatnonzero(rows["right"])
    for right in ([None] if among else []) + ([other] if len(left) and len(other) else []):
        for i, j in _links(bits[left], None if right is None else bits[right], distance):
            i, j = left[i], (left if right is None else right)[j]
            apart = of[i] != of[j]
            i, j = i[apart], j[apart]
            for a in range(0, len(i), PAIRS):
                x, y = i[a : a + PAIRS], j[a : a + PAIRS]
                can = alike(marks[x], marks[y], size[x] + size[y])
                if can.any():
                    yield np.stack([ids[x[can]], ids[y[can]]], axis=1)


def alike(a: np.ndarray, b: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Which pairs of texts may have the similarity, by their marks and the shingles of both, repeats counted: a mark that one of them lacks is a shingle that it lacks. None that has it is left out."""
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return apart * (1 + SIMILARITY) <= shingles * (1 - SIMILARITY) + 1e-6


def _edges(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def _forest(fp: np.ndarray, right: np.ndarray, among: bool, distance: int) -> np.ndarray:
    """A spanning forest of the links of left rows with right ones, and with each other if ``among``."""
    label = np.arange(len(fp))
    bits = fp.view(np.uint64)
    left, other = np.flatnonzero(~right), np.flatnonzero(right)
    if among:
        for i, j in _links(bits[left], None, distance):
            label = hooked(label, left[i], left[j])
    if len(left) and len(other):
        for i, j in _links(bits[left], bits[other], distance):
            label = hooked(label, left[i], other[j])
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return np.stack([fp[moved], fp[label[moved]]], axis=1)


def _components(prints: DataFrame, edges: DataFrame) -> DataFrame:
    """``prints`` with root, a fingerprint that stands for the component over the edges (a, b) of fingerprints, and component_id, the least doc_id there.

    Only fingerprints with a link meet their component's root, in parts of it; rows meet their fingerprint, the hot ones by broadcast.
    """
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "fp-nodes")
    roots = connected(edges)
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp").withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(16)))
    linked = written(linked, "fp-linked")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))))
    found = linked.join(least, ["root", "part"]).select("fp", "root", "component_id")
    named = nodes.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "n", F.coalesce("component_id", "first").alias("component_id"))
    return spread(prints, written(named, "fp-named"), "fp").drop("n")


def grouped(docs: DataFrame, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for each row: component_id is the least id reachable over links of ``distance`` bits or fewer.

    Equal fingerprints are one node, so copies cost one comparison. Rows without words (null and empty texts) share fingerprint 0 and link like any other;
    a null id is never the least unless a component has no other; repeated rows stay. Long texts are hashed part by part, whole. An empty table gives no rows;
    other columns are not read.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    edges = links(prints.select("fp").distinct(), distance)
    return _components(prints, edges).select("doc_id", "fp", "component_id")


def tables(count: int) -> tuple[int, int]:
    """(bits of a key, keys): enough bits that a cell holds a quarter of an unrelated text, and enough keys that two texts of similarity
    ``SIMILARITY`` share one but for odds of ``MISSED``. Each bit of theirs agrees with odds of 1 - angle / pi; the cosine is 2 s / (1 + s)."""
    bits = min(BITS, max(12, math.ceil(math.log2(max(2, count))) + 2))
    same = 1 - math.acos(2 * SIMILARITY / (1 + SIMILARITY)) / math.pi
    return bits, math.ceil(math.log(MISSED) / math.log1p(-(same**bits)))


def similar(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prints, edges): (doc_id, text_hash, fp) of each row of (doc_id, text), fp being the hash of the text's words in order, and links of those whose texts share ``SIMILARITY`` of their five-word shingles.

    At this similarity fingerprints differ by about ten of 64 bits, a distance at which no grid over 64 bits tells texts apart. So a text has many more SimHash bits
    here; texts that share a key, a run of them, meet in a cell, are compared there by popcounts and bits of the first 64, and links are verified by exact
    shingles: first those of a forest of each cell's candidates, then all candidates that the verified ones leave in different components (see ``_apart``) and whose marks allow the similarity (see ``alike``).
    Texts of the same words are one node; every other text is a node of its own.
    """
    width_bits, keys = tables(docs.count())
    each = BITS // width_bits
    extra = -(-keys // each)
    far = 22  # bits of 64 by which copies at the similarity differ with odds below 1 in 10,000: the mean is 9.7, the deviation 2.9
    schema = "doc_id long, text_hash long, bits long, words binary, fp long, marks binary, shingles long"

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in slices(texts):
                found = np.stack([fingerprint(t, WIDTH, extra=extra) for t in texts[a:b]])
                marks = [marked(t) for t in texts[a:b]]
                rest = pa.array([w.tobytes() for w in found[:, 1:]], pa.binary())
                same = np.array([words_hash(t) for t in texts[a:b]], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(found[:, 0].copy().view(np.int64)), rest, pa.array(same), pa.array([m for m, _ in marks], pa.binary()), pa.array([n for _, n in marks], pa.int64())], names=["doc_id", "text_hash", "bits", "words", "fp", "marks", "shingles"])

    every = written(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema), "wide-fingerprints")
    prints = every.select("doc_id", "text_hash", "fp")
    nodes = written(every.groupBy("fp").agg(F.min("text_hash").alias("text_hash"), F.first("bits").alias("bits"), F.min("words").alias("words"), F.min("marks").alias("marks"), F.min("shingles").alias("shingles")), "wide-nodes")

    def cells(batches):
        low = np.uint64((1 << width_bits) - 1)
        for batch in (b.slice(at, 2048) for b in batches for at in range(0, len(b), 2048)):
            fp = batch.column(0).to_numpy().view(np.uint64)
            words = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8").reshape(len(fp), extra)
            more = [batch.column(k) for k in range(2, batch.num_columns)]
            names = ["fp", "grid", "cell", "visitor", "id", "class", "marks", "shingles"][: 4 + len(more)]
            for k in range(keys):
                made = _row_batch(fp, k, (words[:, k // each] >> np.uint64(width_bits * (k % each))) & low, False)
                yield pa.RecordBatch.from_arrays([*made.columns, *more], names=names)
            if more:  # texts of one fingerprint are candidates too, which a forest of fingerprints doesn't tell
                yield pa.RecordBatch.from_arrays([*_row_batch(fp, -1, fp, False).columns, *more], names=names)

    near = _compared(nodes.select("bits", "words").mapInArrow(cells, "fp long, grid int, cell long, visitor boolean"), far)
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    # a fingerprint's links are first tried by the text with the least hash of its words, which is also tried with the others
    first = written(nodes.groupBy("bits").agg(F.min("fp").alias("first"), F.count("*").alias("n")), "first-texts")
    of = lambda c: first.select(F.col("bits").alias(c), F.col("first").alias(f"{c}_first"))
    stars = nodes.join(first.filter("n > 1"), "bits").filter("fp <> first").select(F.col("first").alias("a"), F.col("fp").alias("b"))
    tried = written(near.join(of("a"), "a").join(of("b"), "b").select(F.col("a_first").alias("a"), F.col("b_first").alias("b")).unionByName(stars), "near")
    edges = written(verified(docs, nodes.select("fp", "text_hash"), tried), "verified")
    apart = _apart(nodes, tried, edges)
    if apart is None:
        return prints, edges
    rest = _compared(apart.select("bits", "words", "fp", "class", "marks", "shingles").mapInArrow(cells, "fp long, grid int, cell long, visitor boolean, id long, class long, marks binary, shingles long"), far, across=True)
    rest = written(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near")
    return prints, edges.unionByName(verified(docs, nodes.select("fp", "text_hash"), rest))


def words_hash(text: str | None) -> int:
    """XXH64 of a text's words (A-Z lower-cased), joined by spaces."""
    h = xxhash.xxh64(seed=7)
    for words in parts_of(text or ""):
        h.update(b"".join(w + b" " for w in words))
    return h.intdigest()


def _apart(nodes: DataFrame, tried: DataFrame, edges: DataFrame) -> DataFrame | None:
    """The nodes, with the class of the links (a, b) of ``edges``, that ``tried`` links join and ``edges`` leave in different classes; None if there are none.

    ``tried`` spans all candidates, so any other candidate of two classes lies between two of these nodes.
    """
    classes = written(connected(edges), "classes")

    def classed(df: DataFrame, c: str) -> DataFrame:
        return df.join(classes.select(F.col("node").alias(c), F.col("root").alias(f"{c}_class")), c, "left").withColumn(f"{c}_class", F.coalesce(f"{c}_class", c))

    between = classed(classed(tried, "a"), "b").filter("a_class <> b_class").select("a_class", "b_class")
    open_ = written(between.select(F.explode(F.array("a_class", "b_class")).alias("class")).distinct(), "open-classes")
    if open_.isEmpty():
        return None
    return classed(nodes, "fp").withColumnRenamed("fp_class", "class").join(open_, "class", "left_semi")


def verified(docs: DataFrame, nodes: DataFrame, near: DataFrame) -> DataFrame:
    """Of the links (a, b) of nodes, those whose texts share ``SIMILARITY`` of all their distinct shingles; only texts with a link are read again."""
    asked = near.select(F.col("a").alias("fp")).unionByName(near.select(F.col("b").alias("fp"))).distinct().join(nodes, "fp")
    asked = written(asked, "asked")
    keys = asked.select("text_hash").distinct()
    small = asked.count() * 16 <= BROADCAST_BYTES
    texts = docs.withColumn("text_hash", F.xxhash64("text")).select("text_hash", "text").join(F.broadcast(keys) if small else keys, "text_hash", "left_semi")

    def run(batches):
        for batch in batches:
            found = [np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(t, WIDTH, 42)])).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["text_hash", "shingles"])

    sets = texts.mapInArrow(run, "text_hash long, shingles array<long>").groupBy("text_hash").agg(F.min("shingles").alias("shingles"))
    sets = written(asked.join(sets, "text_hash").select("fp", "shingles"), "shingles")
    both = near.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared >= SIMILARITY * (F.size("x") + F.size("y") - shared)).select("a", "b")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row stays of each group of rows that are near copies, directly or through others: the one with the least doc_id, of those the least hash of its text.

    Near copies share ``SIMILARITY`` of their five-word shingles (see ``similar``; a pair just that similar is missed with odds of ``MISSED``, more similar ones more
    rarely). Rows without words are copies of each other. Of rows that repeat an id and a text one stays; rows that repeat only the id are different texts. Rows with a
    null doc_id can't be addressed; they all stay. Columns stay as they are; an empty table gives no rows.
    """
    text_hash = F.xxhash64("text")
    prints, edges = similar(docs.filter("doc_id is not null").select("doc_id", "text"))
    found = _components(prints, edges).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    found = written(found, "near-groups")
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("key")).select("key.*")
    first = written(first.join(found.select("doc_id", "text_hash", "n"), ["doc_id", "text_hash"]).select("doc_id", "text_hash", "n"), "survivors")
    gone = written(found.join(first, ["doc_id", "text_hash"], "left_anti").select("doc_id", "text_hash"), "near-copies")
    repeated = written(first.filter("n > 1").select("doc_id", "text_hash"), "repeated")

    def fits(keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if keys.count() * 16 <= BROADCAST_BYTES else keys

    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.col("doc_id"), text_hash.alias("text_hash"))
    kept = keyed.join(fits(gone), ["doc_id", "text_hash"], "left_anti")
    if not repeated.isEmpty():  # the few rows that are repeated in full
        one = kept.join(fits(repeated), ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
        kept = kept.join(fits(repeated), ["doc_id", "text_hash"], "left_anti").unionByName(one)
    return kept.select("r.*")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
