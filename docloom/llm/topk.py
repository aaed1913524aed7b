"""Exact inner-product top-k: ball-tree branch and bound in each shard, with the k-th score shared between shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

#: Rows of a shard on average, queries that meet it in one task on average, most rows of a leaf.
SHARD_ROWS = 4096
BLOCK_QUERIES = 1024
LEAF_ROWS = 128
#: Most cells that rows are dealt into by their nearest pivot, so at most 8 bytes x this x dimension are broadcast; shards split the cells.
CELLS = 1024
#: Cells that a query meets first; then it meets all others whose bound still reaches its k-th score.
FIRST = 8

_LEAST = np.iinfo(np.int64).min


class BallTree:
    """Balls over rows, halved at the median of the widest component down to ``LEAF_ROWS``; node n has children 2n+1, 2n+2 and a run of the rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, runs: np.ndarray, center: np.ndarray, radius: np.ndarray):
        self.ids, self.x, self.runs, self.center, self.radius = ids, x, runs, center, radius

    @classmethod
    def built(cls, ids: np.ndarray, x: np.ndarray) -> BallTree:
        depth = 0
        while len(x) > LEAF_ROWS << depth:
            depth += 1
        order, runs = np.arange(len(x)), [(0, len(x))]
        for node in range((1 << depth) - 1):
            a, b = runs[node]
            if b - a > 1 and x.shape[1]:
                own = x[order[a:b]]
                order[a:b] = order[a:b][np.argsort(own[:, np.argmax(own.max(axis=0) - own.min(axis=0))], kind="stable")]
            runs += [(a, (a + b) // 2), ((a + b) // 2, b)]
        x = x[order]
        center = np.array([x[a:b].mean(axis=0) if b > a else np.zeros(x.shape[1]) for a, b in runs]).reshape(len(runs), x.shape[1])
        radius = np.array([np.sqrt(((x[a:b] - c) ** 2).sum(axis=1)).max() if b > a else -np.inf for (a, b), c in zip(runs, center, strict=True)])
        return cls(ids[order], x, np.array(runs, np.int64), center, radius)

    def packed(self) -> dict[str, bytes | int]:
        """The tree as bytes: components in the narrowest type that holds them exactly."""
        top = np.abs(self.x).max(initial=0)
        kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
        parts = {"ids": self.ids.astype("<i8"), "x": self.x.astype(kind), "runs": self.runs.astype("<i8"), "center": self.center.astype("<f8"), "radius": self.radius.astype("<f8")}
        return {"kind": kind, **{name: part.tobytes() for name, part in parts.items()}}

    @classmethod
    def unpacked(cls, row: dict, dim: int) -> BallTree:
        ids, runs = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["runs"], "<i8").reshape(-1, 2)
        x = np.frombuffer(row["x"], row["kind"]).astype(np.float64).reshape(len(ids), dim)
        return cls(ids, x, runs, np.frombuffer(row["center"], "<f8").reshape(len(runs), dim), np.frombuffer(row["radius"], "<f8"))


def _dots(q: np.ndarray, x: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer inner products; beyond a long they are clipped to its ends."""
    if bound < 2**53:
        return (q @ x.T).astype(np.int64)
    if bound < 2**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in x] for r in q], object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64).reshape(len(q), len(x))


def best(tree: BallTree, query_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query position, id, score): each query's k best rows of the tree with another id that can still matter, score then smaller id first.

    floor: for each query, a score that k other rows already reach. A node's upper bound is <q, center> + |q| radius. A query enters a node only while the bound
    reaches its k-th score so far, and of two children the one with the higher bound first; queries that go the same way go together.
    """
    norm = np.sqrt((q**2).sum(axis=1))
    bound = float(max(np.abs(q).max(initial=0) * np.abs(tree.x).max(initial=0) * max(1, q.shape[1]), 1))
    slack = 1 + bound * 1e-9
    kth = floor.astype(np.float64)
    score, own = np.full((len(q), k), _LEAST), np.full((len(q), k), np.iinfo(np.int64).max)
    held = np.zeros(len(q), np.int64)

    def upper(node: int, who: np.ndarray) -> np.ndarray:
        if np.isinf(tree.radius[node]):
            return np.full(len(who), -np.inf)
        return q[who] @ tree.center[node] + norm[who] * tree.radius[node] + slack

    open_ = [(0, np.arange(len(q)), upper(0, np.arange(len(q))))]
    while open_:
        node, who, top = open_.pop()
        who = who[top >= kth[who]]
        if not len(who):
            continue
        if 2 * node + 2 < len(tree.runs):
            left, right = upper(2 * node + 1, who), upper(2 * node + 2, who)
            first = left >= right
            for mine, child, its in ((first, 2, right), (~first, 1, left), (first, 1, left), (~first, 2, right)):  # the last is taken first
                if mine.any():
                    open_.append((2 * node + child, who[mine], its[mine]))
            continue
        a, b = tree.runs[node]
        found = _dots(q[who], tree.x[a:b], bound)
        hit = (held[who] < k) | (found.max(axis=1, initial=_LEAST) >= kth[who])  # the others keep what they have
        who, found = who[hit], found[hit]
        ids = np.broadcast_to(tree.ids[a:b], found.shape)
        other = ids != query_ids[who][:, None]
        s = np.concatenate([score[who], np.where(other, found, _LEAST)], axis=1)
        i = np.concatenate([own[who], np.where(other, ids, np.iinfo(np.int64).max)], axis=1)
        empty = np.concatenate([np.arange(k)[None, :] >= held[who][:, None], ~other], axis=1)
        take = np.lexsort((i, np.invert(s), empty), axis=1)[:, :k]
        score[who], own[who] = np.take_along_axis(s, take, 1), np.take_along_axis(i, take, 1)
        held[who] = np.minimum(k, held[who] + other.sum(axis=1))
        full = who[held[who] == k]
        kth[full] = np.maximum(kth[full], score[full, k - 1])
    at, nth = np.nonzero(np.arange(k)[None, :] < held[:, None])
    return [(int(i), int(own[i, j]), int(score[i, j])) for i, j in zip(at, nth, strict=True)]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """floor(256 * component) of the vectors, which all have the dimension."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([np.zeros(0), *[c.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in chunks]])
    return np.floor(256 * flat).reshape(len(column), dim)


def _by_dim(batch: pa.RecordBatch):
    """(positions, dimension, matrix) of the batch's vectors (column v, its length in dim) for each dimension there."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield at, dim, _matrix(batch.column("v").take(pa.array(at)), dim)


def _dealt(rows: DataFrame, count: int) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The rows with ``cell``, the nearest of their dimension's pivots, and ``salt``; and the pivots, a bounded sample of rows by a hash."""
    most = max(1, min(CELLS, -(-count // SHARD_ROWS)))
    chosen = rows.orderBy(F.xxhash64("id", "v")).limit(most).select("dim", "v").toArrow().combine_chunks()
    pivots = {dim: np.unique(x, axis=0) for batch in chosen.to_batches() for _, dim, x in _by_dim(batch)}

    def run(batches):
        for batch in batches:
            cell = np.zeros(len(batch), np.int32)
            for at, dim, x in _by_dim(batch):
                if dim in pivots and dim:
                    cell[at] = ((pivots[dim] ** 2).sum(axis=1)[None, :] - 2 * x @ pivots[dim].T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    schema = f"id long, v {rows.schema['v'].dataType.simpleString()}, dim int, cell int"
    # repeated rows get different salts; they are fixed once written
    return written(rows.mapInArrow(run, schema).withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "topk-rows"), pivots


_TREE = "dim int, shard long, ids binary, kind string, x binary, runs binary, center binary, radius binary"
_FOUND = "query_id long, key long, dim int, vec_id long, score long"


def _trees(rows: DataFrame) -> DataFrame:
    """A row for each shard: its tree, built once and read by all queries that meet it. Cells are split into shards by salt."""

    def build(key, data):
        dim = key[0].as_py()
        tree = BallTree.built(data.column("id").to_numpy(), _matrix(data.column("v"), dim)).packed()
        return pa.Table.from_pylist([{"dim": dim, "shard": key[1].as_py(), **tree}], pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("ids", pa.binary()), ("kind", pa.string()), *[(n, pa.binary()) for n in ("x", "runs", "center", "radius")]]))

    # a shard's number: the cell in the high half, the part of the cell in the low half
    return written(rows.groupBy("dim", "shard").applyInArrow(build, _TREE), "topk-trees")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the highest inner product with each query, all if there are fewer.

    Vectors that are null, or hold null or non-finite components, take no part, nor do null ids; vectors of different lengths are not compared. Every row is a
    candidate, repeated ones as often as they are there; a query's own id is none. A query repeated in full is one query. Ties go to the smaller id. No rows give no
    rows; other columns are not read.

    Rows are dealt into cells by their nearest pivot, cells into shards of about ``SHARD_ROWS`` rows, and a ball tree is built once for each shard. A query meets
    cells by falling upper bound of their balls: ``FIRST`` of them, then those of the others whose bound reaches the k-th score it has from all shards so far.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    valid = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    shape = [F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim")]
    rows = vectors.filter(F.coalesce(valid, F.lit(False))).select(*shape)
    asked = written(queries.filter(F.coalesce(valid, F.lit(False))).select(*shape).distinct().withColumn("key", F.xxhash64("v")), "topk-queries")
    count = rows.count()
    rows, pivots = _dealt(rows, count)
    sizes = rows.groupBy("dim", "cell").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / SHARD_ROWS).cast("int")).drop("n")
    sizes = written(sizes, "topk-cells")  # at most CELLS a dimension
    trees = _trees(rows.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("shard", F.col("cell").cast("long") * (1 << 32) + F.pmod("salt", "parts")))

    def around(key, data):  # the ball of one part of a cell about its pivot
        dim, cell = key[0].as_py(), key[1].as_py()
        x, radius = pivots[dim][cell] if dim in pivots else np.zeros(dim), 0.0
        for row in data.to_pylist():
            tree = BallTree.unpacked(row, dim)
            radius = max(radius, float(np.sqrt(((tree.x - x) ** 2).sum(axis=1)).max(initial=0)))
        return pa.table({"dim": pa.array([dim], pa.int32()), "cell": pa.array([cell], pa.int32()), "radius": pa.array([radius])})

    cell_of = F.shiftright("shard", 32).cast("int")
    balls = trees.withColumn("cell", cell_of).groupBy("dim", "cell", "shard").applyInArrow(lambda key, data: around(key[:2], data), "dim int, cell int, radius double")
    balls = balls.groupBy("dim", "cell").agg(F.max("radius").alias("radius")).toArrow().to_pylist()
    of_dim: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in balls}:
        mine = [r for r in balls if r["dim"] == dim]
        cells = np.array([r["cell"] for r in mine], np.int32)
        center = pivots[dim][cells] if dim in pivots else np.zeros((len(mine), dim))
        of_dim[dim] = (cells, center, np.array([r["radius"] for r in mine]))
    shared = spark.sparkContext.broadcast(of_dim)

    def meeting(low: int, high: int):
        """Of each query, the cells from the low-th to the high-th by falling bound that can still matter."""

        def run(batches):
            for batch in batches:
                floor = batch.column("floor").fill_null(_LEAST).to_numpy().astype(np.float64)
                for at, dim, q in _by_dim(batch):
                    if dim not in shared.value:
                        continue
                    cells, center, radius = shared.value[dim]
                    dots, length = q @ center.T, np.sqrt((q**2).sum(axis=1))[:, None]
                    top = dots + length * radius[None, :]
                    top += 1 + 1e-9 * (np.abs(dots) + np.abs(top) + length * np.sqrt((center**2).sum(axis=1))[None, :])
                    order = np.argsort(-top, axis=1, kind="stable")[:, low:high]
                    who, nth = np.nonzero(np.take_along_axis(top, order, 1) >= floor[at][:, None])
                    mine = batch.take(pa.array(at[who]))
                    yield pa.RecordBatch.from_arrays([*mine.columns, pa.array(cells[order[who, nth]])], names=[*mine.schema.names, "cell"])

        return run

    def search(key, mine, theirs):
        if not len(mine) or not len(theirs):
            return pa.table({n: pa.array([], t) for n, t in (("query_id", pa.int64()), ("key", pa.int64()), ("dim", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64()))})
        dim = key[0].as_py()
        tree = BallTree.unpacked(mine.to_pylist()[0], dim)
        ids, keys = theirs.column("id").to_numpy(), theirs.column("key").to_numpy()
        found = best(tree, ids, _matrix(theirs.column("v"), dim), theirs.column("floor").fill_null(_LEAST).to_numpy(), k)
        at = [i for i, _, _ in found]
        return pa.table({"query_id": pa.array(ids[at], pa.int64()), "key": pa.array(keys[at], pa.int64()), "dim": pa.array([dim] * len(at), pa.int32()), "vec_id": pa.array([b for _, b, _ in found], pa.int64()), "score": pa.array([s for _, _, s in found], pa.int64())})

    vector = rows.schema["v"].dataType.simpleString()
    best_first = Window.partitionBy("query_id", "key", "dim").orderBy(F.desc("score"), "vec_id")
    out = spark.createDataFrame([], _FOUND + ", rank int")
    low, most = 0, max([len(c[0]) for c in of_dim.values()], default=0)
    while low < most:
        high = FIRST if low == 0 else most
        floors = out.groupBy(F.col("query_id").alias("id"), "key", "dim").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        met = asked.join(floors, ["id", "key", "dim"], "left") if low else asked.withColumn("floor", F.lit(None).cast("long"))
        met = met.select("id", "v", "dim", "key", "floor").mapInArrow(meeting(low, high), f"id long, v {vector}, dim int, key long, floor long, cell int")
        met = met.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        met = written(met.select("id", "v", "dim", "key", "floor", (F.col("cell").cast("long") * (1 << 32) + F.col("part")).alias("shard")), "topk-met")
        blocks = met.groupBy("dim", "shard").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
        halls = trees.join(blocks, ["dim", "shard"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        guests = met.join(blocks, ["dim", "shard"]).withColumn("block", F.pmod(F.xxhash64("id", "key"), "blocks").cast("int")).drop("blocks")
        keys = ["dim", "shard", "block"]
        found = halls.drop("blocks").groupBy(*keys).cogroup(guests.groupBy(*keys)).applyInArrow(search, _FOUND)
        every = out.drop("rank").unionByName(found).withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
        out = written(every, "topk-best")
        low = high
    return out.select("query_id", "rank", "vec_id", "score")


def op9_topk(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS nth FROM s)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM r WHERE nth <= 5
"""
