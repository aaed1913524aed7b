"""Hard-negative mining: k-means inverted lists with stored radii, visited by Cauchy-Schwarz bounds within a window of scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .topk import _LEAST, _by_dim, _dots, _matrix

#: Rows of a list on average, and most lists, so at most 8 bytes x this x dimension are broadcast. Large lists are stored in parts of so many rows.
LIST_ROWS, LISTS, PART_ROWS = 1024, 1024, 4096
#: Vectors that k-means is fitted on (a random sample, at most twice as many and at most so many bytes); every row is then put into a list.
SAMPLE, SAMPLE_BYTES = 16_384, 64 << 20
ITERATIONS = 8
#: Lists that a query meets first; the others only while their bound reaches the k-th score found there.
FIRST = 8
#: Queries that meet a part in one task, on average.
BLOCK_QUERIES = 512


def kmeans(x: np.ndarray, k: int, iterations: int = ITERATIONS) -> np.ndarray:
    """At most k centroids of the rows by Lloyd's iterations from distinct rows; a centroid without rows stays where it is."""
    distinct = np.unique(x, axis=0)
    centers = distinct[np.random.default_rng(1).permutation(len(distinct))[:k]]
    for _ in range(iterations if len(distinct) > k else 0):
        near = nearest(x, centers)
        n = np.bincount(near, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        centers = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers)
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int32)
    for a in range(0, len(x), 4096):
        out[a : a + 4096] = ((centers**2).sum(axis=1)[None, :] - 2 * x[a : a + 4096] @ centers.T).argmin(axis=1)
    return out


def _centers(rows: DataFrame, count: int) -> dict[int, np.ndarray]:
    """The centroids of each dimension in the sample, as many as its share of the lists."""
    wide = rows.agg(F.max("dim")).first()[0] or 1
    size = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * wide)))
    chance = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    chosen = (rows if count <= size else rows.filter(chance < int((1 << 30) * size / count))).limit(2 * size)
    lists, out = max(1, min(LISTS, -(-count // LIST_ROWS))), {}
    batch = chosen.select("dim", "v").toArrow().combine_chunks().to_batches()
    for b in batch:
        for _, dim, x in _by_dim(b):
            if dim:
                out[dim] = kmeans(x, max(1, round(lists * len(x) / len(b))))
    return out


def bounds(q: np.ndarray, center: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of each query with any row of each list: <q, c> -+ |q| r, with room for rounding."""
    dots, length = q @ center.T, np.sqrt((q**2).sum(axis=1))[:, None]
    reach = length * radius[None, :]
    reach = reach + 1 + 1e-9 * (np.abs(dots) + reach + length * np.sqrt((center**2).sum(axis=1))[None, :])
    return dots - reach, dots + reach


def within(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int, floor: int, low: int, high: int) -> np.ndarray:
    """Positions of the k best allowed rows with floor <= score and low <= score <= high, higher scores first, ties by smaller id."""
    at = np.flatnonzero(allowed & (scores >= max(floor, low)) & (scores <= high))
    if len(at) > k:
        kth = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= kth]
    return at[np.lexsort((ids[at], np.invert(scores[at])))][:k]


_WINDOW = "array<struct<nth:int,low:long,high:long,floor:long>>"
_FOUND = "id long, key long, dim int, nth int, vec_id long, score long"
_FOUND_ARROW = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("dim", pa.int32()), ("nth", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
_PART = "dim int, list int, part int, ids binary, labels binary, kind string, x binary, radius double"


class Lists:
    """The inverted lists over a table of rows (id, label, v, dim): parts stored once, centroids and radii broadcast."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        count = rows.count()
        centers = _centers(rows, count)
        vector = rows.schema["v"].dataType.simpleString()

        def assign(batches):
            for batch in batches:
                own = np.zeros(len(batch), np.int32)
                for at, dim, x in _by_dim(batch):
                    if dim in centers:
                        own[at] = nearest(x, centers[dim])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=[*batch.schema.names, "list"])

        def build(key, data):
            dim, list_ = key[0].as_py(), key[1].as_py()
            x = _matrix(data.column("v"), dim)
            center = centers[dim][list_] if dim in centers else np.zeros(dim)
            top = np.abs(x).max(initial=0)
            kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
            ids, labels = data.column("id").to_numpy().astype("<i8"), data.column("label").to_numpy().astype("<i8")
            row = {"dim": dim, "list": list_, "part": key[2].as_py(), "ids": ids.tobytes(), "labels": labels.tobytes(), "kind": kind, "x": x.astype(kind).tobytes(), "radius": float(np.sqrt(((x - center) ** 2).sum(axis=1)).max(initial=0))}
            return pa.Table.from_pylist([row], pa.schema([("dim", pa.int32()), ("list", pa.int32()), ("part", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()), ("x", pa.binary()), ("radius", pa.float64())]))

        dealt = rows.select("id", "label", "v", "dim").mapInArrow(assign, f"id long, label long, v {vector}, dim int, list int")
        dealt = written(dealt.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "lists-rows")
        sizes = written(dealt.groupBy("dim", "list").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts")), "lists-sizes")
        self.sizes = sizes
        parts = dealt.join(sizes, ["dim", "list"]).withColumn("part", F.pmod("salt", "parts").cast("int"))
        self.parts = written(parts.groupBy("dim", "list", "part").applyInArrow(build, _PART), "lists")
        known = self.parts.filter(F.col("dim").isin(*centers) if centers else F.lit(False))  # a row for each list of the sample's dimensions
        radii = {(r["dim"], r["list"]): r["radius"] for r in known.groupBy("dim", "list").agg(F.max("radius").alias("radius")).toArrow().to_pylist()}
        of_dim = {}
        for dim, c in centers.items():
            held = np.array([k for k in range(len(c)) if (dim, k) in radii], np.int32)
            of_dim[dim] = (held, c[held], np.array([radii[dim, int(k)] for k in held]))
        self.balls = self.spark.sparkContext.broadcast(of_dim)
        self.vector = vector

    def search(self, asked: DataFrame, k: int, alike: bool) -> DataFrame:
        """(id, key, dim, nth, vec_id, score, rank): the k best rows with the query's label (``alike``) or another one, in each of the query's windows.

        asked: id, label, v, dim, key, windows. Lists are ordered by their upper bound, cut at the window's end; one whose bounds miss the window is skipped. A query
        meets ``FIRST`` lists, then those of the others whose bound is not strictly below the k-th score it has by then.
        """
        best_first = Window.partitionBy("id", "key", "dim", "nth").orderBy(F.desc("score"), "vec_id")
        balls = self.balls

        def meeting(low: int, high: int | None):
            def run(batches):
                for batch in batches:
                    windows = batch.column("windows").to_pylist()
                    for at, dim, q in _by_dim(batch):
                        if dim not in balls.value:  # of a dimension that the sample lacks there is one list, without a bound
                            met = [(int(i), 0) for i in at] if low == 0 else []
                        else:
                            lists, center, radius = balls.value[dim]
                            least, most = bounds(q, center, radius)
                            met = []
                            for row, i in enumerate(at.tolist()):
                                need = np.zeros(len(lists), bool)
                                for w in windows[i]:
                                    inside = (most[row] >= w["low"]) & (least[row] <= w["high"])
                                    top = np.minimum(most[row], w["high"])
                                    first = np.argsort(np.where(inside, -top, np.inf), kind="stable")
                                    chosen = np.zeros(len(lists), bool)
                                    chosen[first[low:high]] = True
                                    need |= chosen & inside & (top >= (_LEAST if w["floor"] is None else w["floor"]))
                                met += [(i, int(lists[j])) for j in np.flatnonzero(need)]
                        mine = batch.take(pa.array([i for i, _ in met], pa.int64()))
                        yield pa.RecordBatch.from_arrays([*mine.columns, pa.array([c for _, c in met], pa.int32())], names=[*mine.schema.names, "list"])

            return run

        def look(key, mine, theirs):
            out = []
            dim = key[0].as_py()
            for part in mine.to_pylist() if len(theirs) else []:
                ids, labels = np.frombuffer(part["ids"], "<i8"), np.frombuffer(part["labels"], "<i8")
                x = np.frombuffer(part["x"], part["kind"]).astype(np.float64).reshape(len(ids), dim)
                q = _matrix(theirs.column("v"), dim)
                largest = float(max(np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, dim), 1))
                scores = _dots(q, x, largest)
                rows = theirs.select(["id", "key", "label", "windows"]).to_pylist()
                for s, r in zip(scores, rows, strict=True):
                    allowed = ((labels == r["label"]) == alike) & (ids != r["id"])
                    for w in r["windows"]:
                        floor = _LEAST if w["floor"] is None else w["floor"]
                        out += [(r["id"], r["key"], dim, w["nth"], int(ids[j]), int(s[j])) for j in within(s, ids, allowed, k, floor, w["low"], w["high"])]
            return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 6, _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)

        out, columns = None, f"id long, label long, v {self.vector}, dim int, key long, windows {_WINDOW}"
        for low, high in ((0, FIRST), (FIRST, None)):
            now = asked
            if out is not None:
                floors = out.filter(F.col("rank") == k).select("id", "key", "dim", F.struct("nth", "score").alias("one")).groupBy("id", "key", "dim").agg(F.map_from_entries(F.collect_list("one")).alias("floors"))
                filled = F.transform("windows", lambda w: F.struct(w["nth"].alias("nth"), w["low"].alias("low"), w["high"].alias("high"), F.try_element_at("floors", w["nth"]).alias("floor")))
                now = asked.join(floors, ["id", "key", "dim"], "left").withColumn("windows", filled)
            met = now.select("id", "label", "v", "dim", "key", "windows").mapInArrow(meeting(low, high), columns + ", list int")
            met = written(met.join(self.sizes, ["dim", "list"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"), "lists-met")
            blocks = met.groupBy("dim", "list", "part").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
            halls = self.parts.join(blocks, ["dim", "list", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
            guests = met.join(blocks, ["dim", "list", "part"]).withColumn("block", F.pmod(F.xxhash64("id", "key"), "blocks").cast("int")).drop("blocks")
            keys = ["dim", "list", "part", "block"]
            found = halls.groupBy(*keys).cogroup(guests.groupBy(*keys)).applyInArrow(look, _FOUND)
            every = found if out is None else out.drop("rank").unionByName(found)
            out = written(every.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k), "lists-best")
        return out


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, k: int = 10, low: int = 30, high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its ``positives`` best rows of the same label, the ``k`` best
    rows of another label with ``low`` % of the positive's score <= score <= ``high`` % of it.

    The score is the inner product of floor(256 x component); higher ones come first, ties by smaller id. Rows with a null id, label or vector, or a null or non-finite
    component, take no part; vectors of different lengths are not compared. A row's own id is none of its partners; rows that repeat an id are partners as often as they are
    there, an anchor that is repeated in full is one anchor. A positive with a negative score has no window, one with score zero that of zero alone. No rows give no rows.
    Other columns are not read.

    Lists come from k-means over a bounded sample (``SAMPLE`` vectors) and hold every row, so results are exact whatever the sample. Large lists are in parts of
    ``PART_ROWS`` rows, which meet queries in blocks; nothing but centroids, radii and the sample passes the driver.
    """
    v, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`")
    valid = F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    shape = [F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"), F.size(v).alias("dim")]
    lists = Lists(vectors.filter(F.coalesce(valid, F.lit(False))).select(*shape))
    asked = written(anchors.filter(F.coalesce(valid, F.lit(False))).select(*shape).distinct().withColumn("key", F.xxhash64("label", "v")), "negatives-anchors")

    def window(nth, low, high):
        return F.struct(nth.cast("int").alias("nth"), low.alias("low"), high.alias("high"), F.lit(None).cast("long").alias("floor"))

    everything = F.array(window(F.lit(1), F.lit(_LEAST + 1).cast("long"), F.lit(2**63 - 1).cast("long")))
    near = lists.search(asked.withColumn("windows", everything), positives, True)
    # whole-number ends: low % rounded up and high % rounded down, without leaving the range of a long
    s = F.col("score")
    tens, rest = F.expr("score div 100"), s % 100
    ends = near.filter(s >= 0).select("id", "key", "dim", window(F.col("rank"), (tens * low + F.floor((rest * low + 99) / 100)).cast("long"), (tens * high + F.floor(rest * high / 100)).cast("long")).alias("one"))
    asked = asked.join(ends.groupBy("id", "key", "dim").agg(F.collect_list("one").alias("windows")), ["id", "key", "dim"])
    far = lists.search(written(asked, "negatives-asked"), k, False).select("id", "key", "dim", "nth", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.select("id", "key", "dim", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(pairs, ["id", "key", "dim", "nth"]).select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.filter("vec_id % 100 = 0"))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS alike, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (anchor_id) WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
