"""Quality classifier: interpolated modified Kneser-Ney models of trusted text, of its characters and of how its words recur, and per-language perplexity limits."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucketed, few_rows, mixed, slices, spared, table, written

#: Length of the longest n-grams, in characters.
ORDER = 5
#: Of so many trusted texts one, by a hash of its id, is kept out of the model and sets the limits.
HELD_OUT = 5
#: A language's limit: this quantile of its held-out trusted texts' scores, plus so many standard errors of their mean. Texts too few to hold the
#: quantile add a standard deviation for each factor e they lack, as tails that fall off exponentially do; the deviation is at least that of all
#: trusted texts within their languages.
QUANTILE, ERRORS = 0.995, 6
#: Characters and words at the trusted mean that are added to each text's scores, so that short texts need more evidence.
PRIOR_CHARS, PRIOR_WORDS = 60, 10
#: Least distances (in words) of the classes that a word's way back to its last occurrence falls into; the last one holds new words too.
BACK = np.array([1, 2, 3, 4, 5, 7, 9, 13, 17, 33, 65])
#: Model entries of one shard on average; a worker holds one at a time, 13 bytes an entry and up to 36 in its hash tables.
SHARD_ROWS = 250_000
#: Characters of the texts whose n-grams are looked up together.
BLOCK_CHARS = 1 << 22
#: How hard zstd packs blocks of texts and windows, which lie on disk until all values are there.
STORED_LEVEL = 9
#: Rows of an Arrow batch where rows hold blocks or shards, of up to some MB each.
BLOB_ROWS = 4
#: N-grams that meet one copy of a shard, as a multiple of its entries: copies of the model are never more than a part of what is looked up.
GRAMS_A_COPY = 32
#: Ids of trusted documents that are broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Characters that one numpy step works on; longer texts are cut, each part after the first with the context it needs.
PART_CHARS = 1 << 19
#: Width of the score steps that quantiles are counted in.
STEP = 1e-3

_ODD = np.random.default_rng(11).integers(0, 1 << 64, ORDER + 1, np.uint64, endpoint=False) | np.uint64(1)

_SPACE = re.compile(r"\s")


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and where each begins (and the last ends)."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return code, np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def keys(code: np.ndarray, k: int) -> np.ndarray:
    """For each position from k - 1 on, the key of the k characters that end there."""
    h = np.zeros(len(code) - k + 1, np.uint64)
    for i in range(k):
        h += (code[i : len(code) - k + 1 + i] + np.uint64(1)) * _ODD[k - 1 - i]  # by distance from the end
    return mixed(h + np.uint64(int(_ODD[ORDER]) * k % (1 << 64))).view(np.int64)


def parts_of(text: str) -> list[tuple[str, int]]:
    """(part, skip): the text in parts that overlap by ORDER - 1 characters; the first skip characters are context only."""
    if len(text) <= PART_CHARS:
        return [(text, 0)]
    skip = ORDER - 1
    return [(text[max(0, a - skip) : a + PART_CHARS], min(a, skip)) for a in range(0, len(text), PART_CHARS)]


def rhythm(text: str | None) -> str:
    """A letter for each word: the class of its distance to its last occurrence, cases apart no difference. Repeated words or lines read like no prose. Long texts are split part by part."""
    text, at, codes = text or "", 0, [np.zeros(0, np.int64)]
    while at < len(text):
        space = _SPACE.search(text, at + PART_CHARS)
        end = space.start() if space else len(text)
        words = text[at:end].lower().split()
        codes.append(np.fromiter(map(hash, words), np.int64, len(words)))
        at = end
    code = np.concatenate(codes)
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    back = np.full(len(code), BACK[-1])
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    return (np.searchsorted(BACK, back, side="right") + 64).astype(np.uint8).tobytes().decode()


def rhythms(trusted: DataFrame) -> DataFrame:
    """The texts' rhythms, as texts that ``estimate`` takes."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rhythm(t) for t in batch.column(0).to_pylist()], pa.string())], names=["text"])

    return trusted.select("text").mapInArrow(run, "text string")


def counts(trusted: DataFrame) -> DataFrame:
    """The distinct ORDER-grams of all trusted texts with their counts: columns c1..c5, n. Counted in each task, then summed by n-gram."""

    def run(batches):
        for batch in (b.slice(at, 256) for b in batches for at in range(0, len(b), 256)):
            texts = [p for t in batch.column(0).to_pylist() if t for p, _ in parts_of(t) if len(p) >= ORDER]
            for a, b in slices(texts, PART_CHARS):
                code, begin = characters(texts[a:b])
                inside = np.ones(len(code), bool)
                for k in range(ORDER - 1):
                    inside[begin[:-1] + k] = False
                end = np.flatnonzero(inside)
                _, at, n = np.unique(keys(code, ORDER)[end - ORDER + 1], return_index=True, return_counts=True)
                at = end[at]
                yield pa.RecordBatch.from_arrays([pa.array(code[at - ORDER + 1 + i].astype(np.int32)) for i in range(ORDER)] + [pa.array(n)], names=[*[f"c{i + 1}" for i in range(ORDER)], "n"])

    cols = [f"c{i + 1}" for i in range(ORDER)]
    each = trusted.select("text").mapInArrow(run, ", ".join(f"{c} int" for c in cols) + ", n long")
    return each.groupBy(*cols).agg(F.sum("n").alias("n"))


def _keyed(grams: DataFrame) -> DataFrame:
    """n, and of each n-gram: k1..k5, the keys of its last 1..5 characters; x1..x4, those of the 1..4 before its last."""
    names = [*[f"k{k}" for k in range(1, ORDER + 1)], *[f"x{k}" for k in range(1, ORDER)]]

    def run(batches):
        for batch in batches:
            code = np.stack([batch.column(i).to_numpy().astype(np.uint64) for i in range(ORDER)], axis=1)
            flat = code.reshape(-1)
            last = [keys(flat, k)[ORDER - k :: ORDER] if len(flat) else np.zeros(0, np.int64) for k in range(1, ORDER + 1)]
            before = [keys(flat, k)[ORDER - 1 - k :: ORDER] if len(flat) else np.zeros(0, np.int64) for k in range(1, ORDER)]
            columns = [np.ascontiguousarray(c[: len(code)]) for c in (*last, *before)]
            yield pa.RecordBatch.from_arrays([batch.column(ORDER), *map(pa.array, columns)], names=["n", *names])

    return grams.mapInArrow(run, "n long, " + ", ".join(f"{x} long" for x in names))


def discounts(counts_of_counts: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams seen once to four times; small tables fall back to 0.5, 1, 1.5."""
    n1, n2, n3, n4 = counts_of_counts
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(v, 0.05), k + 0.95) for k, v in enumerate(d))


def estimate(trusted: DataFrame) -> DataFrame:
    """The model as rows (kind, k, key, shard_key, value): kind 0 holds log probabilities of k-grams, kind 1 log back-off weights of contexts.

    Interpolated modified Kneser-Ney: the longest n-grams have their counts, shorter ones the number of characters seen before
    them; each order has three discounts, and what they take off a context goes to the next shorter one. All tables
    are joined by hashed n-gram or context, so each shard of a join holds the n-grams of its keys alone.
    An n-gram's shard_key is its two characters before the last, a context's its last two, so a text's lookups at one place share a shard.
    Each order's tables are written as they are made and the model is read from them: one plan of all joins would run 9 times the shuffle partitions as tasks
    of one stage, each of which reports the counters of every join to the driver.
    """
    top = written(_keyed(counts(trusted)), "lm-grams")
    levels: dict[int, DataFrame] = {ORDER: top.withColumnRenamed("n", "c")}
    for k in range(ORDER - 1, 0, -1):
        firsts = [F.first(f"k{j}").alias(f"k{j}") for j in range(1, k)] + [F.first(f"x{j}").alias(f"x{j}") for j in range(1, k)]
        levels[k] = written(levels[k + 1].groupBy(f"k{k}").agg(F.count("*").alias("c"), *firsts), f"lm-{k}")
    out, lower = [], None
    for k in range(1, ORDER + 1):
        rows = levels[k]
        nr = rows.agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)], F.count("*").alias("all")).first()
        d1, d2, d3 = discounts([nr[f"n{i}"] for i in range(1, 5)])
        off = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        if k == 1:
            total, took = rows.agg(F.sum("c"), F.sum(off)).first()
            total, took, kinds = total or 1, took or 0.0, nr["all"] + 1
            unseen = (took / total if nr["all"] else 1.0) / kinds
            p = rows.select("k1", ((F.col("c") - off) / total + F.lit(unseen)).alias("p"), F.lit(None).cast("long").alias("shard_key"))
            one = trusted.sparkSession.range(0, 1, 1, 1)
            out.append(one.select(*_entry(1, 0, F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(math.log(unseen)))))
        else:
            x, shard = f"x{k - 1}", (F.col("x2") if k > 2 else F.lit(None).cast("long"))
            context = rows.groupBy(x).agg(F.sum("c").alias("total"), (F.sum(off) / F.sum("c")).alias("gamma"), F.first("x2").alias("shard") if k > 2 else F.first(F.lit(None).cast("long")).alias("shard"))
            context = written(context, f"lm-context{k - 1}")
            p = rows.withColumn("off", off).join(context.select(x, "total", "gamma"), x).join(lower, f"k{k - 1}").withColumn("p", (F.col("c") - F.col("off")) / F.col("total") + F.col("gamma") * F.col("lower"))
            p = p.select(f"k{k}", "p", shard.alias("shard_key"))
            out.append(context.select(*_entry(1, k - 1, F.col(x), F.col("shard"), F.log("gamma"))))
        p = written(p, f"lm-p{k}")
        out.append(p.select(*_entry(0, k, F.col(f"k{k}"), F.col("shard_key"), F.log("p"))))
        lower = p.select(f"k{k}", F.col("p").alias("lower"))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


def _entry(kind: int, k: int, key: Column, shard_key: Column, value: Column) -> list[Column]:
    """The columns of a model's rows."""
    return [F.lit(kind).alias("kind"), F.lit(k).alias("k"), key.alias("key"), shard_key.alias("shard_key"), value.alias("value")]


class Table:
    """Values by 64-bit key: an open hash table in two numpy arrays, at most two thirds full, looked up for many keys at once."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        self.bits = max(4, int(1.5 * len(key)).bit_length())
        size = 1 << self.bits
        self.key, self.value = np.zeros(size, np.int64), np.full(size, np.nan, np.float32)  # a free slot's value is NaN
        slot, left = self._slot(key), np.arange(len(key))
        while len(left):
            free = np.isnan(self.value[slot])
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[free[first]]
            self.key[slot[first]], self.value[slot[first]] = key[left[first]], value[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & (size - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, key: np.ndarray) -> np.ndarray:
        """The values, NaN where there is none."""
        slot = self._slot(key)
        out = self.value[slot]
        open_ = np.flatnonzero((self.key[slot] != key) & ~np.isnan(out))
        while len(open_):
            slot[open_] = here = (slot[open_] + 1) & (len(self.key) - 1)
            out[open_] = self.value[here]
            open_ = open_[(self.key[here] != key[open_]) & ~np.isnan(out[open_])]
        return out


def _packed(batch: pa.RecordBatch, level: int = 1) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    raw = sink.getvalue()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def _unpacked(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), "zstd")).read_next_batch()


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points + 1 of all texts, ORDER - 1 zeros before each, and where each begins."""
    gap = ORDER - 1
    code = np.frombuffer(("\0" * gap).join(["", *texts]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes + gap * np.arange(1, len(texts) + 1)
    for k in range(1, ORDER):
        code[begin - k] = 0
    return code, begin


def ends_of(texts: list[str], skip: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The place of each character after the first ``skip`` of its text."""
    n = np.array([len(t) for t in texts], np.int64) - skip
    return np.arange(n.sum()) + np.repeat(begin + skip - (np.cumsum(n) - n), n)


def window_keys(code: np.ndarray) -> np.ndarray:
    """For each place, from the ORDER-th on, the key of the ORDER characters that end there."""
    h = np.zeros(max(0, len(code) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        h += code[i : i + len(h)] * _ODD[ORDER - 1 - i]
    return mixed(h).view(np.int64)


def _part_key(windows: np.ndarray, first: int, k: int) -> np.ndarray:
    """As ``keys``, of the k characters of each window from the first on."""
    h = np.zeros(len(windows), np.uint64)
    for i in range(k):
        h += windows[:, first + i] * _ODD[k - 1 - i]
    return mixed(h + np.uint64(int(_ODD[ORDER]) * k % (1 << 64))).view(np.int64)


def shard_of(windows: np.ndarray, of: int) -> np.ndarray:
    """The shard that scores each window's last character: by the two characters before it; 0 where there are none."""
    two = _part_key(windows, ORDER - 3, 2)
    return np.where(windows[:, ORDER - 3] > 0, (two % of + of) % of, 0)


class Shard:
    """A shard's log probabilities and back-off weights, and the unigrams and bigrams, which every shard has."""

    def __init__(self, rows: pa.RecordBatch, number: int, of: int):
        what, key, value = (rows.column(c).to_numpy() for c in range(3))
        kind, k = what >> 4, what & 15
        self.number, self.of = number, of
        self.unseen = float(value[(kind == 1) & (k == 0)][0])
        self.p = {n: Table(key[at], value[at]) for n in range(1, ORDER + 1) for at in [(kind == 0) & (k == n)]}
        self.back = {n: Table(key[at], value[at]) for n in range(1, ORDER) for at in [(kind == 1) & (k == n)]}

    def values(self, windows: np.ndarray) -> np.ndarray:
        """The log probability of each window's last character after those before it; zeros stand before the text."""
        total, left = np.zeros(len(windows)), np.arange(len(windows))
        length = (windows > 0).sum(axis=1)
        for k in range(ORDER, 0, -1):
            deep = length[left] >= k
            found = np.full(len(left), np.nan, np.float32)
            found[deep] = self.p[k].get(_part_key(windows[left[deep]], ORDER - k, k))
            seen = ~np.isnan(found)
            total[left[seen]] += found[seen]
            if k > 1:
                miss = left[deep & ~seen]
                back = self.back[k - 1].get(_part_key(windows[miss], ORDER - k, k - 1))
                total[miss] += np.where(np.isnan(back), 0, back)
            left = left[~seen]
        total[left] += self.unseen
        return total

    def score(self, texts: list[str]) -> np.ndarray:
        """Each text's log probability over the places that this shard scores."""

        def own(code: np.ndarray, ends: np.ndarray) -> np.ndarray:
            windows = code[ends[:, None] + np.arange(1 - ORDER, 1)]
            mine = np.flatnonzero(shard_of(windows, self.of) == self.number)
            out = np.zeros(len(ends))
            out[mine] = self.values(windows[mine])
            return out

        return summed(texts, own)


def summed(texts: list[str], values) -> np.ndarray:
    """For each text the sum of ``values(code, ends)``, a number for each of its characters, over bounded slices."""
    out = np.zeros(len(texts))
    for owner, parts, skip in sliced(texts):
        code, begin = padded(parts)
        ends = ends_of(parts, skip, begin)
        n = np.array([len(p) for p in parts]) - skip
        upto = np.concatenate([[0], np.cumsum(values(code, ends))])
        last = np.cumsum(n)
        np.add.at(out, owner, upto[last] - upto[last - n])
    return out


def sliced(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """(text of each part, parts, characters of each that are context only): the texts in slices of about ``PART_CHARS``."""
    cut = [(i, p, skip) for i, t in enumerate(texts) for p, skip in parts_of(t) if p]
    for a, b in slices([p for _, p, _ in cut], PART_CHARS):
        yield np.array([i for i, _, _ in cut[a:b]]), [p for _, p, _ in cut[a:b]], np.array([k for _, _, k in cut[a:b]])


def grams(texts: list[str], of: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, windows, shards) of the texts' distinct windows, rows of ORDER code points + 1, by shard and then by their characters, which packs them well."""
    key, rows = [np.zeros(0, np.int64)], [np.zeros((0, ORDER), np.uint64)]
    for _, parts, skip in sliced(texts):
        code, begin = padded(parts)
        ends = ends_of(parts, skip, begin)
        found, at = np.unique(window_keys(code)[ends - ORDER + 1], return_index=True)
        key.append(found)
        rows.append(code[ends[at][:, None] + np.arange(1 - ORDER, 1)])
    every, at = np.unique(np.concatenate(key), return_index=True)
    windows = np.concatenate(rows)[at]
    number = shard_of(windows, of)
    order = np.lexsort((*windows.T[::-1], number))
    return every[order], windows[order], number[order]


def shards(model: DataFrame) -> tuple[DataFrame, int]:
    """((shard, payload), how many): the model by shard_key in shards of about ``SHARD_ROWS``; rows without one, unigrams and bigrams, are in every shard."""
    of = max(1, -(-model.count() // SHARD_ROWS))
    rows = model.select((F.col("kind") * 16 + F.col("k")).cast("tinyint").alias("what"), "key", F.col("value").cast("float").alias("value"), "shard_key")
    number = F.when(F.col("shard_key").isNull(), F.sequence(F.lit(0), F.lit(of - 1))).otherwise(F.array(F.pmod("shard_key", F.lit(of)).cast("int")))

    def pack(key, data):
        batch = data.select(["what", "key", "value"]).combine_chunks().to_batches()[0]
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "payload": pa.array([_packed(batch)], pa.binary())})

    dealt = rows.select("what", "key", "value", F.explode(number).alias("shard"))
    return written(dealt.groupBy("shard").applyInArrow(pack, "shard int, payload binary"), "lm-shards"), of


def scored(docs: DataFrame, model: DataFrame, beat: DataFrame | None = None) -> DataFrame:
    """(doc_id, lang, chars, logp, words, beat, text_hash) of each row: beat is the log probability of its rhythm under the model of that name, 0 without one.

    Texts are read once, in blocks. A block's distinct windows go to the model's shards, each window to one, and come back with their log probabilities, which
    the block's texts, which stay in the bucket they were written to, then sum up; so nothing of the character model is gathered in one place. Null and empty texts: 0 in all four. The rhythms' model has at most
    len(BACK) ** ORDER n-grams at any size and is broadcast.
    """
    spark = docs.sparkSession
    beats = None
    if beat is not None:
        rows = beat.select((F.col("kind") * 16 + F.col("k")).cast("tinyint").alias("what"), "key", F.col("value").cast("float").alias("value")).toArrow()
        beats = spark.sparkContext.broadcast(_packed(rows.combine_chunks().to_batches()[0]))
    packed, of = shards(model)
    carried = docs.select("doc_id", "lang").schema

    def first(batches):
        second = Shard(_unpacked(beats.value), 0, 1) if beats is not None else None
        held, size = [], 0
        for batch in (b.slice(at, 64) for b in batches for at in range(0, len(b), 64)):
            held.append(batch)
            size += sum(len(t) for t in batch.column(2).to_pylist() if t)
            if size >= BLOCK_CHARS:
                yield from _block(held, second, of)
                held, size = [], 0
                spared()
        if held:
            yield from _block(held, second, of)
        spared()

    passed = docs.select("doc_id", "lang", "text").mapInArrow(first, "block long, shard int, n long, payload binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, passed = bucketed(passed, "lm_blocks", buckets, "block")
    asked = passed.filter("shard >= 0")
    count = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    copies = max(1, -(-count // (of * GRAMS_A_COPY * SHARD_ROWS)))
    none = F.lit(None)
    halls = packed.select("shard", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), none.cast("long").alias("block"), "payload")
    guests = asked.select("shard", F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int").alias("copy"), "block", "payload")

    def look_up(batches):
        shard = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] is None:
                    shard = Shard(_unpacked(row["payload"]), row["shard"], of)
                    continue
                windows = _windows(row["payload"])
                raw = shard.values(windows).astype("<f4").view(np.uint8).reshape(-1, 4)
                value = pa.RecordBatch.from_arrays([pa.array(raw[:, i].copy()) for i in range(4)], names=["b0", "b1", "b2", "b3"])  # byte by byte packs better
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([row["shard"]], pa.int32()), pa.array([_packed(value)], pa.binary())], names=["block", "shard", "payload"])
        del shard
        spared()

    met = halls.unionByName(guests).repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("block").isNotNull())
    found = met.mapInArrow(look_up, "block long, shard int, payload binary").repartition(buckets, "block")
    values = found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "payload"))).alias("found"))  # no more than there are shards
    # the texts stay where they were written: only values are dealt, to the bucket of their block
    whole = passed.filter("shard < 0").select("block", "payload").join(values.hint("shuffle_hash"), "block", "left").select("payload", F.col("found.payload").alias("values"))

    def add_up(batches):
        for batch in batches:
            for payload, parts in zip(batch.column(0), batch.column(1), strict=True):
                texts = _unpacked(payload.as_py())
                words_ = texts.column("text").to_pylist()
                value = [_floats(x) for x in parts.as_py() or ()]  # by shard, as are the windows
                known = Table(grams(words_, of)[0], np.concatenate([np.zeros(0, np.float32), *value]))
                logp = summed(words_, lambda code, ends, known=known: known.get(window_keys(code)[ends - ORDER + 1]))
                rest = [texts.column(c) for c in ("doc_id", "lang", "chars")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(logp), *[texts.column(c) for c in ("words", "beat", "text_hash")]], names=["doc_id", "lang", "chars", "logp", "words", "beat", "text_hash"])
                del texts, words_, value, known, logp, rest
                spared()
        spared()

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in carried], "chars long", "logp double", "words long", "beat double", "text_hash long"])
    try:
        with few_rows(spark, BLOB_ROWS):
            return written(whole.mapInArrow(add_up, schema), "lm-scores")
    finally:
        spark.sql(f"DROP TABLE {name}")


def _floats(payload: bytes) -> np.ndarray:
    return np.stack([c.to_numpy() for c in _unpacked(payload).columns], axis=1).reshape(-1).view("<f4")


def _windows(payload: bytes) -> np.ndarray:
    batch = _unpacked(payload)
    return np.stack([c.to_numpy() for c in batch.columns], axis=1).astype(np.uint64)


def _block(held: list[pa.RecordBatch], second: Shard | None, of: int) -> Iterator[pa.RecordBatch]:
    """A block's texts (shard -1) with what is known of them at once, and a row for each shard with the windows that it scores."""
    rows = pa.Table.from_batches(held).combine_chunks()
    texts = [t or "" for t in rows.column(2).to_pylist()]
    told = [rhythm(t) for t in texts] if second else [""] * len(texts)
    beaten = second.score(told) if second else np.zeros(len(texts))
    own = [pa.array([len(t) for t in texts], pa.int64()), pa.array([len(t) for t in told], pa.int64()), pa.array(beaten), pa.array(texts, pa.large_string())]
    hashed = pa.array(np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42) for t in texts], np.uint64).view(np.int64))  # that of Spark's xxhash64
    batch = pa.RecordBatch.from_arrays([rows.column(0).combine_chunks(), rows.column(1).combine_chunks(), *own, hashed], names=["doc_id", "lang", "chars", "words", "beat", "text", "text_hash"])
    block = uuid.uuid4().int >> 65
    out = [(-1, len(texts), _packed(batch, STORED_LEVEL))]
    _, windows, number = grams(texts, of)
    at = np.searchsorted(number, np.arange(of + 1))
    for k in np.flatnonzero(np.diff(at)).tolist():
        mine = windows[at[k] : at[k + 1]].astype(np.uint32)
        out.append((k, len(mine), _packed(pa.RecordBatch.from_arrays([pa.array(mine[:, i].copy()) for i in range(ORDER)], names=[f"c{i}" for i in range(ORDER)]), STORED_LEVEL)))
    for k, n, payload in out:
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([k], pa.int32()), pa.array([n], pa.int64()), pa.array([payload], pa.binary())], names=["block", "shard", "n", "payload"])


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that the labels call good and never bad."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` rows as (doc_id, lang, chars, score, limit, beat, beat_limit, text_hash, keep), where doc_id is not null or is.

    score is the mean negative log probability a character (log perplexity) under a model of the trusted texts, with ``PRIOR_CHARS`` characters at the
    trusted mean added; beat is the same a word for the texts' rhythms, with ``PRIOR_WORDS`` words. keep is whether both are at most the language's limits.
    The limits come from trusted texts that the models have not seen, or from all
    trusted texts where there are none. Languages without trusted texts, null among them, have the limit of all languages. Without any trusted text all rows
    stay. Null and empty texts score the mean and stay. Rows that repeat stay as often.
    """
    unseen = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    ids = written(trusted_ids(labels).withColumn("unseen", unseen), "trusted")
    few = ids.count() <= BROADCAST_IDS
    good = F.broadcast(ids) if few else ids
    trusted = docs.filter(F.col("text").isNotNull()).join(good.filter("not unseen"), "doc_id", "left_semi")
    rows = scored(docs.select("doc_id", "lang", "text"), estimate(trusted), estimate(rhythms(trusted)))
    known = written(rows.filter("chars > 0").join(good, "doc_id"), "lm-known")
    sums = known.groupBy("unseen").agg(*[F.sum(c).alias(c) for c in ("logp", "chars", "beat", "words")])
    totals = {r["unseen"]: r for r in sums.collect()}
    known = known.withColumn("judge", F.col("unseen") if True in totals else F.lit(True))
    total = totals.get(True) or totals.get(False)
    scores = {}
    for name, logp, size, prior in (("score", "logp", "chars", PRIOR_CHARS), ("beat", "beat", "words", PRIOR_WORDS)):
        mean = -total[logp] / total[size] if total and total[size] else 0.0
        scores[name] = (-F.col(logp) + prior * mean) / (F.col(size) + prior)
    rows = _limited(rows, known, scores["score"], "limit")
    rows = _limited(rows, known, scores["beat"], "beat_limit").withColumns(scores)
    within = (F.col("score") <= F.col("limit")) & (F.col("beat") <= F.col("beat_limit"))
    return rows.select("doc_id", "lang", "chars", "score", "limit", "beat", "beat_limit", "text_hash", F.coalesce(within, F.lit(True)).alias("keep"))


def _limited(rows: DataFrame, known: DataFrame, score: Column, name: str) -> DataFrame:
    """``rows`` with the limit of each row's language, or of all languages where it has none."""
    limits, overall = quantiles(known.select("lang", "judge", score.alias("score")))
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return rows.join(F.broadcast(limits) if limits.count() <= BROADCAST_IDS else limits, "lang", "left").withColumn(name, limit).drop("own")


def quantiles(known: DataFrame) -> tuple[DataFrame, float | None]:
    """((lang, own), overall): the limit of each language and of all rows, from the rows that judge; the others tell only how far scores spread.

    Scores are counted in steps of ``STEP`` in each task, and a language's counts, bounded by its steps, are put together from the tasks'; no row is gathered or
    sorted.
    """
    steps = known.withColumn("step", F.ceil(F.col("score") / STEP).cast("double"))
    x, judge = F.col("step"), F.col("judge")
    at = F.expr(f"percentile_disc({QUANTILE}) WITHIN GROUP (ORDER BY CASE WHEN judge THEN step END)").alias("at")
    mine = F.when(judge, x)
    sums = [at, F.count(mine).alias("count"), F.sum(mine).alias("sum"), F.sum(mine * mine).alias("squared"), F.count("*").alias("all")]
    sums += [F.coalesce(F.sum(F.when(~judge, 1.0)), F.lit(0.0)).alias("others"), F.coalesce(F.sum(F.when(~judge, x)), F.lit(0.0)).alias("other_sum"), F.coalesce(F.sum(F.when(~judge, x * x)), F.lit(0.0)).alias("other_squared")]

    def apart(n: Column, total: Column, squared: Column) -> Column:
        return F.when(n > 0, squared - total * total / n).otherwise(0.0)

    own = apart(F.col("count"), F.coalesce("sum", F.lit(0.0)), F.coalesce("squared", F.lit(0.0)))
    both = own + apart(F.col("others"), F.col("other_sum"), F.col("other_squared"))
    by_lang = written(steps.filter("lang is not null").groupBy("lang").agg(*sums).withColumns({"squares": own, "both": both}), "lm-quantiles")
    every = steps.agg(*sums).withColumns({"squares": own, "both": both}).first()
    total = by_lang.agg(F.sum("both").alias("both"), F.sum("all").alias("all")).first()
    pooled = (total["both"] if total["all"] else every["both"]) / max(1, (total["all"] or every["all"]))
    beyond = F.greatest(F.lit(0.0), -F.log((1 - QUANTILE) * F.col("count"))) + ERRORS / F.sqrt("count")
    limit = (F.col("at") + beyond * F.sqrt(F.greatest(F.col("squares") / F.col("count"), F.lit(pooled), F.lit(0.0)))) * STEP
    limits = by_lang.filter("count > 0").select("lang", limit.alias("own"))
    if not every["count"]:
        return limits, None
    return limits, known.sparkSession.createDataFrame([every]).select(limit.alias("own")).first()["own"]


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they are. A row is known by its id and its text: of rows that repeat an id those with a rejected text go, and rows without an id too."""
    bad = classified(docs, labels).filter("not keep").select(F.col("doc_id").alias("bad_id"), F.col("lang").alias("bad_lang"), F.col("text_hash").alias("bad_hash")).distinct()
    bad = written(bad, "rejected")
    few = F.broadcast(bad) if bad.count() <= BROADCAST_IDS else bad
    same = docs["doc_id"].eqNullSafe(F.col("bad_id")) & docs["lang"].eqNullSafe(F.col("bad_lang")) & (F.xxhash64(docs["text"]) == F.col("bad_hash"))
    return docs.join(few, same, "left_anti")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    found = classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.filter("keep").select("doc_id", "lang", "chars", F.round(F.exp("score"), 4).alias("perplexity"), F.round(F.exp("limit"), 4).alias("limit"))
