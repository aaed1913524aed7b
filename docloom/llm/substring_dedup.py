"""Substring dedup: suffix automata over shards of passages, whose matching statistics say which runs of words stand in an earlier document."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, gone, hot_keys, mixed, slices, stored, table, written

#: Words of a window: a shared run is removed from this length on.
WORDS = 13
#: Words of an anchor, the gram with the least hash in a window.
GRAM = 5
#: An anchor in more documents than this is looked at window by window.
HOLDERS = 256
#: Words of a shard's passages, on average.
SHARD_WORDS = 1 << 16
#: Rows that follow each other in the input and are handled together: 2 to the power of this.
PART_BITS = 12
#: Bytes of a text that are hashed at once.
PART_BYTES = 1 << 20

_POWER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))
_ODD = np.random.default_rng(12).integers(0, 1 << 64, 1 << 10, np.uint64, endpoint=False) | np.uint64(1)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, 9, 10, 11, 12, 13]] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _POWER), np.full(n + 1, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_TABLES = _powers(1 << 12)


def parts_of(raw: bytes) -> Iterator[bytes]:
    """A text's bytes in parts of about ``PART_BYTES``, cut at white space."""
    at = 0
    while len(raw) - at > PART_BYTES:
        flags = np.flatnonzero(~_IN_WORD[np.frombuffer(raw, np.uint8, PART_BYTES, at)])
        end = at + int(flags[-1]) if len(flags) else next((i for i in range(at + PART_BYTES, len(raw)) if not _IN_WORD[raw[i]]), len(raw))
        yield raw[at:end]
        at = end
    yield raw[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the texts in order, and where each text's words begin."""
    found, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    held, owner, size = [], [], 0

    def flush() -> None:
        global _TABLES
        raw = np.frombuffer(b" ".join(held) + b" ", np.uint8)
        if len(raw) >= len(_TABLES[0]):
            _TABLES = _powers(2 * len(raw))
        edge = np.flatnonzero(np.diff(_IN_WORD[raw], prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _TABLES[0][: len(raw)], dtype=np.uint64)])
        found.append(mixed((run[ends] - run[starts]) * _TABLES[1][starts]))
        begin = np.concatenate([[0], np.cumsum([len(p) + 1 for p in held])])
        np.add.at(counts, owner, np.diff(np.searchsorted(starts, begin)))

    for k, text in enumerate(texts):
        for part in parts_of(text):
            held.append(part)
            owner.append(k)
            size += len(part)
            if size > 2 * PART_BYTES:
                flush()
                held, owner, size = [], [], 0
    if held:
        flush()
    return np.concatenate(found), np.concatenate([[0], np.cumsum(counts)])


def _runs_of(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n words in a row."""
    size = max(0, len(h) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n if size else 0):
        out += h[k : k + size] * _ODD[k % len(_ODD)] + np.uint64(k)
    return mixed(out)


def anchors_of(h: np.ndarray, words: int) -> np.ndarray:
    """For each window of the words, the least hash of a gram in it: equal windows have equal anchors, and neighbours mostly share theirs."""
    grams = _runs_of(h, min(GRAM, words))
    width, have, best = words - min(GRAM, words) + 1, 1, grams
    while 2 * have <= width and len(best) > have:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    size = max(0, len(h) - words + 1)
    return np.minimum(best[:size], best[width - have : width - have + size]) if size else np.zeros(0, np.uint64)


def windows_of(begin: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, text) of each window that lies within one text."""
    count = np.maximum(np.diff(begin) - words + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    return np.arange(len(text)) - first[text] + begin[:-1][text], text


def _distinct(key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (key, text) pairs."""
    if len(key):
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])])
        key, text = key[new], text[new]
        order = np.lexsort((key, text))
        key, text = key[order], text[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])])
        key, text = key[new], text[new]
    return key, text


class Automaton:
    """A suffix automaton of several word sequences; each state holds the least number of the documents its sequences stand in."""

    def __init__(self, sequences: Iterable[tuple[list, int]]):
        follow, link, length, least = [{}], [-1], [0], [None]
        for words, doc in sequences:
            last = 0
            for c in words:
                p, q = last, follow[last].get(c)
                if q is None:
                    last = len(follow)
                    follow.append({})
                    length.append(length[p] + 1)
                    link.append(0)
                    least.append(doc)
                    while p >= 0 and c not in follow[p]:
                        follow[p][c] = last
                        p = link[p]
                    if p < 0:
                        continue
                    q, end = follow[p][c], last
                else:
                    end = None
                if length[p] + 1 != length[q]:  # the sequences up to this length part from the longer ones
                    copy = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    least.append(None)
                    while p >= 0 and follow[p].get(c) == q:
                        follow[p][c] = copy
                        p = link[p]
                    link[q] = copy
                    q = copy
                if end is None:
                    last = q
                    if least[q] is None or doc < least[q]:
                        least[q] = doc
                else:
                    link[end] = q
        for state in sorted(range(1, len(link)), key=length.__getitem__, reverse=True):
            up, doc = link[state], least[state]
            if up > 0 and doc is not None and (least[up] is None or doc < least[up]):
                least[up] = doc
        self.follow, self.link, self.length, self.least = follow, link, length, least

    def earliest(self, words: list, n: int) -> list[int | None]:
        """For each n words in a row, the least document they stand in, or None: the match that ends at a word is kept at n words or a little more."""
        follow, link, length, least = self.follow, self.link, self.length, self.least
        out, state, matched = [], 0, 0
        for i, c in enumerate(words):
            while state and c not in follow[state]:
                state = link[state]
                matched = length[state]
            state = follow[state].get(c, 0)
            matched = matched + 1 if state else 0
            while state and length[link[state]] >= n:
                state = link[state]
                matched = length[state]
            if i >= n - 1:
                out.append(least[state] if matched >= n else None)
        return out


def _shared(pairs: DataFrame, parts: int) -> DataFrame:
    """Of the distinct (anchor, rid) pairs, those whose anchor stands in several rows: with n, the number of rows, and home, the least of them.

    Anchors with over a quarter of a partition's share, at most 4 times the partitions, are counted where they are and broadcast; the others meet in windows.
    """
    hot = hot_keys(pairs, ["anchor"], pairs.count(), parts, F.min("rid").alias("home"))
    if one := pairs.select("anchor").first():  # some anchor is always among them, so the plan is the same with and without hot ones
        some = pairs.filter(F.col("anchor") == one[0]).groupBy("anchor").agg(F.count("*").alias("n"), F.min("rid").alias("home"))
        hot = hot.unionByName(some)
    hot = hot.groupBy("anchor").agg(F.max("n").alias("all"), F.min("home").alias("first"))
    met = pairs.join(F.broadcast(hot), "anchor", "left")
    among = Window.partitionBy("anchor", F.when(F.col("all").isNotNull(), F.col("rid")))  # rows of a hot anchor don't meet
    n, home = F.coalesce("all", F.count("*").over(among)), F.coalesce("first", F.min("rid").over(among))
    return met.withColumns({"n": n, "home": home}).select("anchor", "rid", "n", "home").filter(F.col("n") > 1)


def deduplicated(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed) for each row: the words of the text that stay, joined by one space, and the word ranges [start, end) that go.

    A word is what lies between white space (space, tab to carriage return), taken as it is. It goes if a window of ``words`` words over it also starts in a document
    with a smaller id; windows are judged on the input. A null text has no words. A null id is no smaller than any and has no smaller one: nothing goes from such a
    row. Rows that repeat an id are of one document. Empty tables give no rows. Other columns are not read, and no column name clashes.

    Each window has an anchor, its five words of least hash. Windows whose anchor stands in one row alone can't repeat and go no further. The others make passages: runs of windows whose anchors
    have the same home, the first row with the anchor. For an anchor in over ``HOLDERS`` rows the windows themselves are counted, and their homes taken. Passages are dealt into shards by home, equal
    ones once; a suffix automaton of each shard's passages gives, as they stream through it, the earliest document of each window. An
    automaton is built where its shard's passages are: broadcast to all, the automata would hold the corpus's repeats on each executor, and each document would meet them all.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("raw"), F.monotonically_increasing_id().alias("rid"))
    name, base = bucketed(base.withColumn("part", F.shiftright("rid", PART_BITS)), "spans_base", parts, "part")
    of = F.shiftright("rid", PART_BITS).alias("part")

    def first(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                h, begin = word_hashes([t or b"" for t in texts[a:b]])
                start, text = windows_of(begin, words)
                key, text = _distinct(anchors_of(h, words)[start], text)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0).slice(a, b - a).take(pa.array(text))], names=["anchor", "rid"])

    def found(docs, hits):
        """(doc_id, rid, text, window hashes, of each window whether an anchor hit, its home or anchor) of the rows with hits."""
        ids, anchors, homes = (hits.column(c).to_numpy() for c in ("rid", "anchor", "home"))
        order = np.lexsort((anchors, ids))
        ids, anchors, homes = ids[order], anchors[order], homes[order]
        rows = docs.select(["rid", "doc_id", "raw"]).filter(pa.compute.is_in(docs.column("rid"), pa.array(np.unique(ids))))
        texts = rows.column("raw").to_pylist()
        for a, b in slices(texts):
            h, begin = word_hashes(texts[a:b])
            every = anchors_of(h, words).view(np.int64)
            for k in range(a, b):
                rid, doc = rows.column("rid")[k].as_py(), rows.column("doc_id")[k].as_py()
                low, high = np.searchsorted(ids, [rid, rid + 1])
                own = slice(int(begin[k - a]), max(int(begin[k - a]), int(begin[k - a + 1]) - words + 1))
                yield doc, rid, texts[k], h[int(begin[k - a]) : int(begin[k - a + 1])], every[own], anchors[low:high], homes[low:high]

    def second(key, docs, hits):
        """The distinct hashes of the windows whose anchor is among the hits."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for _, rid, _, h, anchor, known, _ in found(docs, hits) if len(hits) else []:
            own, _ = _distinct(_runs_of(h, words).view(np.int64)[np.isin(anchor, known)], np.zeros(1, np.int64).repeat(int(np.isin(anchor, known).sum())))
            out.append((own, np.full(len(own), rid)))
        return pa.table({"anchor": np.concatenate([x for x, _ in out]), "rid": np.concatenate([x for _, x in out])})

    def passages(key, docs, hits):
        """The runs of windows with one home: (shard, words, doc_id, rid, start)."""
        out = []
        for doc, rid, text, h, anchor, known, homes in found(docs, hits) if len(hits) else []:
            home = np.full(len(anchor), -1, np.int64)
            for seen in (anchor, _runs_of(h, words).view(np.int64)):  # a window's own hash says more than its anchor
                at = np.minimum(np.searchsorted(known, seen), len(known) - 1)
                home = np.where(known[at] == seen, homes[at], home)
            edge = np.flatnonzero(np.diff(home, prepend=-2, append=-2))
            runs = [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if home[a] >= 0]
            split = text.split() if runs else []
            out += [(int(home[a]), b" ".join(split[a : b + words - 1]), doc, rid, a) for a, b in runs]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["home", "words", "doc_id", "rid", "start"])

    def matched(key, data):
        """Of each passage, the runs of windows with one earliest document."""
        number: dict[bytes, int] = {}
        texts = [[number.setdefault(w, len(number)) for w in t.split()] for t in data.column("words").to_pylist()]
        automaton = Automaton(zip(texts, data.column("doc").to_pylist(), strict=True))
        runs = []
        for text in texts:
            docs = automaton.earliest(text, words)
            cut = [0, *[i for i in range(1, len(docs)) if docs[i] != docs[i - 1]], len(docs)]
            runs.append([{"first": a, "last": b - 1, "doc": docs[a]} for a, b in zip(cut[:-1], cut[1:], strict=True)])
        return pa.table({"k1": data.column("k1"), "k2": data.column("k2"), "runs": pa.array(runs, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("doc", pa.int64())])))})

    def cleaned(key, docs, spans):
        of_row: dict[int, list] = {}
        for r in spans.to_pylist():
            of_row.setdefault(r["rid"], []).extend(r["spans"])
        out = []
        for rid, doc, raw in zip(*(docs.column(c).to_pylist() for c in ("rid", "doc_id", "raw")), strict=True):
            split = (raw or b"").split()
            cut = []
            if rid in of_row:
                cover = np.zeros(len(split) + 1, np.int32)
                for s in of_row[rid]:
                    cover[s["first"]] += 1
                    cover[s["last"] + words] -= 1
                edge = np.flatnonzero(np.diff((np.cumsum(cover[:-1]) > 0).astype(np.int8), prepend=0, append=0))
                cut = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
            stay = [x for a, b in zip([0, *[b for _, b in cut]], [*[a for a, _ in cut], len(split)], strict=True) for x in split[a:b]]
            out.append((doc, len(split), len(split) - len(stay), b" ".join(stay).decode("utf-8", "replace"), [{"start": a, "end": b} for a, b in cut]))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept", "removed"])

    def by_part(other: DataFrame, f, schema: str) -> DataFrame:
        return base.groupBy("part").cogroup(other.groupBy("part")).applyInArrow(f, schema)

    try:
        path, pairs = stored(base.filter("doc_id IS NOT NULL").select("rid", "raw").mapInArrow(first, "anchor long, rid long"), "spans-anchors")
        hits = written(_shared(pairs, parts).select(of, "rid", "anchor", F.when(F.col("n") <= HOLDERS, F.col("home")).alias("home")), "spans-hits")
        gone(spark, path)
        path, pairs = stored(by_part(hits.filter("home IS NULL"), second, "anchor long, rid long"), "spans-windows")
        more = _shared(pairs, parts).select(of, "rid", "anchor", "home")
        pieces = by_part(hits.filter("home IS NOT NULL").unionByName(more), passages, "home long, words binary, doc_id long, rid long, start int")
        pieces = written(pieces.withColumns({"k1": F.xxhash64("words"), "k2": F.xxhash64(F.lit(1), "words")}), "spans-passages")
        gone(spark, path)
        length = pieces.select(F.sum(F.octet_length("words"))).first()[0] or 0
        shards = max(1, -(-length // (7 * SHARD_WORDS)))
        shard = F.pmod(F.xxhash64("home"), F.lit(shards)).alias("shard")
        once = pieces.groupBy(shard, "words", "k1", "k2").agg(F.min("doc_id").alias("doc"))
        known = once.groupBy("shard").applyInArrow(matched, "k1 long, k2 long, runs array<struct<first:int,last:int,doc:long>>")
        met = pieces.select("k1", "k2", "doc_id", "rid", "start").join(known, ["k1", "k2"])
        earlier = F.filter("runs", lambda r: r["doc"] < F.col("doc_id"))
        spans = met.select(of, "rid", F.transform(earlier, lambda r: F.struct((r["first"] + F.col("start")).alias("first"), (r["last"] + F.col("start")).alias("last"))).alias("spans"))
        spans = written(spans.filter(F.size("spans") > 0), "spans")
        return written(by_part(spans, cleaned, "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>"), "spans-kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = deduplicated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT r, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE doc_id IS NOT NULL AND len(w) >= 13)),
m AS (SELECT g, min(doc_id) AS least FROM s GROUP BY g),
h AS (SELECT r, list(DISTINCT j) AS gone FROM (SELECT r, unnest(range(i, i + 13)) AS j FROM s JOIN m USING (g) WHERE least < doc_id) GROUP BY r),
k AS (
  SELECT doc_id, len(w) AS n, coalesce(len(gone), 0) AS removed, list_filter(w, lambda x, i: NOT coalesce(list_contains(gone, i), false)) AS kept FROM d LEFT JOIN h USING (r))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(removed AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
