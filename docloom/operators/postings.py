"""A positional inverted index of documents: postings of (word, document, positions) dealt by word, and a lexicon of the words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import uris
from ..plans import search
from ..shared import bounded

#: Postings are dealt by word into so many folders; a search for words reads theirs alone.
TERM_BUCKETS = 32
#: Places of words that a task hands on at once.
PLACES = 1 << 18
#: The words of the whole document stand under this name, those of a property or element under its own.
WHOLE = ""
#: The columns of the files, and of the folders they are in.
POSTINGS = "within string, term string, URI string, positions array<int>, commit string, bucket int"
LEXICON = "bucket int, within string, term string, documents long, occurrences long, commit string"


def term_bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


def fields(text: Column, uri: Column, kind: Column) -> Column:
    """(within, text) of the whole document and of each JSON property or XML element that has a text of its own."""
    json_names = F.regexp_extract_all(text, F.lit(r'"((?:[^"\\]|\\.)*+)"\s*:'), F.lit(1))
    tags = F.regexp_extract_all(text, F.lit(r"<([^\s<>/!?]++)"), F.lit(1))
    names = F.array_distinct(F.concat(json_names, tags, F.transform(tags, lambda t: F.regexp_replace(t, r"^\w+:", ""))))
    whole = F.struct(F.lit(WHOLE).alias("within"), search.plain_text(text, uris.format_of(uri, kind)).alias("text"))
    each = F.transform(F.filter(names, lambda n: n != ""), lambda n: F.struct(n.alias("within"), search.property_text(text, n).alias("text")))
    return F.concat(F.array(whole), F.filter(each, lambda f: f["text"] != ""))


def of(documents: DataFrame) -> DataFrame:
    """(within, term, URI, positions) of each word of each document row; words and their places are those that ``search.has_words`` compares.

    A document's words are put together in the task that reads it, so no row a word's place is shuffled."""
    text = F.decode(F.coalesce("content", F.lit(b"")), "UTF-8")
    bounded(documents.sparkSession)
    each = documents.select("URI", F.explode(fields(text, F.col("URI"), F.col("format"))).alias("f"))
    words = F.trim(F.regexp_replace(F.lower("f.text"), f"{search._OUT}++", " "))
    return each.select("f.within", "URI", words.alias("words")).filter("words <> ''").mapInArrow(_listed, "within string, term string, URI string, positions array<int>")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of each word of (within, URI, words by spaces), a batch for some texts at a time."""
    for batch in batches:
        owner, terms, sizes, places = [], [], [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            found: dict[str, list[int]] = {}
            for at, word in enumerate(text.split(" ")):
                if word in found:
                    found[word].append(at)
                else:
                    found[word] = [at]
            owner.append(np.full(len(found), i))
            terms += found
            sizes += map(len, found.values())
            places += chain.from_iterable(found.values())
            if len(places) >= PLACES or i + 1 == len(batch):
                at = pa.array(np.concatenate(owner))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(places, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(terms, pa.string()), batch.column(1).take(at), lists], names=["within", "term", "URI", "positions"])
                owner, terms, sizes, places = [], [], [], []


def write(documents: DataFrame, postings: str, lexicon: str) -> None:
    """Writes the postings and the lexicon of a commit's document rows.

    A word's postings are dealt by URI too, so a word that every document has is not one task's work; within a file they are sorted by word, which lets a
    reader pass over most of it. One shuffle, of a row a word of a document.
    """
    spark = documents.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    dealt = of(documents).withColumns({"bucket": term_bucket(F.col("term")), "part": F.pmod(F.xxhash64("URI"), F.lit(parts))})
    listed = dealt.repartition(TERM_BUCKETS * 4, "bucket", "part").drop("part")
    listed.sortWithinPartitions("bucket", "within", "term", "URI").write.partitionBy("bucket").parquet(postings)
    words = spark.read.schema(POSTINGS).parquet(postings).groupBy("bucket", "within", "term").agg(F.count("*").alias("documents"), F.sum(F.size("positions")).cast("long").alias("occurrences"))
    words.repartitionByRange("within", "term").sortWithinPartitions("within", "term").write.parquet(lexicon)


@dataclass(frozen=True)
class Slot:
    """A word of a query, or the start of words."""

    within: str
    word: str

    @property
    def open(self) -> bool:
        return self.word.endswith("*")

    def holds(self) -> Column:
        term = F.col("term").startswith(self.word[:-1]) if self.open else F.col("term") == self.word
        return (F.col("within") == self.within) & term


def slots_of(word: search.Word, filtered: bool) -> tuple[Slot, ...]:
    """The words of a leaf. Unfiltered, a property's words may stand anywhere."""
    within = word.within if word.within and filtered else WHOLE
    return tuple(Slot(within, w) for w in re.findall(r"[^\W_]+\*?", word.text.lower()))


def leaves(query) -> list[search.Word]:
    if isinstance(query, search.Word):
        return [query]
    if isinstance(query, search.Not):
        return leaves(query.part)
    return [w for p in getattr(query, "parts", ()) for w in leaves(p)]


def needs_words(query) -> bool:
    """Whether no document without any of the query's words can match it."""
    if isinstance(query, search.Word):
        return bool(re.search(r"[^\W_]", query.text))
    if isinstance(query, search.Both):
        return any(map(needs_words, query.parts))
    if isinstance(query, search.Either):
        return bool(query.parts) and all(map(needs_words, query.parts))
    return False


def hits(postings: DataFrame, lexicon: DataFrame, wanted: list[tuple[Slot, ...]]) -> DataFrame:
    """(URI, commit, l0, l1, ...): for each document with any of the words whether the i-th phrase stands in it.

    One scan, of the words' folders and within them of the files' parts that can hold them, and one aggregation by document for all phrases: positions of a phrase's words, each
    moved back by its place, have a common one. The folders of open words come from the lexicon; there are at most ``TERM_BUCKETS``.
    """
    slots = list(dict.fromkeys(s for phrase in wanted for s in phrase))
    if not slots:
        return postings.select("URI", "commit", *[F.lit(True).alias(f"l{i}") for i in range(len(wanted))]).limit(0)
    folder = F.lit(False)
    for s in slots:
        if not s.open:
            folder = folder | (F.col("bucket") == term_bucket(F.lit(s.word)))
    if starts := [s for s in slots if s.open]:
        some = lexicon.filter(reduce(lambda a, b: a | b, [s.holds() for s in starts])).select("bucket").distinct()
        folder = folder | F.col("bucket").isin(*[r[0] for r in some.collect()])
    any_ = reduce(lambda a, b: a | b, [s.holds() for s in slots])
    found = postings.filter(folder & any_).select("URI", "commit", *[F.when(s.holds(), F.col("positions")).alias(f"s{i}") for i, s in enumerate(slots)])
    by_document = found.groupBy("URI", "commit").agg(*[F.flatten(F.collect_list(f"s{i}")).alias(f"s{i}") for i in range(len(slots))])

    def moved(positions: str, back: int) -> Column:
        return F.transform(positions, lambda p: p - back) if back else F.col(positions)

    def stands(phrase: tuple[Slot, ...]) -> Column:
        if not phrase:
            return F.lit(True)
        return F.size(reduce(F.array_intersect, [moved(f"s{slots.index(s)}", k) for k, s in enumerate(phrase)])) > 0

    return by_document.select("URI", "commit", *[stands(p).alias(f"l{i}") for i, p in enumerate(wanted)])
