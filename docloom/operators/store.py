"""A document store in parquet: immutable files, one manifest a version, the last write of a URI wins."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ..options import Options
from ..plans import search
from ..schemas import DOCUMENT, METADATA
from ..shared import kept
from . import postings

#: Documents are dealt by URI into so many folders, which lets a lookup of URIs read only some of them.
BUCKETS = 16
#: Commits after which they are folded into one.
FOLD = 64
#: The columns of a commit's files, and of the folders they are in.
DATA = StructType([*DOCUMENT.fields, StructField("deleted", BooleanType()), StructField("commit", StringType()), StructField("bucket", IntegerType())])
#: So many documents are fetched by name; more by a join.
NAMED = 1000


class Store:
    """Documents under a path. A reader sees the version it opened, whatever is written meanwhile; a version is made visible by one rename that never overwrites.

    With ``index`` each commit also has postings of its words (see ``postings``), and searches read those and the documents they find. Commits are folded into one
    after ``fold`` of them.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, index: bool = False, fold: int = FOLD):
        self.spark, self.path, self.buckets, self.index, self.fold = spark, path.rstrip("/"), buckets, index, fold
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # manifests

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        folder = self._path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        return sorted(int(f.getPath().getName()[:-5]) for f in self._fs.listStatus(folder) if f.getPath().getName().endswith(".json") and not f.getPath().getName().startswith("."))

    def latest(self) -> int:
        """The newest version; 0 for an empty store."""
        return max(self.versions(), default=0)

    def _commits(self, version: int) -> list[dict]:
        if version == 0:
            return []
        text = self.spark.read.text(self._manifest(version), wholetext=True).first()[0]
        return json.loads(text)["commits"]

    def _publish(self, version: int, commits: list[dict]) -> bool:
        """Writes a manifest beside its place and renames it; False if another writer has published that version, whose manifest stays."""
        target, draft = self._path(self._manifest(version)), self._path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps({"version": version, "commits": commits}).encode()))
        out.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never_over = gateway.new_array(option, 1)
        never_over[0] = option.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(self._fs.makeQualified(draft), self._fs.makeQualified(target), never_over)
        except Exception:
            if not self._fs.exists(target):
                raise
            self._fs.delete(draft, False)
            return False
        return True

    def _append(self, commit: dict) -> int:
        """Publishes one more commit after those that are there by then: writers at the same time follow each other."""
        for _ in range(100):
            before = self.latest()
            if self._publish(before + 1, [*self._commits(before), commit]):
                return before + 1
        raise RuntimeError("other writers were faster a hundred times")

    # reading

    def _parts(self, commits: list[dict], kind: str = "data") -> DataFrame:
        schema = {"data": DATA, "postings": postings.POSTINGS, "lexicon": postings.LEXICON}[kind]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{kind}/commit={c['id']}" for c in commits])

    def _live(self, commits: list[dict], parts: DataFrame) -> DataFrame:
        """Of the rows of each URI those of its last commit, deletions left out. Which commit that is is settled on the URIs alone."""
        if len(commits) > 1:
            order = F.create_map(*[x for n, c in enumerate(commits) for x in (F.lit(c["id"]), F.lit(n))])
            parts = parts.withColumn("__order", F.element_at(order, F.col("commit")))
            again = parts.groupBy("URI").agg(F.max("__order").alias("__last"), F.min("__order").alias("__first")).filter("__first < __last").select("URI", "__last")
            parts = parts.join(again, "URI", "left").filter("__last is null or __last = __order")
        return parts.filter("not deleted")

    def read(self, version: int | None = None, buckets: list[int] | None = None, uris: list[str] | None = None) -> DataFrame:
        """Document rows of a version, of some buckets or URIs or all. A document without content has none, not null.

        Content is read where its URI's last commit is, and not sorted."""
        commits = self._commits(self.latest() if version is None else version)
        if not commits:
            return self.spark.createDataFrame([], DOCUMENT)
        parts = self._parts(commits)
        if buckets is not None:
            parts = parts.filter(F.col("bucket").isin(*buckets)) if buckets else parts.limit(0)
        if uris is not None:
            parts = parts.filter(F.col("URI").isin(*uris)) if uris else parts.limit(0)
        return self._live(commits, parts).select("URI", F.coalesce("content", F.lit(b"")).alias("content"), *DOCUMENT.names[2:])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("URI"), F.lit(self.buckets)).cast("int")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows for writing: each bucket in as many tasks, and so files, as there are shuffle partitions for it; sorted by URI, so that a few URIs are found by the files' statistics."""
        each = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        return rows.repartition(self.buckets * each, "bucket", F.pmod(F.xxhash64("URI", F.lit(1)), F.lit(each))).sortWithinPartitions("bucket", "URI")

    def indexed(self, version: int | None = None) -> bool:
        """Whether all commits of the version have postings."""
        commits = self._commits(self.latest() if version is None else version)
        return bool(commits) and all(c.get("index") for c in commits)

    def postings(self, version: int | None = None) -> DataFrame:
        """(URI, within, term, positions, commit, bucket) of an indexed version's commits, of earlier forms of documents too."""
        return self._parts(self._commits(self.latest() if version is None else version), "postings")

    def lexicon(self, version: int | None = None) -> DataFrame:
        """(within, term, documents, occurrences) of an indexed version's commits, summed over them."""
        words = self._parts(self._commits(self.latest() if version is None else version), "lexicon")
        return words.groupBy("within", "term").agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("occurrences"))

    def located(self, query, filtered: bool = True, version: int | None = None) -> DataFrame:
        """(URI) of the documents that a search tree selects, from the index: postings, and the URIs and collections of what they name; no content is read."""
        version = self.latest() if version is None else version
        commits = self._commits(version)
        words = list(dict.fromkeys(postings.leaves(query)))
        found = postings.hits(self._parts(commits, "postings"), self._parts(commits, "lexicon"), [postings.slots_of(w, filtered) for w in words])
        parts = self._parts(commits).select("URI", "collections", "deleted", "commit")
        needed = postings.needs_words(query)
        if needed:  # no document without hits can match
            parts = parts.join(found.select("URI").distinct(), "URI", "left_semi")
        live = self._live(commits, parts).join(found, ["URI", "commit"], "inner" if needed else "left")

        def of_word(word: search.Word) -> Column:
            if not postings.slots_of(word, filtered):
                return F.lit(True)
            return F.coalesce(F.col(f"l{words.index(word)}"), F.lit(False))

        return live.filter(search.condition(query, of_word, F.col("URI"), F.col("collections"))).select("URI")

    def search(self, options: Options | dict | None = None, constraints=search.Constraints(), version: int | None = None) -> DataFrame:
        """Rows that the ``read.documents.*`` options select, with the categories they ask for.

        An indexed store reads the postings of the words, then the documents they name: few by their URIs, more by a join. Filtered, the tree is applied to those
        documents again; unfiltered, the index has the last word.
        """
        options = Options.of(options)
        query, filtered = search.of_options(options, constraints), options.flag("read.documents.filtered", True)
        version = self.latest() if version is None else version
        if not (postings.leaves(query) and self.indexed(version)):
            return categories(search.matching(self.read(version), query, filtered), options)
        uris = kept(self.located(query, filtered, version), "located")
        rows = self.lookup(uris, version)
        return categories(search.matching(rows, query, True) if filtered else rows, options)

    def lookup(self, uris: DataFrame, version: int | None = None) -> DataFrame:
        """Rows of the URIs in a (URI) table: of up to ``NAMED`` by name, of more by a semi join over their buckets alone, broadcast only if Spark finds the table small."""
        uris = uris.select("URI").distinct()
        some = uris.select("URI", self.bucket().alias("bucket")).limit(NAMED + 1).collect()
        if len(some) <= NAMED:
            return self.read(version, sorted({r["bucket"] for r in some}), [r["URI"] for r in some])
        buckets = [r[0] for r in uris.select(self.bucket()).distinct().collect()]  # no more than there are buckets
        return self.read(version, buckets).join(uris, "URI", "left_semi")

    # writing

    def write(self, rows: DataFrame, merge_metadata: bool = False, order: str | None = None) -> dict[str, int]:
        """Adds document rows as a new version; within one write the row of a URI with the greatest ``order`` wins, without an order the last of the input as it is split
        (so rows that were shuffled before need one). Null content changes metadata alone."""
        before = self.latest()
        if "content" in rows.columns and merge_metadata and before:
            old = self.read(before).select("URI", F.col("content").alias("__content"), F.col("format").alias("__format"))
            rows = rows.join(old, "URI", "left").withColumn("content", F.coalesce("content", "__content")).withColumn("format", F.coalesce("format", "__format")).drop("__content", "__format")
        if "deleted" not in rows.columns:
            rows = rows.withColumn("deleted", F.lit(False))
        one = last_of_each(rows, order=order)
        one = (one.drop(order) if order and order not in DOCUMENT.names else one).withColumn("bucket", self.bucket())
        watch = Observation(f"written-{uuid.uuid4().hex}")
        commit = self._stored(one.observe(watch, F.count("*").alias("n")))
        written = watch.get["n"]
        if written:
            self._append(commit | {"rows": written})
            if len(self._commits(self.latest())) >= self.fold:
                self.compact()
        return {"success": written, "version": self.latest()}

    def _stored(self, rows: DataFrame) -> dict:
        """The files of a commit, which no manifest names yet."""
        ident = uuid.uuid4().hex
        self._dealt(rows).write.partitionBy("bucket").parquet(f"{self.path}/data/commit={ident}")
        if self.index:
            stored = self.spark.read.parquet(f"{self.path}/data/commit={ident}").filter("not deleted")
            postings.write(stored, f"{self.path}/postings/commit={ident}", f"{self.path}/lexicon/commit={ident}")
        return {"id": ident, "rows": -1, "index": self.index, "buckets": self.buckets}

    def delete(self, uris: DataFrame) -> None:
        self.write(uris.select("URI", *[F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields[1:]]).withColumn("deleted", F.lit(True)))

    def compact(self) -> bool:
        """One commit with the live rows of all, as a new version, with postings if the store keeps them; commits that came meanwhile stay after it. False if others have folded these."""
        commits = self._commits(self.latest())
        if not commits:
            return False
        live = self._live(commits, self._parts(commits)).select(*DOCUMENT.names, "deleted").withColumn("bucket", self.bucket())
        folded = self._stored(live)
        for _ in range(100):
            now = self.latest()
            after = self._commits(now)
            if [c["id"] for c in after[: len(commits)]] != [c["id"] for c in commits]:
                return False
            if self._publish(now + 1, [folded, *after[len(commits) :]]):
                return True
        return False


def last_of_each(rows: DataFrame, key: str = "URI", order: str | None = None) -> DataFrame:
    """One row of each URI, the one with the greatest order, or else the last in input order."""
    numbered = rows.withColumn("__at", F.monotonically_increasing_id())
    last = Window.partitionBy(key).orderBy(*([F.desc_nulls_last(order)] if order else []), F.desc("__at"))
    return numbered.withColumn("__nth", F.row_number().over(last)).filter("__nth = 1").drop("__at", "__nth")


def categories(rows: DataFrame, options: Options) -> DataFrame:
    """The columns that ``read.documents.categories`` asks for, content by default; the others are null, and are not read."""
    wanted = [c.lower() for c in options.listed("read.documents.categories")] or ["content"]
    kept = set(METADATA) if "metadata" in wanted else {m for m in METADATA if m.lower() in wanted}
    if "content" in wanted:
        kept |= {"content", "format"}
    return rows.select("URI", *[F.col(f.name) if f.name in kept else F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields[1:]])


def with_secondary(seed: DataFrame, documents: DataFrame, expand) -> DataFrame:
    """The seed documents and those that ``expand`` (a function from a (URI) table to another) names for them, each once more than it was there."""
    more = expand(seed.select("URI"))
    return seed.unionByName(documents.join(more.select("URI").distinct(), "URI", "left_semi"))


def sharing_key(documents: DataFrame, key) -> callable:
    """An expansion to all other documents with the same key as a seed document."""

    def expand(uris: DataFrame) -> DataFrame:
        keyed = documents.select("URI", key.alias("__key"))
        keys = keyed.join(uris, "URI", "left_semi").select("__key").distinct()
        return keyed.join(keys, "__key", "left_semi").join(uris, "URI", "left_anti").select("URI")

    return expand
