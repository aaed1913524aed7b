"""File scans: each kind of file becomes document rows or triples."""

from __future__ import annotations

import codecs
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..options import OptionError, Options
from ..schemas import DOCUMENT, TRIPLE
from ..shared import bounded
from . import rdf, readers

#: Rows of one Arrow batch that a reader hands on, and the bytes of content it holds at most before it does.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Spark's own file options, which are passed on.
PASSED = ("pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")
TYPES = ("rdf", "archive", "bulk_archive", "json_lines", "aggregate_xml")


#: Files that ``late`` opens by their names.
NAMED = 10_000


def listed(spark: SparkSession, paths: str | list[str], options: Options) -> DataFrame:
    """The files: path, modificationTime, length, content. Content is read only if a later step uses it."""
    reader = spark.read.format("binaryFile")
    for name in PASSED:
        if options.has(name):
            reader = reader.option(name, options.text(name))
    return reader.load(paths)


def kind(options: Options) -> str:
    found = (options.text("read.files.type") or "").lower()
    if options.has("read.aggregates.xml.element"):
        found = "aggregate_xml"
    if found and found not in TYPES:
        raise OptionError(f"Invalid value for read.files.type: {found}; it must be one of {', '.join(TYPES)}.")
    squeezed = (options.text("read.files.compression") or "").lower()
    if squeezed not in ("", "gzip", "zip"):
        raise OptionError(f"Invalid value for read.files.compression: {squeezed}; it must be gzip or zip.")
    return found or squeezed or "generic"


def row_reader(options: Options):
    """A function from (path, bytes) to rows, by the options."""
    what, squeezed = kind(options), (options.text("read.files.compression") or "").lower()
    encoding = options.text("read.files.encoding")
    if encoding:
        try:
            codecs.lookup(encoding)
        except LookupError:
            raise OptionError(f"Unsupported encoding value: {encoding}") from None
    tolerant = not options.flag("read.files.abortOnFailure", True)
    categories = tuple(c.lower() for c in options.listed("read.archives.categories"))
    xml = {
        "element": options.text("read.aggregates.xml.element"),
        "namespace": options.text("read.aggregates.xml.namespace"),
        "uri_element": options.text("read.aggregates.xml.uriElement"),
        "uri_namespace": options.text("read.aggregates.xml.uriNamespace"),
        "encoding": encoding,
        "tolerant": tolerant,
    }

    def run(path: str, content: bytes):
        if what == "generic":
            yield from readers.generic(path, content, encoding)
        elif what == "gzip":
            yield from readers.gzipped(path, content, encoding)
        elif what == "zip":
            yield from readers.zipped(path, content, encoding)
        elif what == "archive":
            yield from readers.archive(path, content, categories, encoding)
        elif what == "bulk_archive":
            yield from readers.bulk_archive(path, content, categories, encoding)
        elif what == "json_lines":
            yield from readers.json_lines(path, content, encoding)
        elif what == "aggregate_xml":
            if squeezed == "gzip":
                content = readers.gzip.decompress(content)
            yield from (readers.zipped_aggregate_xml if squeezed == "zip" else readers.aggregate_xml)(path, content, **xml)
        elif squeezed == "zip":
            for n, (name, data) in enumerate(readers.zip_entries(content)):
                yield from rdf.parse(name, data, rdf.scope_of(path, f"{n} {name}"))
        else:
            yield from rdf.parse(path, content, rdf.scope_of(path))

    return run, tolerant


def read(spark: SparkSession, paths: str | list[str], options: Options | dict | None = None) -> DataFrame:
    """Document rows, or triple rows for RDF. With ``streamFiles`` a row has its file's path alone; ``late`` reads its bytes where they are used.

    Whole files are the unit of work: a file is read by one task, and rows leave it in bounded batches.
    """
    options = Options.of(options)
    triples = kind(options) == "rdf"
    schema = TRIPLE if triples else DOCUMENT
    files = listed(spark, paths, options)
    parts = options.number("read.numPartitions", 0, 1)
    if options.flag("streamFiles") and not triples:
        rows = files.select("path").select(F.col("path").alias("URI"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields[1:]])
        return rows.repartition(parts) if parts else rows
    if kind(options) == "generic" and not options.has("read.files.encoding"):
        rows = files.select(F.col("path").alias("URI"), "content", *[F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields[2:]])
        return rows.repartition(parts) if parts else rows
    if kind(options) == "json_lines" and not options.has("read.files.encoding"):
        rows = json_lines(spark, paths, options)
        return rows.repartition(parts) if parts else rows
    if parts:
        files = files.repartition(parts)  # dealt in turn, so no partition is empty while another has two files more
    return expanded(files.select("path", "content"), options, schema)


def json_lines(spark: SparkSession, paths: str | list[str], options: Options) -> DataFrame:
    """A document for each line that isn't blank, as it stands, numbered from 1 in its file. A large file is read by many tasks.

    Lines are numbered inside each block that a task reads of a file; what the blocks before have is added, from a table with a row a block.
    """
    reader = spark.read.format("text")
    for name in PASSED:
        if options.has(name):
            reader = reader.option(name, options.text(name))
    lines = reader.load(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))

    def run(batches):
        seen: dict[tuple[str, int], int] = {}
        for batch in batches:
            out = []
            for key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                seen[key] = n = seen.get(key, 0) + 1
                out.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=["value", "path", "block", "nth"])

    numbered = lines.mapInArrow(run, "value string, path string, block long, nth long")
    blocks = lines.groupBy("path", "block").agg(F.count("*").alias("lines"))  # in the JVM; lines pass Python once
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = blocks.select("path", "block", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("shift"))
    found = numbered.filter(F.trim("value") != "").join(shift, ["path", "block"])
    uri = F.concat("path", F.lit("-"), (F.col("shift") + F.col("nth")).cast("string"), F.lit(".json"))
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields[3:]]
    return found.select(uri.alias("URI"), F.encode("value", "UTF-8").alias("content"), F.lit("JSON").alias("format"), *rest)


def expanded(files: DataFrame, options: Options, schema) -> DataFrame:
    run, tolerant = row_reader(options)
    bounded(files.sparkSession)
    arrow = to_arrow_schema(schema)

    def batches(found):
        rows, size = [], 0
        for batch in found:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                it = run(path, content.as_py() or b"")
                while True:
                    try:
                        r = next(it, None)
                    except Exception:
                        if not tolerant:
                            raise
                        r = None  # what is left of this file is passed over
                    if r is None:
                        break
                    r = {f.name: r.get(f.name) for f in schema}
                    if r.get("permissions") is not None:
                        r["permissions"] = list(r["permissions"].items())
                    if r.get("metadataValues") is not None:
                        r["metadataValues"] = list(r["metadataValues"].items())
                    rows.append(r)
                    size += len(r.get("content") or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return files.mapInArrow(batches, schema)


def late(rows: DataFrame, options: Options | dict | None = None) -> DataFrame:
    """The documents of rows that ``streamFiles`` left without content, read now: a zip's row becomes a row for each entry.

    Up to ``NAMED`` files are opened by their names and no other file is listed or opened. More are found by listing their folders, and then the files that aren't asked for are left unread where Spark
    can tell, else read in vain.
    """
    options = Options.of(options)
    spark = rows.sparkSession
    uris = rows.select(F.col("URI").alias("path")).distinct()
    some = [r["path"] for r in uris.filter("path IS NOT NULL").limit(NAMED + 1).toLocalIterator()]
    if not some:
        return spark.createDataFrame([], DOCUMENT)
    if len(some) <= NAMED:
        literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in some]  # a name is no pattern
        return expanded(listed(spark, literal, options).select("path", "content"), options, DOCUMENT)
    folder = F.regexp_replace("path", r"[^/]*$", "")
    folders = [r[0] for r in uris.select(folder.alias("f")).distinct().toLocalIterator()]  # one a folder, however many files it has
    files = listed(spark, folders, options).join(uris, "path", "left_semi")
    return expanded(files.select("path", "content"), options, DOCUMENT)
