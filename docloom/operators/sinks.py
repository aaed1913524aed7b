"""File sinks: documents as files, gzip files, zips and archives; triples as RDF files; rows to custom code."""

from __future__ import annotations

import gzip
import json
import logging
import os
import re
import uuid
import xml.dom.minidom
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metadata, uris
from ..functions.pointers import pretty_json
from ..options import OptionError, Options
from ..schemas import DOCUMENT, METADATA
from ..shared import bounded
from ..sources.rdf import BLANK, serialized
from . import triples

log = logging.getLogger(__name__)
#: Entries of one zip from which a warning is logged.
WARN_ENTRIES = 500_000
#: Bytes and entries after which a partition goes on in another zip, as one file is one task's work when it is read.
ZIP_BYTES, ZIP_ENTRIES = 32 << 20, 65_535
#: Triples that an RDF file is written by at a time, and bytes (unpacked) after which a partition goes on in another file, unless the file has blank nodes, which are known inside it alone.
RDF_BLOCK, RDF_BYTES = 5000, 16 << 20
#: Rows that become Python objects at a time.
PY_ROWS = 256


def pretty(content: bytes, name: str) -> bytes:
    """JSON and XML with indents; anything else, or what can't be read, as it is."""
    kind = name.rpartition(".")[2].lower()
    try:
        if kind == "json":
            return pretty_json(content.decode()).encode()
        if kind == "xml":
            text = xml.dom.minidom.parseString(content).documentElement.toprettyxml(indent="  ")
            return "\n".join(line for line in text.splitlines() if line.strip()).encode()
    except Exception:  # noqa: BLE001  what isn't well-formed is written as it is
        log.debug("not pretty-printed: %s", name)
    return content


def _job() -> str:
    """What names the files of one write: the time it began and a random part, both settled on the driver."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%SZ}-{uuid.uuid4().hex[:8]}"


class _Folder:
    """Writes under a folder that each executor can reach by a path (a shared or local file system)."""

    def __init__(self, path: str):
        if re.match(r"^(?!file:)[a-z][a-z0-9+.-]*://", path):
            raise OptionError(f"file sinks write to mounted folders, not to {path}")
        self.path = re.sub(r"^file:(//)?", "", path)

    def put(self, name: str, content: bytes) -> None:
        """A file that appears whole: written beside its place, then renamed, so a task that runs again replaces it."""
        with self.opened(name) as f:
            f.write(content)

    @contextmanager
    def opened(self, name: str):
        """A file to write to piece by piece, which takes its place when it is closed and is dropped if the work fails."""
        with self.together() as begin:
            yield begin(name)

    @contextmanager
    def together(self):
        """A function that begins a file, which ends the one before. All take their places when the work is done, and all are dropped if it fails."""
        made: list[tuple[str, str]] = []
        now = None

        def begin(name: str):
            nonlocal now
            if now:
                now.close()
            target = os.path.normpath(os.path.join(self.path, name.lstrip("/")))
            if not target.startswith(os.path.normpath(self.path) + os.sep):
                raise OptionError(f"{name} leaves the folder that is written to")
            os.makedirs(os.path.dirname(target), exist_ok=True)
            made.append((f"{target}.{uuid.uuid4().hex}.part", target))
            now = open(made[-1][0], "wb")
            return now

        try:
            yield begin
            if now:
                now.close()
            for draft, target in made:
                os.replace(draft, target)
        finally:
            if now:
                now.close()
            for draft, _ in made:
                if os.path.exists(draft):
                    os.remove(draft)


def _numbered(job: str, number: int, end: str) -> str:
    """The name of a partition's first file, or of a further one."""
    from pyspark import TaskContext

    return f"{job}-{TaskContext.get().partitionId()}{f'.{number}' if number else ''}{end}"


def _by_partition(rows: DataFrame, work: Callable[[Iterator[dict]], tuple[int, int]]) -> tuple[int, int]:
    """Sums of the two numbers that ``work`` gives for the rows of each partition; rows come in Arrow batches, as dicts."""
    bounded(rows.sparkSession)

    def run(batches):
        import pyarrow as pa

        def each():
            for batch in (b.slice(at, PY_ROWS) for b in batches for at in range(0, len(b), PY_ROWS)):
                maps = [f.name for f in batch.schema if pa.types.is_map(f.type)]
                for r in batch.to_pylist():
                    yield r | {m: None if r[m] is None else dict(r[m]) for m in maps}

        good, bad = work(each())
        yield pa.RecordBatch.from_pydict({"good": [good], "bad": [bad]})

    done = rows.mapInArrow(run, "good long, bad long").agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    return done[0], done[1]


def write_files(docs: DataFrame, path: str, options: Options | dict | None = None) -> int:
    """Writes document rows: a file each at the path of its URI, gzip files, or zips, one a partition and more of a partition beyond ``ZIP_BYTES``. Returns the number of documents.

    In a zip a document's metadata entry comes before it if any metadata column is set; rows without content are metadata alone.
    """
    options = Options.of(options)
    squeezed = (options.text("write.files.compression") or "").lower()
    if squeezed not in ("", "gzip", "zip"):
        raise OptionError(f"Invalid value for write.files.compression: {squeezed}; it must be gzip or zip.")
    indent, encoding = options.flag("write.files.prettyPrint"), options.text("write.files.encoding")
    warn = options.number("write.files.zip.warnThreshold", WARN_ENTRIES, 1)
    folder = _Folder(path)
    rows = docs.select(*DOCUMENT.names, uris.to_path(F.col("URI")).alias("__path"), uris.metadata_entry(F.col("URI"), uris.format_of(F.col("URI"), F.col("format"))).alias("__entry"))

    def shown(r) -> bytes:
        content = bytes(r["content"] or b"")
        content = pretty(content, r["URI"]) if indent else content
        return content.decode().encode(encoding) if encoding else content

    job = _job()  # the same for a task that runs again, whose file then takes the place of the first

    def write(found: Iterator[dict]) -> tuple[int, int]:
        n = 0
        if squeezed != "zip":
            for r in found:
                if r["content"] is not None:
                    content = shown(r)
                    folder.put(r["__path"] + (".gz" if squeezed else ""), gzip.compress(content, mtime=0) if squeezed else content)
                    n += 1
            return n, 0
        with folder.together() as begin:
            number, z = 0, None
            try:
                for r in found:
                    if z is None or f.tell() >= ZIP_BYTES or len(z.filelist) + 2 > ZIP_ENTRIES:
                        if z:
                            z.close()
                        f, held = begin(_numbered(job, number, ".zip")), 0
                        z, number = zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED), number + 1
                    if any(r[m] is not None for m in METADATA):
                        z.writestr(r["__entry"], metadata.to_xml(r))
                    if r["content"] is not None:
                        z.writestr(r["URI"], shown(r))
                    n, held = n + 1, held + 1
                    if held == warn:
                        log.warning("a zip has %d entries or more; more partitions make smaller ones", held)
            finally:
                if z:
                    z.close()
        return n, 0

    return _by_partition(rows, write)[0]


def rdf_parts(content: bytes, syntax: str) -> tuple[bytes, bytes, bytes]:
    """(head, body, end) of a file; bodies follow each other between one head and one end. Only TriX has any but a body."""
    if syntax != "trix":
        return b"", content, b""
    head, end = re.search(rb"<TriX[^>]*>", content).end(), content.rindex(b"</TriX>")
    return content[:head], content[head:end], content[end:]


def write_rdf(rows: DataFrame, path: str, options: Options | dict | None = None) -> int:
    """Writes triples, one file a partition that has any, or more beyond ``RDF_BYTES``; ``write.files.rdf.format`` is ttl, nt, nq, trig or trix."""
    options = Options.of(options)
    syntax = (options.text("write.files.rdf.format") or "ttl").lower()
    graph = options.text("write.files.rdf.graph")
    if graph and syntax not in ("nq", "trig", "trix"):
        raise OptionError("A graph can only be given for nq, trig and trix.")
    squeezed = (options.text("write.files.compression") or "").lower()
    if squeezed not in ("", "gzip"):
        raise OptionError("RDF files can only be compressed by gzip.")
    serialized([], syntax)
    folder = _Folder(path)
    job = _job()

    def write(found: Iterator[dict]) -> tuple[int, int]:
        n = number = size = 0
        end, out = b"", None

        def ended() -> None:
            if out is not None:
                out.write(end)
                if squeezed:
                    out.close()

        with folder.together() as begin:
            while block := list(islice(found, RDF_BLOCK)):
                if out is None or size >= RDF_BYTES and not blank:
                    ended()
                    f = begin(_numbered(job, number, f".{syntax}" + (".gz" if squeezed else "")))
                    out, number, size, blank = gzip.GzipFile("", "wb", fileobj=f, mtime=0) if squeezed else f, number + 1, 0, False
                head, body, end = rdf_parts(serialized(block, syntax, graph), syntax)
                out.write(body if size else head + body)
                n, size, blank = n + len(block), size + len(body), blank or any(str(r[c]).startswith(BLANK) for r in block for c in ("subject", "object", "graph"))
            ended()
        return n, 0

    return _by_partition(rows, write)[0]


def ntriples(rows: DataFrame) -> DataFrame:
    """Triples as N-Triples or N-Quads lines, by column functions alone: for output that no Python should touch."""

    def quoted(c: str) -> F.Column:
        text = F.col(c)
        for raw, made in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            text = F.replace(text, F.lit(raw), F.lit(made))
        return F.concat(F.lit('"'), text, F.lit('"'))

    from ..sources.rdf import XSD_STRING

    def node(c: str) -> F.Column:
        return F.when(F.col(c).startswith(BLANK), F.concat(F.lit("_:"), F.substring(c, len(BLANK) + 1, 1 << 30))).otherwise(F.concat(F.lit("<"), F.col(c), F.lit(">")))

    obj = (
        F.when(F.col("lang").isNotNull(), F.concat(quoted("object"), F.lit("@"), F.col("lang")))
        .when(F.col("datatype") == XSD_STRING, quoted("object"))
        .when(F.col("datatype").isNotNull(), F.concat(quoted("object"), F.lit("^^<"), F.col("datatype"), F.lit(">")))
        .otherwise(node("object"))
    )
    return rows.select(F.concat_ws(" ", node("subject"), node("predicate"), obj, F.when(F.col("graph").isNotNull(), node("graph")), F.lit(".")).alias("value"))


# custom code

PROCESSORS: dict[str, Callable] = {}


def register_processor(name: str, function: Callable[[str, dict[str, str]], None]) -> None:
    """A function of a batch (URIs joined by a delimiter, or JSON) and variables, called for its effect."""
    PROCESSORS[name] = function


def process(df: DataFrame, options: Options | dict | None = None, function: Callable | None = None) -> dict[str, int]:
    """Calls custom code with batches of rows; a failed batch stops the write unless ``write.abortOnFailure`` is false.

    Rows of one URI column come as URIs joined by ``write.externalVariableDelimiter``; others as a JSON object, or an array in batches.
    """
    options = Options.of(options)
    run = function or PROCESSORS.get(options.text("write.invoke") or "")
    if run is None:
        raise OptionError("no processor is registered as " + str(options.text("write.invoke")))
    size = options.number("write.batchSize", 1, 1)
    name, delimiter = options.text("write.externalVariableName", "URI"), options.values.get("write.externalVariableDelimiter", ",")
    given, abort, as_uris = options.family("write.vars."), options.flag("write.abortOnFailure", True), df.columns == ["URI"]
    rows = df if as_uris else df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("URI"))

    def work(found: Iterator[dict]) -> tuple[int, int]:
        good = bad = 0
        batch: list[str] = []

        def flush():
            nonlocal good, bad
            value = delimiter.join(batch) if as_uris else batch[0] if size == 1 else json.dumps([json.loads(b) for b in batch])
            try:
                run(value, given | {name: value})
                good += len(batch)
            except Exception:
                if abort:
                    raise
                bad += len(batch)
            batch.clear()

        for r in found:
            batch.append(r["URI"])
            if len(batch) >= size:
                flush()
        if batch:
            flush()
        return good, bad

    good, bad = _by_partition(rows, work)
    return {"success": good, "failed": bad}


def register_graphs(rows: DataFrame, store, options: Options | dict | None = None) -> DataFrame:
    """Graphs that rows use and the store has no graph document for, written as such; writing them again changes nothing."""
    options = Options.of(options)
    known = store.read().filter(F.array_contains("collections", "graphs")).select(F.decode("content", "UTF-8").alias("graph"))
    new = triples.graphs(rows, options, known)
    docs = new.select(F.concat(F.lit("/graphs/"), F.sha2("graph", 256), F.lit(".txt")).alias("URI"), F.encode("graph", "UTF-8").alias("content"), F.lit("TEXT").alias("format"), F.array(F.lit("graphs")).alias("collections"))
    from .documents import blank, with_metadata

    store.write(with_metadata(blank(docs), options, {"collections"}))
    return new
