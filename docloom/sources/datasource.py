"""The document store as a Spark format: ``spark.read.format("docloom").load(path)`` and ``df.write.format("docloom").save(path)``.

The format reads and writes what ``operators.store`` does, without a session in the tasks, so it takes paths that pyarrow can open: ``file:``, ``hdfs:``, ``s3:`` and mounted folders.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from ..schemas import DOCUMENT

#: Rows of an Arrow batch, and rows of a file's group.
BATCH_ROWS, GROUP_ROWS = 500, 5000
#: Documents are dealt by URI into so many folders unless the store has some already.
BUCKETS = 16
#: Columns whose values a filter may name.
PLAIN = ("URI", "format", "quality")

_ARROW = pa.schema(
    [
        ("URI", pa.string()), ("content", pa.binary()), ("format", pa.string()), ("collections", pa.list_(pa.string())), ("permissions", pa.map_(pa.string(), pa.list_(pa.string()))),
        ("quality", pa.int32()), ("properties", pa.string()), ("metadataValues", pa.map_(pa.string(), pa.string())),
    ]
)


def bucket_of(uri: str, buckets: int) -> int:
    """The folder of a URI: the hash that Spark's xxhash64 gives, as a signed number, modulo the folders."""
    h = xxhash.xxh64_intdigest(uri.encode(), 42)
    return (h - (1 << 64) if h >> 63 else h) % buckets


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), os.path.abspath(path))


def newest(fs: pafs.FileSystem, root: str) -> int:
    found = fs.get_file_info(pafs.FileSelector(f"{root}/manifests", allow_not_found=True))
    return max((int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[0] != "."), default=0)


def commits(fs: pafs.FileSystem, root: str, version: int) -> list[dict]:
    if not version:
        return []
    with fs.open_input_stream(f"{root}/manifests/{version:012d}.json") as f:
        return json.loads(f.read())["commits"]


def published(fs: pafs.FileSystem, root: str, version: int, entries: list[dict]) -> bool:
    """Puts a manifest in its place unless there is one: at once on a local file system, elsewhere as near to it as the file system gives."""
    target, draft = f"{root}/manifests/{version:012d}.json", f"{root}/manifests/.{uuid.uuid4().hex}"
    fs.create_dir(f"{root}/manifests")
    with fs.open_output_stream(draft) as f:
        f.write(json.dumps({"version": version, "commits": entries}).encode())
    try:
        if isinstance(fs, pafs.LocalFileSystem):
            os.link(draft, target)  # fails if the target is there
            return True
        if fs.get_file_info(target).type != pafs.FileType.NotFound:
            return False
        fs.move(draft, target)
        return True
    except FileExistsError:
        return False
    finally:
        if fs.get_file_info(draft).type != pafs.FileType.NotFound:
            fs.delete_file(draft)


@dataclass
class Files(InputPartition):
    """Files that one task reads: [(order of the commit, path)], newest commits first. settle: whether a URI may be in several of them."""

    files: list[tuple[int, str]]
    settle: bool


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.version = options["path"], int(options.get("version") or 0)
        self.wanted: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes filters on a document's own values: they choose folders and row groups, and are applied to what is read."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in PLAIN and isinstance(f, EqualTo | In | IsNotNull) or name == "URI" and isinstance(f, StringStartsWith):
                self.wanted.append(f)
            else:
                yield f

    def _uris(self) -> set[str] | None:
        """The URIs that the filters name, None for all."""
        out = None
        for f in self.wanted:
            if f.attribute == ("URI",) and isinstance(f, EqualTo | In):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                out = own if out is None else out & own
        return out

    def partitions(self) -> list[InputPartition]:
        """With one commit a file is a partition; with several, whose rows must be settled by URI, a folder is. Folders that no wanted URI falls into are passed over."""
        fs, root = opened(self.path)
        entries = commits(fs, root, self.version or newest(fs, root))
        uris = self._uris()
        folders: dict[str, list[tuple[int, str]]] = {}
        for order, entry in reversed(list(enumerate(entries))):
            for info in fs.get_file_info(pafs.FileSelector(f"{root}/data/commit={entry['id']}", recursive=True)):
                folder = next((p[len("bucket=") :] for p in info.path.split("/") if p.startswith("bucket=")), None)
                if info.is_file and info.base_name[0] not in "._" and folder is not None:
                    folders.setdefault(folder, []).append((order, info.path))
        if uris is not None:
            buckets = entries[-1].get("buckets") if entries else None
            if buckets and all(e.get("buckets") == buckets for e in entries):
                kept = {str(bucket_of(u, buckets)) for u in uris if u is not None}
                folders = {k: v for k, v in folders.items() if k in kept}
        if len(entries) == 1:
            return [Files([f], False) for files in folders.values() for f in files]
        return [Files(files, True) for files in folders.values()]

    def _condition(self):
        """The filters for pyarrow, which passes over row groups by their statistics."""
        out = None
        for f in self.wanted:
            field = pc.field(f.attribute[0])
            if isinstance(f, EqualTo):
                one = field == f.value
            elif isinstance(f, In):
                one = field.isin([v for v in f.value if v is not None])
            elif isinstance(f, IsNotNull):
                one = field.is_valid()
            else:
                one = pc.starts_with(field, f.value)
            out = one if out is None else out & one
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        fs, _ = opened(self.path)
        condition, named = self._condition(), self._uris()
        own = pc.field("URI").isin(sorted(u for u in named if u is not None)) if named is not None else None
        seen: set[str] = set()
        kind = pa.schema([*_ARROW, ("deleted", pa.bool_())])
        for order in sorted({o for o, _ in partition.files}, reverse=True):
            files = ds.dataset([p for o, p in partition.files if o == order], schema=kind, format="parquet", filesystem=fs)
            for batch in files.to_batches(filter=own if partition.settle else condition, batch_size=BATCH_ROWS):
                if partition.settle:
                    fresh = [u not in seen for u in batch.column("URI").to_pylist()]
                    batch = batch.filter(pa.array(fresh, pa.bool_()))
                batch = batch.filter(pc.invert(pc.fill_null(batch.column("deleted"), False)))
                if condition is not None and partition.settle and len(batch):  # other filters hold for the newest form of a document alone
                    batch = ds.dataset(pa.table(batch)).to_table(filter=condition).combine_chunks().to_batches()
                    batch = batch[0] if batch else None
                if batch is not None and len(batch):
                    content = pc.fill_null(batch.column("content"), b"")
                    yield pa.RecordBatch.from_arrays([content if f.name == "content" else batch.column(f.name).cast(f.type) for f in _ARROW], schema=_ARROW)
            if partition.settle and order != min(o for o, _ in partition.files):
                for batch in files.to_batches(columns=["URI"], filter=own):
                    seen.update(batch.column("URI").to_pylist())


@dataclass
class Written(WriterCommitMessage):
    rows: int
    files: list[str]


class Writer(DataSourceArrowWriter):
    """Tasks write into a folder of their own; the commit moves the files of the tasks that count to their place and publishes the version, an abort takes all away."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.ident = options["path"], overwrite, uuid.uuid4().hex
        self.buckets = int(options.get("buckets") or BUCKETS)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        fs, root = opened(self.path)
        context = TaskContext.get()
        base = f"{root}/staging/{self.ident}/{context.partitionId() if context else 0}-{uuid.uuid4().hex}"
        kind = pa.schema([*_ARROW, ("deleted", pa.bool_())])
        writers: dict[int, pq.ParquetWriter] = {}
        held: dict[int, list[pa.RecordBatch]] = {}
        rows, files = 0, []

        def flush(b: int) -> None:
            if b not in writers:
                fs.create_dir(f"{base}/bucket={b}")
                files.append(f"{base}/bucket={b}/part.parquet")
                writers[b] = pq.ParquetWriter(files[-1], kind, filesystem=fs, compression="zstd")
            writers[b].write_table(pa.Table.from_batches(held.pop(b), kind))

        for batch in iterator:
            names = batch.schema.names
            full = pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) if f.name in names else pa.nulls(len(batch), f.type) if f.name != "deleted" else pa.array([False] * len(batch)) for f in kind], schema=kind)
            own = pa.array([bucket_of(u, self.buckets) for u in full.column("URI").to_pylist()], pa.int32())
            for b in pc.unique(own).to_pylist():
                part = full.filter(pc.equal(own, b))
                held.setdefault(b, []).append(part)
                rows += len(part)
                if sum(map(len, held[b])) >= GROUP_ROWS:
                    flush(b)
        for b in list(held):
            flush(b)
        for w in writers.values():
            w.close()
        return Written(rows, files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        done = [m for m in messages if m is not None]
        for n, path in enumerate(p for m in done for p in m.files):
            folder = f"{root}/data/commit={self.ident}/{path.split('/')[-2]}"
            fs.create_dir(folder)
            fs.move(path, f"{folder}/part-{n:05d}-{uuid.uuid4().hex}.parquet")
        self._clear(fs, root)
        entry = {"id": self.ident, "rows": sum(m.rows for m in done), "index": False, "buckets": self.buckets}
        for _ in range(100):
            before = newest(fs, root)
            if not entry["rows"] and not self.overwrite:
                return
            if published(fs, root, before + 1, [*([] if self.overwrite else commits(fs, root, before)), *([entry] if entry["rows"] else [])]):
                return
        raise RuntimeError("other writers were faster a hundred times")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        self._clear(fs, root)

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/staging/{self.ident}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/staging/{self.ident}")


class DocumentFormat(DataSource):
    """Options: path; version, to read an earlier one; buckets, for a new store. Written rows need the column URI, and any of the document columns; of a URI there may be one row in a write,
    as after ``dropDuplicates``. A mode of overwrite makes a version that holds the new rows alone."""

    @classmethod
    def name(cls) -> str:
        return "docloom"

    def schema(self) -> StructType:
        return DOCUMENT

    def reader(self, schema: StructType) -> Reader:
        return Reader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        strange = sorted({f.name for f in schema} - {*DOCUMENT.names, "deleted"})
        if strange or "URI" not in [f.name for f in schema]:
            raise ValueError(f"rows of documents have a URI and the columns {DOCUMENT.names}, not {strange}")
        return Writer(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocumentFormat)
