"""Helpers that the training-data operators share: shared-folder tables, Arrow batches, word hashes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that one numpy step works on, which bounds a Python worker's memory.
SLICE_BYTES = 2 << 20


#: Rows of an Arrow batch, where the session has Spark's default: texts vary from a few bytes to many, and a batch is held on both sides.
BATCH_ROWS = 512


def bounded(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of at most ``BATCH_ROWS`` rows unless it has a setting of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, BATCH_ROWS)
    return spark


@contextmanager
def few_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most so many rows for what is run inside; then the session's setting as it was."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, ``spark.checkpoint.dir``. Where it is unset a local session uses its own temp folder; a cluster must name one."""
    where = spark.conf.get("spark.checkpoint.dir", "")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.gettempdir()}/docloom-{os.getpid()}"
    return where.rstrip("/")


#: A key with this many rows is hot: the one row it meets goes to every task. There are at most rows / HOT_ROWS of them.
HOT_ROWS = 1 << 16


def spread(rows: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with the one row of ``named`` for each key, whose column n is the number of rows: hot keys by broadcast, as no task should hold them."""
    hot = named.filter(F.col("n") >= HOT_ROWS)
    many = hot.count()
    if many == 0:
        return rows.join(named, key)
    size = many * 24
    if size > 64 << 20:
        return rows.join(named, key)  # as many hot keys fill all partitions evenly
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(named.filter(F.col("n") < HOT_ROWS), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def hot_keys(rows: DataFrame, keys: list[str], count: int, parts: int, *more: Column) -> DataFrame:
    """(keys, n, more) of each key with more than 1 / (4 ``parts``) of the ``count`` rows: at most 4 ``parts`` keys whatever the rows, so they may be broadcast. more: further aggregates.

    Rows are counted by 64 ``parts`` hashed cells first, then by key in the cells that have so many, which are at most 4 ``parts`` too, so few partial counts are shuffled.
    """
    least = count / (4 * parts)
    cell = F.pmod(F.xxhash64(*keys), F.lit(64 * parts))
    heavy = [r["cell"] for r in rows.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).filter(F.col("n") > least).collect()]
    return rows.filter(cell.isin(heavy)).groupBy(*keys).agg(F.count("*").alias("n"), *more).filter(F.col("n") > least)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors.

    The files go when the application ends.
    """
    return stored(df, name)[1]


def stored(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """(path, the table) of ``written``, for tables that ``gone`` deletes before the application ends."""
    spark = bounded(df.sparkSession)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path, spark.read.schema(df.schema).parquet(path)


def gone(spark: SparkSession, path: str) -> None:
    """Deletes the files of a stored table that no later plan reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def bucketed(df: DataFrame, name: str, buckets: int, *keys: str) -> tuple[str, DataFrame]:
    """(table name, ``df`` written in buckets of the keys to the shared folder): joins on the keys then leave it where it is. The caller drops the table; its files go with the application."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.format("parquet").option("path", path).bucketBy(buckets, *keys).saveAsTable(name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return name, spark.table(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def slices(texts: list[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` characters; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def spared() -> None:
    """Gives memory that a task no longer needs back to the system, as its Python worker lives on: what Arrow keeps, and what the C library does, where it can be asked."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def replaced(batch: pa.RecordBatch, columns: dict[str, pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of ``schema``'s columns, from ``columns`` or else from ``batch``."""
    names = batch.schema.names
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else batch.column(names.index(f.name)) for f in schema], schema=schema)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def extended(df: DataFrame, columns: str) -> StructType:
    """``df``'s schema with the given columns after it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(columns).fields])
