"""Streams: bounded lists replayed as micro-batches with offsets that a checkpoint keeps, and sinks that run once a batch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import documents, sinks
from ..options import Options
from ..plans import buckets
from ..shared import shared_dir
from ..sources import custom


class _Slice(InputPartition):
    def __init__(self, index: int):
        self.index = index


class ListReader(DataSourceStreamReader):
    """One element of a list a batch; the offset is how many elements have been read."""

    def __init__(self, size: int, rows: Callable[[int], Iterable[tuple]]):
        self.size, self.rows, self.offered = size, rows, None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"offset": 0}

    def latestOffset(self, start: dict | None = None, limit=None) -> dict:  # noqa: N802
        at = (start or {}).get("offset", self.offered if self.offered is not None else 0)
        self.offered = min(self.size, at + 1)
        return {"offset": self.offered}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.offered = end["offset"]
        return [_Slice(i) for i in range(start["offset"], end["offset"])]

    def read(self, partition: _Slice):
        yield from self.rows(partition.index)

    def commit(self, end: dict) -> None:
        pass


class PartitionSource(DataSource):
    """``docloom_custom``: the values of a partition function, one a micro-batch."""

    @classmethod
    def name(cls) -> str:
        return "docloom_custom"

    def schema(self) -> str:
        return "URI string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        options = Options.of(dict(self.options))
        run, split = custom.code(options, "read."), custom.code(options, "read.partitions.")
        values = [str(v) for v in split(options.family("read.partitions.vars."))]
        given = options.family("read.vars.")

        def rows(i: int):
            for x in run(given | {"PARTITION": values[i]}):
                yield (x if isinstance(x, str) else json.dumps(x),)

        return ListReader(len(values), rows)


def row_id(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` and __row_id, an unsigned 64-bit hash of the keys as a decimal."""
    h = F.xxhash64(*keys).cast("decimal(20,0)")
    return df.withColumn("__row_id", F.when(h < 0, h + F.lit(Decimal(1 << 64)).cast("decimal(20,0)")).otherwise(h))


def stream_view(spark: SparkSession, view: DataFrame, keys: list[str], partitions: int = 4, batch_size: int = 0) -> DataFrame:
    """A stream of a view's rows, a bucket of row ids a micro-batch.

    The view is read once: its rows are written in a file a bucket to the shared folder, and a micro-batch reads the next file alone.
    """
    total = sum(len(p.buckets) for p in buckets.plan(partitions, batch_size, view.count())) or 1
    # a bucket's number follows from a row's id
    number = F.floor(F.col("__row_id").cast("decimal(38,0)") * total / F.lit(Decimal(1 << 64)).cast("decimal(38,0)")).cast("int")
    rows = row_id(view, *keys).withColumn("__bucket", F.least(number, F.lit(total - 1))).drop("__row_id")
    path = f"{shared_dir(spark)}/view-{uuid.uuid4().hex}"
    rows.repartition(total, "__bucket").write.partitionBy("__bucket").parquet(path)
    schema = StructType([*view.schema.fields, StructField("__bucket", IntegerType())])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).select(*view.columns)


def stream_custom(spark: SparkSession, options: dict) -> DataFrame:
    """A stream of custom code's items, a partition value a micro-batch."""
    spark.dataSource.register(PartitionSource)
    reader = spark.readStream.format("docloom_custom")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def to_store(stream: DataFrame, store, checkpoint: str, options: Options | dict | None = None, **trigger):
    """Writes a stream's rows as documents. A batch that runs again after a failure gives the same last version of each URI."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        documents.write(rows, store, options)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def to_code(stream: DataFrame, function: Callable, checkpoint: str, options: Options | dict | None = None, **trigger):
    """Calls custom code with a stream's rows."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        sinks.process(rows, options, function)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

