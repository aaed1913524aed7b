"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local session uses a temp folder; a cluster must name one."""
    where = spark.conf.get("spark.checkpoint.dir", "")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.gettempdir()}/docloom-{os.getpid()}"
    return where.rstrip("/")


#: Rows and bytes of an Arrow batch, where the session has Spark's defaults: a worker holds a batch several times over, and a stage has a worker for each function and core.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": (str(64 << 20), str(4 << 20))}


def bounded(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of the size in ``BATCH`` unless it has a setting of its own."""
    for name, (default, least) in BATCH.items():
        if spark.conf.get(name, default).removesuffix("b") == default:
            spark.conf.set(name, least)
    return spark


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again, for plans that are used more than once and cost much, or call what must be called once. The files go with the application."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)
