"""Custom-code scans: a registered function gives items, once, or once for each value of a partition function."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.enrich import loaded
from ..options import OptionError, Options

DEFAULT = StructType([StructField("URI", StringType())])
READERS: dict[str, Callable[..., Iterable]] = {}


def register_reader(name: str, function: Callable[..., Iterable]) -> None:
    """A function from variables (a dict; PARTITION among them where there are partitions) to items: strings, or JSON texts for a schema."""
    READERS[name] = function


def code(options: Options, prefix: str) -> Callable[..., Iterable] | None:
    """The function that ``<prefix>invoke`` names or ``<prefix>file`` holds (``path.py:function``)."""
    if name := options.text(f"{prefix}invoke"):
        if name in READERS:
            return READERS[name]
        return loaded(name)
    if path := options.text(f"{prefix}file"):
        return loaded(path)
    return None


def read(spark: SparkSession, options: Options | dict, schema: StructType | None = None) -> DataFrame:
    """Items of custom code as rows. Each partition value is a task of its own, also if there is only one."""
    options = Options.of(options)
    run = code(options, "read.")
    if run is None:
        raise OptionError("no reader is given")
    given = options.family("read.vars.")
    split = code(options, "read.partitions.")
    values = [str(v) for v in split(options.family("read.partitions.vars."))] if split else [None]
    tasks = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string").repartitionByRange(max(1, len(values)), "n")

    def items(frames):
        import pandas as pd

        for frame in frames:
            for value in frame["value"]:
                found = [x if isinstance(x, str) else json.dumps(x) for x in run(given | ({"PARTITION": value} if value is not None else {}))]
                for i in range(0, len(found), 10_000):
                    yield pd.DataFrame({"URI": found[i : i + 10_000]})

    rows = tasks.mapInPandas(items, "URI string")
    if schema is None or schema == DEFAULT:
        return rows
    return rows.select(F.from_json("URI", schema).alias("r")).select("r.*")
