"""The fixed row shapes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

DOCUMENT = StructType(
    [
        StructField("URI", StringType()),
        StructField("content", BinaryType()),
        StructField("format", StringType()),
        StructField("collections", ArrayType(StringType())),
        StructField("permissions", MapType(StringType(), ArrayType(StringType()))),
        StructField("quality", IntegerType()),
        StructField("properties", StringType()),
        StructField("metadataValues", MapType(StringType(), StringType())),
    ]
)
TRIPLE = StructType([StructField(n, StringType()) for n in ("subject", "predicate", "object", "datatype", "lang", "graph")])
FILE = StructType([StructField("path", StringType()), StructField("modificationTime", TimestampType()), StructField("length", LongType()), StructField("content", BinaryType())])
CHUNK = StructType([StructField("text", StringType()), StructField("embedding", ArrayType(FloatType())), StructField("classification", BinaryType()), StructField("modelName", StringType()), StructField("metadata", StringType())])
METADATA = ("collections", "permissions", "quality", "properties", "metadataValues")


def kind_of(schema: StructType) -> str:
    """How rows of a schema are written: as files, documents, triples, or each row as a document of its own."""
    names = [f.name for f in schema]
    if names == FILE.names:
        return "file"
    if names[: len(DOCUMENT)] == DOCUMENT.names:
        return "document"
    if names == TRIPLE.names and all(isinstance(f.dataType, StringType) for f in schema):
        return "triple"
    return "row"
