"""Views: typed columns projected from documents or tables, registered under schema.view."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import Options
from . import names

#: The engine type of each template column type. Any other type is a string.
TYPE_OF: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "unsignedInt": T.IntegerType(),
    "positiveInteger": T.IntegerType(),
    "nonPositiveInteger": T.IntegerType(),
    "negativeInteger": T.IntegerType(),
    "nonNegativeInteger": T.IntegerType(),
    "short": T.ShortType(),
    "unsignedShort": T.ShortType(),
    "byte": T.ByteType(),
    "unsignedByte": T.ByteType(),
    "long": T.LongType(),
    "unsignedLong": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "decimal": T.DoubleType(),
    "dateTime": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "base64Binary": T.BinaryType(),
    "hexBinary": T.BinaryType(),
    "time": T.StringType(),
    "gYearMonth": T.StringType(),
    "gYear": T.StringType(),
    "gMonth": T.StringType(),
    "gDay": T.StringType(),
    "gMonthDay": T.StringType(),
    "duration": T.StringType(),
    "yearMonthDuration": T.StringType(),
    "dayTimeDuration": T.StringType(),
    "string": T.StringType(),
    "collatedString": T.StringType(),
    "anyUri": T.StringType(),
    "iri": T.StringType(),
    "point": T.StringType(),
    "longLatPoint": T.StringType(),
    "none": T.StringType(),
    "value": T.StringType(),
    "unknown": T.StringType(),
}


def data_type(name: str) -> T.DataType:
    return TYPE_OF.get(name, T.StringType())


@dataclass(frozen=True)
class ViewColumn:
    name: str
    type: str = "string"
    path: str | None = None  # JSON key below the context; the name if there is none
    nullable: bool = True
    hidden: bool = False


@dataclass(frozen=True)
class View:
    """schema.view over JSON documents: ``context`` is the key of an array of rows, or empty for the document itself."""

    schema: str
    name: str
    columns: tuple[ViewColumn, ...] = ()
    context: str = ""
    collections: tuple[str, ...] = ()
    params: dict[str, tuple[str, str | None]] = field(default_factory=dict)

    def struct(self, qualifier: str | None = None) -> T.StructType:
        schema, view = (self.schema, self.name) if qualifier is None else ("", qualifier)
        return T.StructType([T.StructField(names.qualified(schema, view, c.name), data_type(c.type), c.nullable) for c in self.columns if not c.hidden])

    def rows(self, documents: DataFrame, qualifier: str | None = None) -> DataFrame:
        """The view's rows; a value that is not of its column's type is null and its row stays. Columns of the row's own document: URI as __uri."""
        if self.collections:
            documents = documents.filter(F.arrays_overlap("collections", F.array(*[F.lit(c) for c in self.collections])))
        inner = T.StructType([T.StructField(c.path or c.name, T.StringType() if isinstance(data_type(c.type), T.BinaryType) else data_type(c.type)) for c in self.columns])
        text = F.decode("content", "UTF-8")
        if self.context:
            parsed = documents.select(F.col("URI").alias("__uri"), F.explode(F.from_json(F.get_json_object(text, f"$.{self.context}"), T.ArrayType(inner))).alias("r"))
        else:
            parsed = documents.select(F.col("URI").alias("__uri"), F.from_json(text, inner).alias("r"))
        shown = [c for c in self.columns if not c.hidden]
        cols = []
        for c, f in zip(shown, self.struct(qualifier), strict=True):
            value = F.col("r").getField(c.path or c.name)
            if c.type == "base64Binary":
                value = F.unbase64(value)
            elif c.type == "hexBinary":
                value = F.unhex(value)
            cols.append(value.alias(f.name))
        return parsed.select("__uri", *cols)


class Views:
    """Registered views; each is a function from a session to a DataFrame with bare column names."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._views: dict[tuple[str, str], DataFrame] = {}

    def register(self, schema: str, view: str, df: DataFrame) -> None:
        self._views[schema, view] = df

    def open(self, schema: str, view: str, qualifier: str | None = None) -> DataFrame:
        """Columns named schema.view.column, qualifier.column, or bare for an empty qualifier."""
        if (schema, view) not in self._views:
            raise ValueError(f"no view {schema}.{view}")
        df = self._views[schema, view]
        prefix = (schema, view) if qualifier is None else ("", qualifier)
        return df.select(*[F.col(names.quoted(c)).alias(names.qualified(*prefix, c)) for c in df.columns if not c.startswith("__")])


def bound(df: DataFrame, params: dict[str, tuple[object, str]]) -> DataFrame:
    """Adds each parameter as a constant column of its type."""
    return df.withColumns({name: F.lit(value).cast(data_type(kind)) for name, (value, kind) in params.items()})


def params_of(options: Options) -> dict[str, tuple[object, str]]:
    kinds = options.family("read.param.type.")
    values = {k: v for k, v in options.family("read.param.").items() if not k.startswith("type.")}
    return {k: (v, kinds.get(k, "string")) for k, v in values.items()}
