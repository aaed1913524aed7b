"""The front door: what options ask for, in the order paths, documents, triples, row query, custom code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .operators import documents, sinks, store, triples
from .options import OptionError, Options
from .plans import dsl, filters, views
from .schemas import kind_of
from .sources import custom, files


class Engine:
    def __init__(self, spark: SparkSession, store_path: str | None = None, index: bool = False):
        """``index``: whether the store keeps postings of the documents' words for searches."""
        self.spark = spark
        self.views = views.Views(spark)
        self.store = store.Store(spark, store_path, index=index) if store_path else None

    def read(self, options: Options | dict | None = None, paths: str | list[str] | None = None, schema: StructType | None = None, where: list | None = None, **params) -> DataFrame:
        """The rows that the options ask for. ``params`` rebinds parameters of a row query, as does an equality on a parameter's column in ``where``, a list of
        filters as in ``plans.filters``; its other filters select rows."""
        options = Options.of(options)
        if paths:
            return files.read(self.spark, paths, options)
        if options.family("read.documents."):
            return self._documents().search(options)
        if options.family("read.triples."):
            return triples.rows(self._documents().search(self._as_documents(options)), options)
        if query := options.text("read.query"):
            given = views.params_of(options)
            wanted = {f[1]: f[2] for f in where or () if f[0] == "eq" and f[1] in given}
            given = {k: (params.get(k, wanted.get(k, v)), t) for k, (v, t) in given.items()}
            df = dsl.Builder(self.views, self.store, {k: v for k, (v, _) in given.items()}).frame(query)
            df = views.bound(df, given)
            for f in where or ():
                if f[0] != "eq" or f[1] not in given:
                    df = df.filter(filters.column(f))
            return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema]) if schema else df
        if options.has("read.invoke", "read.file"):
            return custom.read(self.spark, options, schema)
        raise OptionError("no path, document query, triples query, row query or custom code is given")

    def _documents(self) -> store.Store:
        if self.store is None:
            raise OptionError("documents and triples need a store path")
        return self.store

    def _as_documents(self, options: Options) -> Options:
        names = {"collections": "collections", "query": "query", "stringQuery": "stringQuery", "uris": "uris", "directory": "directory", "filtered": "filtered"}
        found = {f"read.documents.{new}": options.text(f"read.triples.{old}") for old, new in names.items() if options.has(f"read.triples.{old}")}
        return Options.of(found | {"read.documents.categories": "content,collections"})

    def write(self, df: DataFrame, options: Options | dict | None = None, path: str | None = None) -> dict[str, int]:
        """Writes rows to files, to custom code, or as documents to the store."""
        options = Options.of(options)
        if path:
            if kind_of(df.schema) == "triple":
                return {"success": sinks.write_rdf(df, path, options)}
            return {"success": sinks.write_files(documents.of_rows(df, options), path, options)}
        if options.has("write.invoke"):
            return sinks.process(df, options)
        done = documents.write(df, self._documents(), options)
        if kind_of(df.schema) == "triple":
            sinks.register_graphs(df, self._documents(), options)
        return done
