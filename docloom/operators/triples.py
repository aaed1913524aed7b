"""Triples of documents: reading them as rows, and grouping rows into documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..options import OptionError, Options
from ..sources.rdf import BLANK, DEFAULT_GRAPH, LANG_STRING, XSD_STRING

#: Triples of one document.
GROUP = 100
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))


def _escaped(text: Column) -> Column:
    for raw, made in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(made))
    return text


def _plain(text: Column) -> Column:
    for raw, made in reversed(_ESCAPES):
        text = F.replace(text, F.lit(made), F.lit(raw))
    return text


def _element() -> Column:
    """One triple as XML; a language beats a datatype."""
    lang = F.when(F.col("lang").isNotNull(), F.concat(F.lit(' xml:lang="'), _escaped(F.col("lang")), F.lit('"')))
    kind = F.when(F.col("datatype").isNotNull(), F.concat(F.lit(' datatype="'), _escaped(F.col("datatype")), F.lit('"')))
    return F.concat(
        F.lit("<triple><subject>"), _escaped(F.col("subject")), F.lit("</subject><predicate>"), _escaped(F.col("predicate")), F.lit("</predicate><object"),
        F.coalesce(lang, kind, F.lit("")), F.lit(">"), _escaped(F.col("object")), F.lit("</object></triple>"),
    )


def graph_of(options: Options) -> Column:
    """The graph of each row: overridden, its own, the given default, or the default graph."""
    options.exclusive("write.graph", "write.graphOverride")
    if over := options.text("write.graphOverride"):
        return F.lit(over)
    return F.coalesce("graph", F.lit(options.text("write.graph", DEFAULT_GRAPH)))


def documents(rows: DataFrame, options: Options | dict | None = None) -> DataFrame:
    """Document rows of at most ``GROUP`` triples of one graph each, in the graph's collection.

    A graph's triples are dealt to parts by hash and numbered there, so a graph with most of the rows is not one task's work.
    """
    options = Options.of(options)
    parts = options.number("write.triples.parts", 16, 1)
    placed = rows.withColumn("graph", graph_of(options)).withColumn("__part", F.pmod(F.xxhash64("subject", "predicate", "object", "datatype", "lang"), F.lit(parts)))
    order = Window.partitionBy("graph", "__part").orderBy("subject", "predicate", "object", "datatype", "lang")
    grouped = placed.withColumn("__nth", F.floor((F.row_number().over(order) - 1) / GROUP)).groupBy("graph", "__part", "__nth").agg(F.sort_array(F.collect_list(_element())).alias("t"))
    content = F.concat(F.lit('<triples xmlns="http://docloom.dev/triples">'), F.array_join("t", ""), F.lit("</triples>"))
    name = F.concat(F.lit("/triples/"), F.sha2(F.concat_ws("|", "graph", "__part", "__nth", content), 256), F.lit(".xml"))
    more = F.array(*[F.lit(c) for c in options.listed("write.collections")]).cast("array<string>")
    return grouped.select(
        name.alias("URI"), F.encode(content, "UTF-8").alias("content"), F.lit("XML").alias("format"), F.array_union(F.array("graph"), more).alias("collections"),
        F.lit(None).cast("map<string,array<string>>").alias("permissions"), F.lit(None).cast("int").alias("quality"), F.lit(None).cast("string").alias("properties"), F.lit(None).cast("map<string,string>").alias("metadataValues"),
    )


def graphs(rows: DataFrame, options: Options | dict | None = None, known: DataFrame | None = None) -> DataFrame:
    """The (graph) names that rows use and a table of known ones lacks."""
    found = rows.select(graph_of(Options.of(options)).alias("graph")).distinct()
    return found if known is None else found.join(known.select("graph"), "graph", "left_anti")


def rows(documents: DataFrame, options: Options | dict | None = None) -> DataFrame:
    """(subject, predicate, object, datatype, lang, graph) for each triple in the documents' content and each of a document's collections.

    ``read.triples.graphs`` keeps those graphs alone; a graph that is no absolute IRI gets ``read.triples.baseIri`` before it.
    """
    options = Options.of(options)
    text = F.decode("content", "UTF-8")
    pick = lambda name: F.regexp_extract(F.col("t"), rf"(?s)<(?:\w+:)?{name}(?:\s[^>]*)?>(.*?)</(?:\w+:)?{name}>", 1)
    attribute = lambda name: F.nullif(F.regexp_extract(F.col("t"), rf'<(?:\w+:)?object[^>]*?\s{name}="([^"]*)"', 1), F.lit(""))
    wanted = options.listed("read.triples.graphs")
    if wanted:
        documents = documents.filter(F.arrays_overlap("collections", F.array(*[F.lit(g) for g in wanted])))
    found = documents.select(F.explode(F.regexp_extract_all(text, F.lit(r"(?s)<(?:\w+:)?triple>.*?</(?:\w+:)?triple>"), F.lit(0))).alias("t"), "collections")
    found = found.select("t", F.explode_outer("collections").alias("graph"))
    if wanted:
        found = found.filter(F.col("graph").isin(*wanted))
    graph = F.col("graph")
    if base := options.text("read.triples.baseIri"):
        graph = F.when(absolute(graph), graph).otherwise(F.concat(F.lit(base), graph))
    lang = attribute("xml:lang")
    return found.select(
        _plain(pick("subject")).alias("subject"), _plain(pick("predicate")).alias("predicate"), _plain(pick("object")).alias("object"),
        F.when(lang.isNotNull(), F.lit(LANG_STRING)).otherwise(_plain(attribute("datatype"))).alias("datatype"), lang.alias("lang"), graph.alias("graph"),
    )


def absolute(iri: Column) -> Column:
    return iri.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:\S*$")


def of_columns(df: DataFrame, subject: Column, columns: dict[str, Column], graph: Column | None = None) -> DataFrame:
    """A triple for each named column of each row; numbers and text are literals."""
    types = dict(df.select(*[c.alias(n) for n, c in columns.items()]).dtypes)
    xsd = XSD_STRING.removesuffix("string")
    kind = {"int": "integer", "bigint": "integer", "double": "double", "float": "float", "date": "date", "boolean": "boolean"}
    each = [F.struct(F.lit(n).alias("predicate"), c.cast("string").alias("object"), F.lit(xsd + kind.get(types[n], "string")).alias("datatype")) for n, c in columns.items()]
    return df.select(subject.alias("subject"), F.explode(F.array(*each)).alias("t"), (graph if graph is not None else F.lit(None).cast("string")).alias("graph")).select(
        "subject", "t.predicate", "t.object", "t.datatype", F.lit(None).cast("string").alias("lang"), "graph"
    )


def terms(df: DataFrame) -> DataFrame:
    """Term rules over raw columns: value, is_literal, is_blank, datatype, lang."""
    blank = F.when(F.col("is_blank"), F.concat(F.lit(BLANK), F.col("value"))).otherwise(F.col("value"))
    kind = F.when(~F.col("is_literal"), F.lit(None)).when(F.col("lang").isNotNull(), F.lit(LANG_STRING)).otherwise(F.coalesce("datatype", F.lit(XSD_STRING)))
    return df.withColumn("object", blank).withColumn("datatype", kind)
