"""Queries through files, the document store, custom code and streams: what is written is read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .api import Engine
from .operators import documents, enrich, sinks, triples
from .queries import _WORDS, XSD, document_rows, query, table
from .shared import shared_dir
from .sources import custom, datasource, files
from .streaming import streams

_TEXT = "UTF-8"


def folder(spark) -> str:
    """A new folder that the driver and all executors see."""
    return f"{shared_dir(spark)}/docloom-{uuid.uuid4().hex}"


@query("SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\", CAST(length(text) AS BIGINT) AS chars, md5(text) AS digest, lang, CAST(n_chars AS INTEGER) AS quality, 'TEXT' AS format FROM documents")
def files_archive_round_trip(spark, sf_dir):
    """Documents with metadata into archives, one a partition, and back."""
    path = folder(spark)
    sinks.write_files(document_rows(spark, sf_dir).repartition(4), path, {"write.files.compression": "zip"})
    back = files.read(spark, path, {"read.files.type": "archive"})
    return back.select("URI", F.length(F.decode("content", _TEXT)).cast("long").alias("chars"), F.md5("content").alias("digest"), F.col("collections")[0].alias("lang"), "quality", "format")


@query("SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\", md5(text) AS digest FROM documents")
def files_zip_round_trip(spark, sf_dir):
    path = folder(spark)
    bare = document_rows(spark, sf_dir).select("URI", "content", *[F.lit(None).cast(t).alias(c) for c, t in document_rows(spark, sf_dir).dtypes[2:]])
    sinks.write_files(bare.repartition(3), path, {"write.files.compression": "zip"})
    back = files.read(spark, path, {"read.files.compression": "zip"})
    return back.select(F.regexp_extract("URI", r"\.zip/(.*)$", 1).alias("URI"), F.md5("content").alias("digest"))


@query("SELECT '/n/' || n_nationkey || '.json' AS \"URI\", CAST(to_json({'n_nationkey': n_nationkey, 'n_name': n_name}) AS VARCHAR) AS doc FROM nation")
def files_gzip_round_trip(spark, sf_dir):
    path = folder(spark)
    docs = documents.of_rows(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), {"write.uriTemplate": "/n/{n_nationkey}.json"})
    sinks.write_files(docs, path, {"write.files.compression": "gzip"})
    back = files.read(spark, path, {"read.files.compression": "gzip", "recursiveFileLookup": "true"})
    return back.select(F.regexp_extract("URI", r"(/n/\d+\.json)$", 1).alias("URI"), F.decode("content", _TEXT).alias("doc"))


@query("SELECT r_regionkey AS k, r_name AS name FROM region")
def files_generic_pretty(spark, sf_dir):
    path = folder(spark)
    docs = documents.of_rows(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), {"write.uriTemplate": "/r/{r_regionkey}.json"})
    sinks.write_files(docs, path, {"write.files.prettyPrint": "true", "write.files.encoding": "UTF-16"})
    back = files.read(spark, path, {"recursiveFileLookup": "true", "read.files.encoding": "UTF-16"})
    found = F.from_json(F.decode("content", _TEXT), "r_regionkey int, r_name string")
    return back.select(found.alias("r")).select(F.col("r.r_regionkey").alias("k"), F.col("r.r_name").alias("name"))


@query("SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS line, o_orderkey FROM orders")
def files_json_lines(spark, sf_dir):
    path = folder(spark)
    o = table(spark, sf_dir, "orders").orderBy("o_orderkey").select(F.to_json(F.struct("o_orderkey", "o_orderstatus")).alias("value"))
    o.coalesce(1).write.text(path)
    back = files.read(spark, path, {"read.files.type": "json_lines"})
    line = F.regexp_extract("URI", r"-(\d+)\.json$", 1).cast("int")
    return back.select(line.alias("line"), F.get_json_object(F.decode("content", _TEXT), "$.o_orderkey").cast("long").alias("o_orderkey"))


@query("SELECT n_name AS \"URI\", CAST(n_nationkey AS INTEGER) AS k FROM nation")
def files_aggregate_xml(spark, sf_dir):
    path = folder(spark)
    n = table(spark, sf_dir, "nation").orderBy("n_nationkey")
    items = F.concat(F.lit("<n:nation><id>"), F.col("n_nationkey").cast("string"), F.lit("</id><name>"), F.col("n_name"), F.lit("</name></n:nation>"))
    whole = n.select(items.alias("x")).agg(F.concat(F.lit('<all xmlns:n="urn:n"><deep>'), F.array_join(F.collect_list("x"), ""), F.lit("</deep></all>")).alias("value"))
    whole.coalesce(1).write.text(path)
    back = files.read(spark, path, {"read.aggregates.xml.element": "nation", "read.aggregates.xml.namespace": "urn:n", "read.aggregates.xml.uriElement": "name"})
    return back.select("URI", F.regexp_extract(F.decode("content", _TEXT), r"<id>(\d+)</id>", 1).cast("int").alias("k"))


def _triples(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    columns = {"http://p/name": F.col("c_name"), "http://p/nation": F.col("c_nationkey")}
    return triples.of_columns(c, F.concat(F.lit("http://c/"), F.col("c_custkey").cast("string")), columns, F.concat(F.lit("http://g/"), "c_mktsegment"))


_TRIPLES = f"""SELECT 'http://c/' || c_custkey AS subject, 'http://p/name' AS predicate, c_name AS object, '{XSD}string' AS datatype, 'http://g/' || c_mktsegment AS graph FROM customer
UNION ALL SELECT 'http://c/' || c_custkey, 'http://p/nation', CAST(c_nationkey AS VARCHAR), '{XSD}integer', 'http://g/' || c_mktsegment FROM customer"""
_RDF = {"nq": _TRIPLES, "trig": _TRIPLES, "trix": _TRIPLES, "ttl": f"SELECT subject, predicate, object, datatype, CAST(NULL AS VARCHAR) AS graph FROM ({_TRIPLES})", "nt": f"SELECT subject, predicate, object, datatype, CAST(NULL AS VARCHAR) AS graph FROM ({_TRIPLES})"}
for _syntax, _sql in _RDF.items():

    def _rdf(spark, sf_dir, syntax=_syntax):
        path = folder(spark)
        sinks.write_rdf(_triples(spark, sf_dir).repartition(3), path, {"write.files.rdf.format": syntax, "write.files.compression": "gzip" if syntax == "nq" else ""})
        return files.read(spark, path, {"read.files.type": "rdf"}).select("subject", "predicate", "object", "datatype", "graph")

    query(_sql, f"rdf_{_syntax}_round_trip")(_rdf)


@query("SELECT n_regionkey AS region, n_name AS name FROM nation")
def custom_code_partitions(spark, sf_dir):
    """Custom code, once for each region; here it is given its rows as variables."""
    import json

    rows = table(spark, sf_dir, "nation").select("n_regionkey", "n_name").collect()  # 25 rows by the table's definition
    given: dict[str, list[str]] = {}
    for r in rows:
        given.setdefault(str(r["n_regionkey"]), []).append(r["n_name"])
    custom.register_reader("docloom.regions", lambda v: sorted(json.loads(v["names"])))
    custom.register_reader("docloom.names", lambda v: [{"region": int(v["PARTITION"]), "name": n} for n in json.loads(v["names"])[v["PARTITION"]]])
    schema = "region int, name string"
    from pyspark.sql.types import StructType

    return custom.read(spark, {"read.invoke": "docloom.names", "read.partitions.invoke": "docloom.regions", "read.vars.names": json.dumps(given), "read.partitions.vars.names": json.dumps(given)}, StructType.fromDDL(schema))


@query("SELECT n_nationkey, n_name FROM nation")
def stream_of_view(spark, sf_dir):
    """A view's rows through a stream, a bucket a micro-batch, into files."""
    out, check = folder(spark), folder(spark)
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    q = streams.stream_view(spark, n, ["n_nationkey"], partitions=3).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(n.schema).parquet(out)


@query("SELECT '/o/' || o_orderkey || '.json' AS \"URI\", CAST(o_custkey AS BIGINT) AS custkey FROM orders")
def stream_into_store(spark, sf_dir):
    """A file stream of all orders into a document store."""
    stored = orders_streamed(spark, sf_dir).read().select("URI", F.decode("content", _TEXT).alias("text"))
    field = lambda name: F.get_json_object("text", f"$.{name}").cast("long")
    return stored.select("URI", field("o_custkey").alias("custkey"))


def orders_streamed(spark, sf_dir):
    """The store that a file stream of all orders was written to."""
    src, base, check = folder(spark), folder(spark), folder(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    o.repartition(2).write.parquet(src)
    engine = Engine(spark, base)
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = streams.to_store(stream, engine.store, check, {"write.uriTemplate": "/o/{o_orderkey}.json"})
    if not q.awaitTermination(600):
        q.stop()
        raise TimeoutError("the stream of orders did not end")
    return engine.store


@query("SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\", CAST(CASE WHEN lang = 'fr' THEN 2 ELSE 1 END AS INTEGER) AS version, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE lang <> 'es'")
def store_upsert_and_delete(spark, sf_dir):
    """All documents, then new metadata for some of them alone, then others deleted: the newest of each is read, with its content."""
    engine = Engine(spark, folder(spark))
    docs = document_rows(spark, sf_dir)
    engine.store.write(docs.withColumn("quality", F.lit(1)))
    french = docs.filter("collections[0] = 'fr'").withColumn("quality", F.lit(2)).withColumn("content", F.lit(None).cast("binary"))
    engine.store.write(french, merge_metadata=True)
    engine.store.delete(docs.filter("collections[0] = 'es'").select("URI"))
    return engine.store.read().select("URI", F.col("quality").alias("version"), F.length(F.decode("content", _TEXT)).cast("long").alias("chars"))


@query(f"SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\" FROM documents WHERE lang = 'de' AND contains(' ' || array_to_string({_WORDS}, ' ') || ' ', ' licensed under ')")
def store_search(spark, sf_dir):
    engine = Engine(spark, folder(spark))
    engine.store.write(document_rows(spark, sf_dir))
    return engine.read({"read.documents.collections": "de", "read.documents.stringQuery": '"licensed under"'}).select("URI")


def indexed(spark, sf_dir):
    """An engine whose store keeps postings, with all documents."""
    engine = Engine(spark, folder(spark), index=True)
    engine.store.write(document_rows(spark, sf_dir))
    return engine


@query(f"SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\", CAST(length(text) AS BIGINT) AS chars FROM documents WHERE contains(' ' || array_to_string({_WORDS}, ' ') || ' ', ' apache license ') AND NOT list_contains({_WORDS}, 'trash')")
def index_phrase(spark, sf_dir):
    """A phrase and an excluded word, found by positions in the index; only what it finds is read."""
    found = indexed(spark, sf_dir).read({"read.documents.stringQuery": '"apache license" -trash'})
    return found.select("URI", F.length(F.decode("content", _TEXT)).cast("long").alias("chars"))


@query(f"SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\" FROM documents WHERE lang <> 'de' AND (len(list_filter({_WORDS}, lambda t: starts_with(t, 'licen'))) > 0 OR contains(' ' || array_to_string({_WORDS}, ' ') || ' ', ' all rights '))")
def index_wildcard_unfiltered(spark, sf_dir):
    """The index alone says which documents have a word with that start or the phrase."""
    query = '{"search":{"qtext":"licen* OR \\"all rights\\"","query":{"queries":[{"not-query":{"collection-query":{"uri":["de"]}}}]}}}'
    return indexed(spark, sf_dir).read({"read.documents.query": query, "read.documents.filtered": "false"}).select("URI")


@query(f"SELECT term, count(DISTINCT doc_id) AS documents, count(*) AS occurrences FROM (SELECT doc_id, unnest({_WORDS}) AS term FROM documents) GROUP BY term")
def index_lexicon(spark, sf_dir):
    """Every word of the documents, in how many it is and how often."""
    return indexed(spark, sf_dir).store.lexicon().filter("within = ''").select("term", "documents", "occurrences")


@query("SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\", CAST(length(text) AS BIGINT) AS chars, lang FROM documents WHERE source = 'src1' AND lang <> 'fr'")
def format_push_down(spark, sf_dir):
    """All documents through the engine's Spark format, some replaced by a second write; a folder is read back by a filter on the URI."""
    datasource.register(spark)
    out = folder(spark)
    docs = document_rows(spark, sf_dir)
    docs.withColumn("content", F.lit(b"old")).write.format("docloom").mode("append").save(out)
    docs.write.format("docloom").mode("append").save(out)
    back = spark.read.format("docloom").load(out).filter(F.col("URI").startswith("/src1/")).filter("collections[0] <> 'fr'")
    return back.select("URI", F.length(F.decode("content", _TEXT)).cast("long").alias("chars"), F.col("collections")[0].alias("lang"))


@query("SELECT CAST(count(*) FILTER (doc_id % 4 <> 0) AS BIGINT) AS success, CAST(count(*) FILTER (doc_id % 4 = 0) AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped FROM documents")
def write_failure_counts(spark, sf_dir):
    """A quarter of the documents is invalid JSON: it is counted and put into an archive, the rest is written."""
    base, bad = folder(spark), folder(spark)
    d = table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 4 == 0, F.lit("{not json")).otherwise(F.to_json(F.struct("doc_id", "lang")))
    docs = documents.blank(d.select(F.concat(F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("URI"), F.encode(text, _TEXT).alias("content"), F.lit("JSON").alias("format")))
    done = documents.write(docs, Engine(spark, base).store, {"write.abortOnFailure": "false", "write.archivePathForFailedDocuments": bad})
    failed = files.read(spark, bad, {"read.files.compression": "zip"}).count()
    return spark.createDataFrame([(done["success"], failed, done["skipped"])], "success long, failed long, skipped long")


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM customer")
def custom_code_sink(spark, sf_dir):
    """Rows to custom code in batches; what it was called with is read back."""
    out = folder(spark)
    import os

    os.makedirs(out)

    def keep(value: str, given: dict) -> None:
        with open(f"{given['folder']}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(value.split(";")))

    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("URI"))
    sinks.process(rows, {"write.batchSize": "100", "write.externalVariableDelimiter": ";", "write.vars.folder": out}, keep)
    return spark.read.text(out).select(F.count_distinct("value").alias("n"))


@query("SELECT doc_id, CAST(2 AS INTEGER) AS dim, true AS labelled FROM documents WHERE length(trim(text)) > 0")
def enrich_chunks(spark, sf_dir):
    """Every document split, classified and embedded; the first chunk of each."""
    docs = documents.blank(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("URI"), F.encode("text", _TEXT).alias("content"), F.lit("TEXT").alias("format")))
    o = {"write.splitter.text": "true", "write.splitter.maxChunkSize": "2000", "write.embedder.batchSize": "64"}
    chunked = enrich.classified(enrich.chunked(docs, o), lambda texts: [f"{len(t)}".encode() for t in texts])
    made = enrich.embedded(chunked, o, lambda texts: [[float(len(t)), 1.0] for t in texts]).filter(F.size("chunks") > 0)
    first = F.col("chunks")[0]
    same = F.forall("chunks", lambda c: F.decode(c["classification"], _TEXT).cast("int") == F.length(c["text"]))
    return made.select(F.col("URI").cast("long").alias("doc_id"), F.size(first["embedding"]).alias("dim"), same.alias("labelled"))


@query(r"""SELECT doc_id, CAST(len(s) AS BIGINT) AS chunks, CAST(list_sum(list_transform(s, lambda x: length(x))) AS BIGINT) AS chars, true AS kept FROM (
SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')) AS s FROM documents) WHERE len(s) > 0""")
def embed_in_place(spark, sf_dir):
    """Every document as JSON whose chunks are its lines; the vectors go into those chunks, and are read back from them."""
    d = table(spark, sf_dir, "documents")
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(x.alias("text")))
    body = F.to_json(F.struct(F.col("doc_id").alias("id"), F.struct(lines.alias("parts")).alias("body"), F.lit("end").alias("last")))
    docs = documents.blank(d.select(F.concat(F.lit("/e/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("URI"), F.encode(body, _TEXT).alias("content"), F.lit("JSON").alias("format")))
    made = enrich.pipeline(docs, {"write.embedder.chunks.jsonPointer": "/body/parts", "write.embedder.batchSize": "256"}, model=lambda texts: [[float(len(t)), 1.0] for t in texts])
    back = F.from_json(F.decode("content", _TEXT), "id long, body struct<parts:array<struct<text:string,_vector:array<float>>>>, last string")
    found = made.select(back.alias("r")).select("r.id", "r.last", F.filter("r.body.parts", lambda c: c["_vector"].isNotNull()).alias("c")).filter(F.size("c") > 0)
    chars = F.aggregate("c", F.lit(0).cast("long"), lambda a, c: a + c["_vector"][0].cast("long"))
    return found.select(F.col("id").alias("doc_id"), F.size("c").cast("long").alias("chunks"), chars.alias("chars"), (F.col("last") == "end").alias("kept"))
