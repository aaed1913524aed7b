"""Queries of the engine's own operators over the tables, and SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared
from .functions import metadata, pointers, uris
from .operators import documents, enrich, store, temporal, triples
from .options import Options
from .plans import buckets, dsl, filters, search, views
from .sources import rdf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
#: Fixed text of the XSD namespace, for SQL.
XSD = rdf.XSD


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def builder(spark: SparkSession, sf_dir: str, *names: str, params: dict | None = None, docs: DataFrame | None = None) -> dsl.Builder:
    """A row-query builder over tables as views of schema ``t``."""
    v = views.Views(spark)
    for n in names:
        v.register("t", n, table(spark, sf_dir, n))
    return dsl.Builder(v, docs, params)


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as document rows: language as collection, source as directory."""
    d = table(spark, sf_dir, "documents")
    return documents.blank(
        d.select(
            F.concat(F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("URI"),
            F.encode("text", "UTF-8").alias("content"),
            F.lit("TEXT").alias("format"),
            F.array("lang").alias("collections"),
            F.col("n_chars").cast("int").alias("quality"),
        )
    )


# row queries: scan, filter, project, aggregate, sort


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders WHERE o_orderdate < DATE '1997-01-01'
GROUP BY 1, 2 ORDER BY o_orderstatus, count, o_orderpriority LIMIT 10""")
def slice_filter_group_order_limit(spark, sf_dir):
    return builder(spark, sf_dir, "orders").frame(
        """op.fromView('t', 'orders', '').where(op.sqlCondition("o_orderdate < DATE '1997-01-01'"))
        .groupBy([op.col('o_orderstatus'), op.col('o_orderpriority')], op.count('count'))
        .orderBy([op.col('o_orderstatus'), op.col('count'), op.col('o_orderpriority')]).limit(10)"""
    )


_ORDER = "o_orderkey, o_custkey, o_orderstatus"
_FILTERS = {
    "filter_eq": (("eq", "o_custkey", 7), "o_custkey = 7"),
    "filter_gt": (("gt", "o_custkey", 100), "o_custkey > 100"),
    "filter_ge": (("ge", "o_custkey", 100), "o_custkey >= 100"),
    "filter_lt": (("lt", "o_custkey", 50), "o_custkey < 50"),
    "filter_le": (("le", "o_custkey", 50), "o_custkey <= 50"),
    "filter_ne": (("not", ("eq", "o_orderstatus", "F")), "o_orderstatus <> 'F'"),
    "filter_in": (("in", "o_orderpriority", ["1-URGENT", "2-HIGH"]), "o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    "filter_or": (("or", [("eq", "o_custkey", 1), ("eq", "o_custkey", 2)]), "o_custkey = 1 OR o_custkey = 2"),
    "filter_and_in_or": (("or", [("and", [("lt", "o_custkey", 30), ("gt", "o_custkey", 10)]), ("eq", "o_custkey", 40)]), "(o_custkey < 30 AND o_custkey > 10) OR o_custkey = 40"),
    "filter_nested_bool": (("not", ("or", [("and", [("ge", "o_custkey", 5), ("le", "o_custkey", 900)]), ("eq", "o_orderstatus", "O")])), "NOT ((o_custkey >= 5 AND o_custkey <= 900) OR o_orderstatus = 'O')"),
    "filter_null_safe_eq": (("null_safe_eq", "o_orderstatus", "P"), "o_orderstatus IS NOT DISTINCT FROM 'P'"),
    "filter_sql_condition": (("sql", "o_totalprice BETWEEN 1000 AND 50000"), "o_totalprice BETWEEN 1000 AND 50000"),
}
for _name, (_filter, _sql) in _FILTERS.items():
    query(f"SELECT {_ORDER} FROM orders WHERE {_sql}", _name)(lambda spark, sf_dir, f=_filter: table(spark, sf_dir, "orders").select(*_ORDER.split(", "), "o_orderpriority", "o_totalprice").filter(filters.column(f)).select(*_ORDER.split(", ")))

_PARTS = {
    "filter_contains": (("contains", "p_name", "a"), "contains(p_name, 'a')"),
    "filter_starts": (("starts_with", "p_type", "S"), "starts_with(p_type, 'S')"),
    "filter_ends": (("ends_with", "p_type", "L"), "ends_with(p_type, 'L')"),
    "filter_contains_literal_mark": (("contains", "p_name", "%"), "contains(p_name, '%')"),
    "filter_like_in_or": (("or", [("contains", "p_name", "e"), ("not", ("starts_with", "p_name", "P"))]), "contains(p_name, 'e') OR NOT starts_with(p_name, 'P')"),
    "filter_locate": (("sql", "locate('a', p_name) >= 1"), "instr(p_name, 'a') >= 1"),
}
for _name, (_filter, _sql) in _PARTS.items():
    query(f"SELECT p_partkey, p_name FROM part WHERE {_sql}", _name)(lambda spark, sf_dir, f=_filter: table(spark, sf_dir, "part").filter(filters.column(f)).select("p_partkey", "p_name"))


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query("SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def filter_is_null(spark, sf_dir):
    return _labelled(spark, sf_dir).filter(filters.column(("is_null", "quality"))).select("doc_id", "lang")


@query("SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def filter_is_not_null(spark, sf_dir):
    return _labelled(spark, sf_dir).filter(filters.column(("is_not_null", "quality"))).select("doc_id", "lang", "quality")


@query("SELECT count(*) AS n FROM lineitem WHERE l_quantity > 25 AND l_linenumber = 1 AND l_returnflag = 'R'")
def filter_value_types(spark, sf_dir):
    f = filters.pushed([("gt", "l_quantity", 25.0), ("eq", "l_linenumber", 1), ("eq", "l_returnflag", "R")])
    return table(spark, sf_dir, "lineitem").filter(f).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45")
def project_prune(spark, sf_dir):
    return builder(spark, sf_dir, "lineitem").frame("op.fromView('t','lineitem','').where(op.gt(op.col('l_quantity'), 45)).select(['l_orderkey','l_linenumber'])")


@query("SELECT n_nationkey, n_name FROM nation")
def project_drop(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return n.drop("n_regionkey")


@query("SELECT n_name, CAST(n_nationkey * 2 AS BIGINT) AS twice, 'x' AS tag FROM nation WHERE n_regionkey = 1")
def project_bind_param(spark, sf_dir):
    b = builder(spark, sf_dir, "nation", params={"region": 1, "tag": "x"})
    df = b.frame("op.fromView('t','nation','').where(op.eq(op.col('n_regionkey'), op.param('region'))).select(['n_name', op.as('twice', op.multiply(op.col('n_nationkey'), 2)), op.as('tag', op.param('tag'))])")
    return df.withColumn("twice", F.col("twice").cast("long"))


@query("SELECT n_name, n_nationkey FROM nation WHERE n_regionkey = 2")
def project_qualified_names(spark, sf_dir):
    df = builder(spark, sf_dir, "nation").frame("op.fromView('t','nation').where(op.eq(op.schemaCol('t','nation','n_regionkey'), 2)).select(['t.nation.n_name', 'nation.n_nationkey'])")
    return df.toDF("n_name", "n_nationkey")


@query("SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderpriority LIKE '%HIGH' GROUP BY 1")
def temp_view_sql(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("docloom_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM docloom_orders WHERE o_orderpriority LIKE '%HIGH' GROUP BY 1")


@query("""SELECT l_returnflag, count(*) AS n, count(l_linenumber) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS total, round(avg(l_linenumber), 6) AS mean,
min(l_linenumber) AS least, max(l_linenumber) AS most FROM lineitem GROUP BY 1""")
def agg_many(spark, sf_dir):
    df = builder(spark, sf_dir, "lineitem").frame(
        """op.fromView('t','lineitem','').groupBy('l_returnflag', [op.count('n'), op.count('lines', 'l_linenumber'), op.sum('total', 'l_linenumber'),
        op.avg('mean', 'l_linenumber'), op.min('least', 'l_linenumber'), op.max('most', 'l_linenumber')])"""
    )
    return df.withColumn("mean", F.round("mean", 6)).withColumn("total", F.col("total").cast("long"))


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def agg_count_distinct(spark, sf_dir):
    return builder(spark, sf_dir, "lineitem").frame("op.fromView('t','lineitem','').groupBy('l_returnflag', op.count('suppliers', op.col('l_suppkey'), {values: 'distinct'}))")


@query("SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2")
def agg_two_keys(spark, sf_dir):
    return builder(spark, sf_dir, "lineitem").frame("op.fromView('t','lineitem','').groupBy(['l_returnflag','l_linestatus','l_returnflag'], op.count('count'))")


@query("SELECT count(*) AS n, max(o_custkey) AS most FROM orders")
def agg_global(spark, sf_dir):
    return builder(spark, sf_dir, "orders").frame("op.fromView('t','orders','').groupBy(null, [op.count('n'), op.max('most', 'o_custkey')])")


@query("""SELECT o_orderpriority, max(o_custkey) FILTER (o_orderstatus = 'F') AS "F", max(o_custkey) FILTER (o_orderstatus = 'O') AS "O", max(o_custkey) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def agg_pivot_max(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).max("o_custkey")


@query("""SELECT c_custkey, CAST(count(o_orderkey) AS INTEGER) AS n_orders, min(o_orderkey) AS first_order, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def agg_nest_one(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.struct("o_orderkey", "o_orderstatus").alias("o"))
    nested = table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(o, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey").agg(F.first("c_name").alias("c_name"), F.sort_array(F.collect_list("o")).alias("orders"))
    keys = F.transform("orders", lambda x: x["o_orderkey"])
    return nested.select("c_custkey", F.size("orders").alias("n_orders"), keys[0].alias("first_order"), F.aggregate(keys, F.lit(0).cast("long"), lambda a, x: a + x).alias("key_sum"))


@query("""SELECT c_custkey, CAST(count(DISTINCT o_orderkey) AS INTEGER) AS n_orders, CAST(count(*) AS INTEGER) AS n_lines FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def agg_nest_two(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("lines"))
    o = table(spark, sf_dir, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "lines"))).alias("orders"))
    c = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"))
    return c.select("c_custkey", F.size("orders").alias("n_orders"), F.aggregate("orders", F.lit(0), lambda a, x: a + F.size(x["lines"])).alias("n_lines"))


@query("SELECT o_orderstatus AS graph, CAST(len(array_agg(DISTINCT o_orderpriority)) AS INTEGER) AS n FROM orders GROUP BY 1")
def agg_set_union(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("graph")).agg(F.size(F.collect_set("o_orderpriority")).alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topn_desc(spark, sf_dir):
    return builder(spark, sf_dir, "orders").frame("op.fromView('t','orders','').select(['o_orderkey','o_totalprice']).orderBy([op.desc('o_totalprice'), 'o_orderkey']).limit(20)")


@query("SELECT o_orderpriority, o_orderkey FROM orders ORDER BY o_orderpriority, o_orderkey DESC LIMIT 15")
def topn_two_keys(spark, sf_dir):
    return builder(spark, sf_dir, "orders").frame("op.fromView('t','orders','').select(['o_orderpriority','o_orderkey']).orderBy([op.asc('o_orderpriority'), op.desc('o_orderkey')]).limit(15)")


@query("SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, l_suppkey LIMIT 5")
def topn_by_count(spark, sf_dir):
    return builder(spark, sf_dir, "lineitem").frame("op.fromView('t','lineitem','').groupBy('l_suppkey', op.count('count')).orderBy([op.desc('count'), 'l_suppkey']).limit(5)")


@query("SELECT n_nationkey FROM nation ORDER BY n_nationkey LIMIT 7 OFFSET 3")
def limit_offset_ordered(spark, sf_dir):
    return builder(spark, sf_dir, "nation").frame("op.fromView('t','nation','').select('n_nationkey').orderBy('n_nationkey').offset(3).limit(7)")


# document search

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\pL\pN]+'), lambda t: t <> '')"
_FROM = "SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\" FROM documents WHERE "


def _search(spark, sf_dir, **options):
    found = search.matching(document_rows(spark, sf_dir), search.of_options(Options.of({f"read.documents.{k}": v for k, v in options.items()})))
    return found.select("URI")


_SEARCHES = {
    "search_term": ({"stringQuery": "licensed"}, f"list_contains({_WORDS}, 'licensed')"),
    "search_or": ({"stringQuery": "licensed OR reserved"}, f"list_contains({_WORDS}, 'licensed') OR list_contains({_WORDS}, 'reserved')"),
    "search_and": ({"stringQuery": "the was"}, f"list_contains({_WORDS}, 'the') AND list_contains({_WORDS}, 'was')"),
    "search_not": ({"stringQuery": "the -was"}, f"list_contains({_WORDS}, 'the') AND NOT list_contains({_WORDS}, 'was')"),
    "search_phrase": ({"stringQuery": '"apache license"'}, f"contains(' ' || array_to_string({_WORDS}, ' ') || ' ', ' apache license ')"),
    "search_wildcard": ({"stringQuery": "licen*"}, f"len(list_filter({_WORDS}, lambda t: starts_with(t, 'licen'))) > 0"),
    "search_collection": ({"collections": "fr,de"}, "lang IN ('fr', 'de')"),
    "search_directory": ({"directory": "/src1/"}, "source = 'src1'"),
    "search_collection_and_term": ({"collections": "en", "stringQuery": "trash"}, f"lang = 'en' AND list_contains({_WORDS}, 'trash')"),
    "search_structured_json": ({"query": '{"query":{"queries":[{"or-query":{"queries":[{"term-query":{"text":["trash"]}},{"collection-query":{"uri":["es"]}}]}}]}}'}, f"lang = 'es' OR list_contains({_WORDS}, 'trash')"),
    "search_structured_xml": ({"query": "<query xmlns='urn:q'><and-query><term-query><text>the</text></term-query><collection-query><uri>en</uri></collection-query></and-query></query>"}, f"lang = 'en' AND list_contains({_WORDS}, 'the')"),
    "search_serialized": ({"query": '{"ctsquery":{"wordQuery":{"text":["license"]}}}'}, f"list_contains({_WORDS}, 'license')"),
    "search_combined": ({"query": '{"search":{"qtext":"the","query":{"queries":[{"collection-query":{"uri":["en"]}}]}}}'}, f"lang = 'en' AND list_contains({_WORDS}, 'the')"),
    "uri_list": ({"uris": "/src1/1.txt\n/src2/2.txt\n/src3/3.txt"}, "'/' || source || '/' || doc_id || '.txt' IN ('/src1/1.txt', '/src2/2.txt', '/src3/3.txt')"),
}
for _name, (_options, _sql) in _SEARCHES.items():
    query(_FROM + "(" + _sql + ")", _name)(lambda spark, sf_dir, o=_options: _search(spark, sf_dir, **o))


@query("SELECT lang, count(*) AS n, CAST(count(quality) AS BIGINT) AS with_quality, CAST(0 AS BIGINT) AS with_content FROM (SELECT lang, n_chars AS quality FROM documents) GROUP BY 1")
def doc_categories(spark, sf_dir):
    rows = store.categories(document_rows(spark, sf_dir), Options.of({"read.documents.categories": "collections,quality"}))
    return rows.groupBy(F.col("collections")[0].alias("lang")).agg(F.count("*").alias("n"), F.count("quality").alias("with_quality"), F.count("content").alias("with_content"))


@query("""SELECT DISTINCT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey IN (1, 2) AND s.o_custkey = o.o_custkey)""")
def secondary_uris(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    docs = documents.blank(o.select(F.col("o_orderkey").cast("string").alias("URI"), F.encode(F.col("o_custkey").cast("string"), "UTF-8").alias("content")))
    seed = docs.filter(F.col("URI").isin("1", "2"))
    found = store.with_secondary(seed, docs, store.sharing_key(docs, F.decode("content", "UTF-8")))
    return found.select(F.col("URI").cast("long").alias("o_orderkey"))


@query("SELECT doc_id, quality, toxic, CAST(length(text) AS BIGINT) AS chars FROM labels JOIN documents USING (doc_id)")
def join_doc(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("URI"), F.encode("text", "UTF-8").alias("content"))
    labels = table(spark, sf_dir, "labels").withColumn("__uri", F.col("doc_id").cast("string"))
    v = views.Views(spark)
    v.register("t", "labels", labels)
    df = dsl.Builder(v, docs).frame("op.fromView('t','labels','', op.fragmentIdCol('id')).joinDoc('doc', op.fragmentIdCol('id'))")
    return df.select("doc_id", "quality", "toxic", F.length("doc").cast("long").alias("chars"))


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'")
def join_inner(spark, sf_dir):
    return builder(spark, sf_dir, "nation", "region").frame(
        "op.fromView('t','nation','').joinInner(op.fromView('t','region',''), op.on('n_regionkey','r_regionkey')).where(op.ne(op.col('r_name'),'ASIA')).select(['n_name','r_name'])"
    )


@query("SELECT lang AS value, count(*) AS count FROM documents GROUP BY 1")
def lexicon_counts(spark, sf_dir):
    return builder(spark, sf_dir, docs=document_rows(spark, sf_dir)).frame("op.fromLexicons({value: cts.collectionReference(), uri: cts.uriReference()}).groupBy('value', op.count('count'))")


@query(f"SELECT '/' || source || '/' || doc_id || '.txt' AS uri, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE list_contains({_WORDS}, 'reserved')")
def search_docs_accessor(spark, sf_dir):
    return builder(spark, sf_dir, docs=document_rows(spark, sf_dir)).frame("op.fromSearchDocs(cts.wordQuery('reserved'))").select("uri", F.length("doc").cast("long").alias("chars"))


# rows to documents

_NATION_JSON = """to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey})"""


def _nation(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")


@query(f"SELECT '/nation/' || n_nationkey || '.json' AS \"URI\", CAST({_NATION_JSON} AS VARCHAR) AS doc FROM nation")
def row_to_json(spark, sf_dir):
    return documents.of_rows(_nation(spark, sf_dir), {"write.uriTemplate": "/nation/{n_nationkey}.json"}).select("URI", F.decode("content", "UTF-8").alias("doc"))


@query(f"SELECT '/' || n_name AS \"URI\", CAST(to_json({{'nation': {_NATION_JSON}}}) AS VARCHAR) AS doc FROM nation")
def row_to_json_root(spark, sf_dir):
    return documents.of_rows(_nation(spark, sf_dir), {"write.uriTemplate": "/{n_name}", "write.jsonRootName": "nation"}).select("URI", F.decode("content", "UTF-8").alias("doc"))


@query("SELECT r_regionkey AS id, CASE WHEN r_regionkey = 1 THEN '{\"r_regionkey\":1}' ELSE CAST(to_json({'r_regionkey': r_regionkey, 'r_name': r_name}) AS VARCHAR) END AS doc FROM region")
def row_to_json_ignore_null(spark, sf_dir):
    r = table(spark, sf_dir, "region").select("r_regionkey", F.when(F.col("r_regionkey") != 1, F.col("r_name")).alias("r_name"))
    return r.select(F.col("r_regionkey").alias("id"), documents.json_content(r, Options.of({"write.json.ignoreNullFields": "true"})).alias("doc"))


@query("SELECT '/r/' || r_regionkey || '.xml' AS \"URI\", r_name AS name, CAST(true AS BOOLEAN) AS rooted FROM region")
def row_to_xml(spark, sf_dir):
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    docs = documents.of_rows(r, {"write.uriTemplate": "/r/{r_regionkey}.xml", "write.xmlRootName": "region", "write.xmlNamespace": "urn:r"})
    text = F.decode("content", "UTF-8")
    return docs.select("URI", F.regexp_extract(text, "<r_name>(.*?)</r_name>", 1).alias("name"), text.startswith('<region xmlns="urn:r"').alias("rooted"))


@query("SELECT c_custkey, '/c/' || c_mktsegment || '/' || c_custkey || '.json' AS \"URI\" FROM customer")
def uri_template(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return c.select("c_custkey", uris.from_template("/c/{c_mktsegment}/{c_custkey}.json", c.columns).alias("URI"))


@query("SELECT event_id, '/e/' || event_type || '/' || coalesce(json_extract_string(props, '$.k'), 'none') AS \"URI\" FROM events")
def uri_template_pointer(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    e = e.withColumn("props", F.when(pointers.json_pointer(F.col("props"), "/k").isNull(), F.lit('{"k":"none"}')).otherwise(F.col("props")))
    return e.select("event_id", uris.from_template("/e/{event_type}/{/k}", e.columns, F.col("props")).alias("URI"))


@query("SELECT page_id, '/p' || url || '.html' AS \"URI\" FROM pages")
def uri_prefix_suffix(spark, sf_dir):
    o = Options.of({"write.uriPrefix": "/p", "write.uriSuffix": ".html"})
    return table(spark, sf_dir, "pages").select("page_id", uris.standard(F.col("url"), o).alias("URI"))


@query("SELECT page_id, regexp_replace(regexp_replace(url, '[0-9]+', 'N', 'g'), 'https?://', '/', 'g') AS \"URI\" FROM pages")
def uri_replace(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", uris.replaced(F.col("url"), "[0-9]+,'N',https?://,'/'").alias("URI"))


@query("SELECT page_id, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '') AS path FROM pages")
def uri_to_path(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", uris.to_path(F.col("url")).alias("path"))


@query("SELECT doc_id, '/' || source || '/' || doc_id || '.txt.TEXT.metadata' AS entry, '/' || source || '/' || doc_id || '.txt' AS uri, 'TEXT' AS format FROM documents")
def metadata_entry_names(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("u"))
    e = d.withColumn("entry", uris.metadata_entry(F.col("u"), uris.format_of(F.col("u"))))
    return e.select("doc_id", "entry", uris.metadata_entry_uri(F.col("entry")).alias("uri"), uris.metadata_entry_format(F.col("entry")).alias("format"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_pointer(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", pointers.json_pointer(F.col("props"), "/k").alias("k"))


@query("""SELECT n_nationkey, CAST(2 AS INTEGER) AS roles, CAST(2 AS INTEGER) AS caps, 'read' AS first_cap FROM nation""")
def permissions_map(spark, sf_dir):
    text = F.concat(F.lit("role-"), F.col("n_name"), F.lit(",read,role-"), F.col("n_name"), F.lit(",update,other,READ"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("role-"), F.col("n_name")).alias("role"), metadata.permissions_column(text).alias("p"))
    return n.select("n_nationkey", F.size("p").alias("roles"), F.size(F.col("p")[F.col("role")]).alias("caps"), F.col("p")[F.col("role")][0].alias("first_cap"))


@query("SELECT doc_id, CAST(3 AS INTEGER) AS n, lang AS first_one FROM documents")
def collections_array(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", metadata.collections_column(F.concat(F.col("lang"), F.lit(", "), F.col("source"), F.lit(",x,"))).alias("c"))
    return d.select("doc_id", F.size("c").alias("n"), F.col("c")[0].alias("first_one"))


@query("SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\", 'TEXT' AS format, 'all' AS collection, 'read' AS cap, lang AS kept FROM documents")
def document_metadata_options(spark, sf_dir):
    o = Options.of({"write.permissions": "everyone,read", "write.metadataValues.kind": "all"})
    d = documents.with_metadata(document_rows(spark, sf_dir), o)
    return d.select("URI", "format", F.col("metadataValues")["kind"].alias("collection"), F.col("permissions")["everyone"][0].alias("cap"), F.col("collections")[0].alias("kept"))


@query("SELECT '/' || source || '/' || doc_id || '.txt' AS \"URI\", CAST(length(text) AS BIGINT) AS chars FROM documents WHERE doc_id % 3 <> 0")
def incremental_skip(spark, sf_dir):
    docs = document_rows(spark, sf_dir)
    text = F.decode("content", "UTF-8")
    number = F.regexp_extract("URI", r"/(\d+)\.txt$", 1).cast("long")
    o = {"write.incremental.canonicalizeJson": "false"}
    stored, _ = documents.changed(docs.withColumn("content", F.when(number % 3 == 0, F.col("content")).otherwise(F.encode(F.concat(text, F.lit("!")), "UTF-8"))), docs.limit(0), o)
    new, _ = documents.changed(docs, stored, o)
    return new.select("URI", F.length(F.decode("content", "UTF-8")).cast("long").alias("chars"))


@query("""SELECT o_orderkey, o_custkey, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
o_orderkey AS system_from, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderdate) AS system_to FROM orders""")
def bitemporal_intervals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return documents.bitemporal(o, "o_custkey", "o_orderdate", "o_orderkey").drop("o_orderdate")


_CHANGES = """SELECT DISTINCT client_id, change_id, op = 'D' AS gone, balance, valid_at AS a,
CASE WHEN op = 'I' THEN NULL ELSE valid_at + to_hours(CAST(24 * (change_id % 40 + 1) AS BIGINT)) END AS b FROM client_changes WHERE valid_at IS NOT NULL AND client_id IS NOT NULL"""


@query(f"""WITH w AS ({_CHANGES}), p AS (SELECT v, s FROM (SELECT unnest([TIMESTAMP '2024-02-01', TIMESTAMP '2024-03-15', TIMESTAMP '2024-06-01']) AS v), (SELECT CAST(max(change_id) AS BIGINT) * unnest([1, 2, 4]) // 4 AS s FROM client_changes)),
f AS (SELECT client_id, v, s, arg_max(struct_pack(change_id, gone, balance), change_id) AS r FROM w JOIN p ON change_id <= s AND a <= v AND (b IS NULL OR v < b) GROUP BY 1, 2, 3)
SELECT client_id, v AS valid_time, s AS known_at, r.change_id AS change_id, r.balance AS balance FROM f WHERE NOT r.gone""")
def bitemporal_as_of(spark, sf_dir):
    """The history of all clients' changes, written in two rounds, read at three valid times as known at three points."""
    c = table(spark, sf_dir, "client_changes").filter("valid_at IS NOT NULL AND client_id IS NOT NULL").distinct()
    b = F.when(F.col("op") != "I", F.col("valid_at") + F.make_interval(hours=(24 * (F.col("change_id") % 40 + 1)).cast("int")))
    w = c.select("client_id", "change_id", (F.col("op") == "D").alias("gone"), "balance", F.col("valid_at").alias("a"), b.alias("b"))
    most = table(spark, sf_dir, "client_changes").agg(F.max("change_id")).first()[0]
    history = None
    for part in (w.filter(F.col("change_id") <= most // 2), w.filter(F.col("change_id") > most // 2)):
        history = shared.kept(temporal.applied(history, part, "client_id", "a", "b", "change_id", "gone"), "history")
    found = [temporal.as_of(history, F.to_timestamp_ntz(F.lit(f"{v} 00:00:00")), F.lit(s)).select("client_id", F.to_timestamp_ntz(F.lit(f"{v} 00:00:00")).alias("valid_time"), F.lit(s).cast("long").alias("known_at"), "change_id", "balance") for v in ("2024-02-01", "2024-03-15", "2024-06-01") for s in (most // 4, most * 2 // 4, most)]
    return functools.reduce(DataFrame.unionByName, found)


@query("""WITH w AS (SELECT DISTINCT client_id, change_id, valid_at AS a FROM client_changes WHERE valid_at IS NOT NULL AND client_id IS NOT NULL),
r AS (SELECT client_id, change_id, a, min(a) OVER (PARTITION BY client_id ORDER BY change_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least FROM w)
SELECT client_id, change_id, a AS valid_from, least AS valid_to FROM r WHERE least IS NULL OR a < least""")
def bitemporal_now(spark, sf_dir):
    """What holds now, from all changes with open ends: each change up to the start of a later one."""
    c = table(spark, sf_dir, "client_changes").select("client_id", "change_id", F.col("valid_at").alias("a"), F.lit(None).cast("timestamp_ntz").alias("b")).filter("a IS NOT NULL")
    return temporal.as_of(temporal.applied(None, c, "client_id", "a", "b", "change_id")).select("client_id", "change_id", "valid_from", "valid_to")


# triples


@query(f"""SELECT 'http://n/' || n_nationkey AS subject, predicate, object, datatype, CAST(NULL AS VARCHAR) AS lang, 'http://r/' || n_regionkey AS graph FROM (
SELECT n_nationkey, n_regionkey, 'http://p/name' AS predicate, n_name AS object, '{XSD}string' AS datatype FROM nation
UNION ALL SELECT n_nationkey, n_regionkey, 'http://p/region', CAST(n_regionkey AS VARCHAR), '{XSD}integer' FROM nation)""")
def rows_to_triples(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    columns = {"http://p/name": F.col("n_name"), "http://p/region": F.col("n_regionkey")}
    return triples.of_columns(n, F.concat(F.lit("http://n/"), F.col("n_nationkey").cast("string")), columns, F.concat(F.lit("http://r/"), F.col("n_regionkey").cast("string")))


@query(f"""SELECT 'http://n/' || n_nationkey AS subject, n_name AS object, '{XSD}string' AS datatype, g.graph FROM nation, (VALUES ('http://base/a'), ('http://g/b')) AS g(graph)""")
def triples_of_documents(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    t = triples.of_columns(n, F.concat(F.lit("http://n/"), F.col("n_nationkey").cast("string")), {"http://p/name": F.col("n_name")})
    docs = triples.documents(t, {"write.graph": "http://g/b", "write.collections": "a"})
    return triples.rows(docs, {"read.triples.baseIri": "http://base/"}).select("subject", "object", "datatype", "graph")


@query("""SELECT s_name AS name, n_name AS nation, CASE WHEN s_acctbal < 0 THEN CAST(s_suppkey AS VARCHAR) END AS debtor, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""")
def triples_patterns(spark, sf_dir):
    """Triples of all suppliers, nations and regions; what fits a chain of patterns with an optional one, less a region."""

    def of(name: str, key: str, kind: str, columns: dict, links: dict) -> DataFrame:
        df = table(spark, sf_dir, name)
        node = lambda k, c: F.concat(F.lit(f"http://{k}/"), F.col(c).cast("string"))
        out = triples.of_columns(df, node(kind, key), {f"http://p/{n}": c for n, c in columns.items()})
        for n, (target, c) in links.items():
            iri = F.lit(None).cast("string")
            out = out.unionByName(df.select(node(kind, key).alias("subject"), F.lit(f"http://p/{n}").alias("predicate"), node(target, c).alias("object"), iri.alias("datatype"), iri.alias("lang"), iri.alias("graph")))
        return out

    t = of("supplier", "s_suppkey", "s", {"name": F.col("s_name"), "debtor": F.when(F.col("s_acctbal") < 0, F.col("s_suppkey").cast("string"))}, {"in": ("n", "s_nationkey")})
    t = t.unionByName(of("nation", "n_nationkey", "n", {"called": F.col("n_name")}, {"of": ("r", "n_regionkey")})).unionByName(of("region", "r_regionkey", "r", {"titled": F.col("r_name")}, {}))
    ask = ", ".join(f"op.pattern(op.col('{a}'), sem.iri('http://p/{b}'), op.col('{c}'))" for a, b, c in (("s", "name", "name"), ("s", "in", "n"), ("n", "called", "nation"), ("n", "of", "r"), ("r", "titled", "region")))
    q = f"op.fromTriples([{ask}, op.optional([op.pattern(op.col('s'), sem.iri('http://p/debtor'), op.col('debtor'))])]).where(op.ne(op.col('region'), 'ASIA')).select(['name', 'nation', 'debtor', 'region'])"
    return dsl.Builder(views.Views(spark), triples=t.filter("object IS NOT NULL")).frame(q)


@query("SELECT 'http://g/' || o_orderstatus AS graph, 2 * count(*) AS triples, true AS at_most_100 FROM orders GROUP BY 1")
def triples_batched_100(spark, sf_dir):
    """Two triples of each order into documents of at most 100, a graph a status: what is read back of each graph's documents."""
    o = table(spark, sf_dir, "orders")
    t = triples.of_columns(o, F.concat(F.lit("http://o/"), F.col("o_orderkey").cast("string")), {"http://p/customer": F.col("o_custkey"), "http://p/priority": F.col("o_orderpriority")}, F.concat(F.lit("http://g/"), "o_orderstatus"))
    docs = triples.documents(t).select("URI", "content", "collections")
    of_each = triples.rows(docs.withColumn("collections", F.array(F.concat("URI", F.lit("|"), F.col("collections")[0])))).groupBy("graph").agg(F.count("*").alias("n"))
    return of_each.groupBy(F.substring_index("graph", "|", -1).alias("graph")).agg(F.sum("n").alias("triples"), (F.max("n") <= triples.GROUP).alias("at_most_100"))

@query("SELECT DISTINCT c_mktsegment AS graph FROM customer WHERE c_mktsegment <> 'BUILDING'")
def graph_distinct(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("s").alias("subject"), F.col("c_mktsegment").alias("graph"))
    known = spark.range(1).select(F.lit("BUILDING").alias("graph"))
    return triples.graphs(c, known=known)


@query(f"""SELECT '<http://c/' || c_custkey || '> <http://p/name> "' || c_name || '" <http://g/' || c_mktsegment || '> .' AS value FROM customer
UNION ALL SELECT '<http://c/' || c_custkey || '> <http://p/nation> "' || c_nationkey || '"^^<{XSD}integer> <http://g/' || c_mktsegment || '> .' FROM customer""")
def triples_to_nquads(spark, sf_dir):
    from .operators import sinks

    c = table(spark, sf_dir, "customer")
    t = triples.of_columns(c, F.concat(F.lit("http://c/"), F.col("c_custkey").cast("string")), {"http://p/name": F.col("c_name"), "http://p/nation": F.col("c_nationkey")}, F.concat(F.lit("http://g/"), "c_mktsegment"))
    return sinks.ntriples(t)


# splitting and embedding


@query("SELECT doc_id, CAST(pos AS INTEGER) AS pos, piece FROM (SELECT doc_id, unnest(s) AS piece, unnest(range(len(s))) AS pos FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '') AS s FROM documents))")
def split_regex(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda p: F.trim(p) != "")
    return d.select("doc_id", F.posexplode(lines).alias("pos", "piece"))


@query(r"""WITH d AS (SELECT doc_id, regexp_split_to_array(text, '\s+') AS w FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, list_filter(w, lambda x: trim(x, ' ') <> '') AS w, greatest(2000, list_max(list_transform(w, lambda x: length(x)))) AS size FROM d),
p AS (SELECT doc_id, list_reduce(list_transform(w, lambda x: [length(x)]), lambda a, x: CASE WHEN a[-1] + 1 + x[1] <= size THEN list_concat(a[:-2], [a[-1] + 1 + x[1]]) ELSE list_concat(a, x) END) AS p FROM e WHERE len(w) > 0)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(chars AS INTEGER) AS chars FROM (SELECT doc_id, unnest(p) AS chars, unnest(range(len(p))) AS pos FROM p)""")
def split_regex_packed(spark, sf_dir):
    """Every document's words packed into pieces of at most 2000 characters, or of one longer word."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    longest = F.array_max(F.transform(F.split("text", r"\s+", -1), F.length))  # a piece over the size is an error, so the size is the longest word's at least
    p = d.withColumn("size", F.greatest(F.lit(2000), longest)).select("doc_id", enrich.split_on(F.col("text"), r"\s+", F.col("size"), " ").alias("p"))
    return p.select("doc_id", F.posexplode("p").alias("pos", "piece")).select("doc_id", "pos", F.length("piece").alias("chars"))


@query("SELECT doc_id, CAST(ceil(length(text) / 500.0) AS BIGINT) AS pieces, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE length(text) > 0")
def split_fixed(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter(F.length("text") > 0)
    at = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / 500).cast("int"))
    pieces = F.transform(at, lambda i: F.substring(F.col("text"), i * 500 + 1, F.lit(500)))
    p = d.select("doc_id", F.explode(pieces).alias("piece"))
    return p.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum(F.length("piece")).cast("long").alias("chars"))


@query()
def split_recursive(spark, sf_dir):
    """Every document's pieces of at most 1000 characters."""
    d = documents.blank(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("URI"), F.encode("text", "UTF-8").alias("content")))
    c = enrich.chunked(d, {"write.splitter.text": "true", "write.splitter.maxChunkSize": "1000", "write.splitter.maxOverlapSize": "100"})
    return c.select(F.col("URI").cast("long").alias("doc_id"), F.posexplode("chunks").alias("pos", "c")).select("doc_id", "pos", F.length("c.text").alias("chars"))


@query("""SELECT doc_id, grp, count(*) AS n, '/d/' || doc_id || '.txt-chunks-' || (grp + 1) || '.json' AS "URI" FROM (SELECT doc_id, CAST(floor(unnest(range(len(s))) / 3) AS BIGINT) AS grp FROM (
SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '') AS s FROM documents)) GROUP BY 1, 2""")
def chunks_sidecar_n(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    base = documents.blank(d.select(F.concat(F.lit("/d/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("URI"), F.encode("text", "UTF-8").alias("content")))
    lines = F.filter(F.split(F.decode("content", "UTF-8"), "\n", -1), lambda p: F.trim(p) != "")
    none = F.lit(None)
    chunks = F.transform(lines, lambda t: F.struct(t.alias("text"), none.cast("array<float>").alias("embedding"), none.cast("binary").alias("classification"), none.cast("string").alias("modelName"), none.cast("string").alias("metadata")))
    s = enrich.sidecars(base.withColumn("chunks", chunks), {"write.splitter.sidecar.maxChunks": "3"})
    number = F.regexp_extract("URI", r"-chunks-(\d+)\.json$", 1).cast("long")
    listed = F.from_json(F.decode("content", "UTF-8"), "chunks array<struct<text:string>>")["chunks"]
    return s.select(F.regexp_extract("URI", r"/d/(\d+)", 1).cast("long").alias("doc_id"), (number - 1).alias("grp"), F.size(listed).cast("long").alias("n"), "URI")


@query("SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm FROM embeddings")
def embed_vector_norm(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return e.select("vec_id", F.size("embedding").alias("dim"), F.round(F.sqrt(squares), 6).alias("norm"))


@query("SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, true AS same FROM embeddings")
def embed_base64(spark, sf_dir):
    @F.pandas_udf("string")
    def pack(v: pd.Series) -> pd.Series:
        return v.map(lambda x: enrich.vector_base64(list(x)))

    @F.pandas_udf("array<float>")
    def unpack(t: pd.Series) -> pd.Series:
        return t.map(enrich.vector_of_base64)

    e = table(spark, sf_dir, "embeddings").withColumn("back", unpack(pack("embedding")))
    return e.select("vec_id", F.size("back").alias("dim"), (F.col("back") == F.col("embedding")).alias("same"))


@query("""WITH c AS (SELECT CAST(greatest(1, ceil(ceil(count(*) / 4.0) / 1000.0)) AS BIGINT) AS each FROM orders), x AS (SELECT p, each, unnest(range(each)) AS b FROM c, range(4) AS y(p))
SELECT CAST(p AS INTEGER) AS part, CAST(b AS INTEGER) AS bucket, CAST(CAST(18446744073709551616 AS HUGEINT) * (p * each + b) // (4 * each) AS DECIMAL(20, 0)) AS lower,
CAST(CAST(18446744073709551616 AS HUGEINT) * (p * each + b + 1) // (4 * each) - 1 AS DECIMAL(20, 0)) AS upper FROM x""")
def rowid_buckets(spark, sf_dir):
    """The row-id ranges that a stream of all orders is dealt into, 1,000 rows each."""
    from decimal import Decimal

    plan = buckets.plan(4, 1000, table(spark, sf_dir, "orders").count())
    rows = [(p, b, Decimal(x.lower), Decimal(x.upper)) for p, part in enumerate(plan) for b, x in enumerate(part.buckets)]
    return spark.createDataFrame(rows, "part int, bucket int, lower decimal(20,0), upper decimal(20,0)")

_BARE = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<head\b.*?</head>', ' ', 'g'), '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'),
'(?i)<(br|/p|/div|/li|/h[0-9])[^>]*>', chr(10), 'g')"""
_SHOWN = rf"""replace(replace(replace(replace(replace(replace(replace(regexp_replace({_BARE}, '(?s)<[^>]+>', ' ', 'g'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&')"""


@query(rf"""SELECT page_id, CAST(length(array_to_string(list_filter(list_transform(string_split({_SHOWN}, chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), lambda x: x <> ''), chr(10))) AS INTEGER) AS chars, 'text/html' AS kind FROM pages""")
def html_text(spark, sf_dir):
    """The text of every page."""
    p = table(spark, sf_dir, "pages").select(F.concat(F.col("url"), F.lit(".html")).alias("URI"), F.encode("html", "UTF-8").alias("content"), "page_id")
    return enrich.with_text(p).select("page_id", F.length("extracted_text").alias("chars"), F.col("extracted_metadata")["content-type"].alias("kind"))



from . import queries_io  # noqa: E402, F401  its queries register themselves
