"""Any row as a document: content, URI, metadata, incremental skip, failure policy and counts."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metadata as meta
from ..functions import uris
from ..options import OptionError, Options
from ..schemas import DOCUMENT, kind_of
from ..shared import kept
from . import triples

log = logging.getLogger(__name__)

HASH_KEY = "incrementalWriteHash"


def json_content(df: DataFrame, options: Options, skip: tuple[str, ...] = ()) -> Column:
    """A row as a JSON object; null fields are there unless ``write.json.ignoreNullFields`` is true; other ``write.json.`` options go to Spark."""
    own = {"ignoreNullFields": "false"} | options.family("write.json.")
    body = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in skip])
    if root := options.text("write.jsonRootName"):
        body = F.struct(body.alias(root))
    return F.to_json(body, own)


def xml_content(df: DataFrame, options: Options, skip: tuple[str, ...] = ()) -> Column:
    """A row as an XML element of the given name, in the given namespace."""
    root, namespace = options.text("write.xmlRootName"), options.text("write.xmlNamespace")
    text = F.to_xml(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in skip]), {"rowTag": root})
    if namespace:
        text = F.regexp_replace(text, rf"^<{root}\b", f'<{root} xmlns="{namespace}"')
    return text


def of_rows(df: DataFrame, options: Options | dict | None = None) -> DataFrame:
    """Document rows of any rows, by their shape: files, documents, triples, or each row a document of its own."""
    options = Options.of(options)
    options.exclusive("write.jsonRootName", "write.xmlRootName")
    shape = kind_of(df.schema)
    if shape == "triple":
        return with_metadata(triples.documents(df, options), options, {"collections"})
    if shape == "document":
        named = uris.from_template(options.text("write.uriTemplate"), df.columns, F.decode("content", "UTF-8")) if options.has("write.uriTemplate") else uris.standard(F.col("URI"), options)
        docs = df.select(named.alias("URI"), *[F.col(n) for n in DOCUMENT.names[1:]])
    elif shape == "file":
        text = F.decode("content", "UTF-8")
        named = uris.from_template(options.text("write.uriTemplate"), df.columns, text, options.flag("write.uriTemplate.warnOnMissingField")) if options.has("write.uriTemplate") else uris.standard(F.col("path"), options)
        docs = blank(df.select(named.alias("URI"), "content"))
    else:
        skip = (uris.FILE_PATH_COLUMN,)
        as_xml = options.has("write.xmlRootName")
        text = xml_content(df, options, skip) if as_xml else json_content(df, options, skip)
        pointers = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        named = uris.of_rows(df, options, pointers, ".xml" if as_xml else ".json")
        docs = blank(df.select(named.alias("URI"), F.encode(text, "UTF-8").alias("content"))).withColumn("format", F.lit("XML" if as_xml else "JSON"))
    forced = options.text("write.documentType")
    if forced:
        if forced.upper() not in ("JSON", "XML", "TEXT", "BINARY"):
            raise OptionError(f"Invalid value for write.documentType: {forced}; it must be one of JSON, XML or TEXT.")
        docs = docs.withColumn("format", F.lit(forced.upper()))
    return with_metadata(docs, options)


def blank(df: DataFrame) -> DataFrame:
    """Document columns that are missing, as nulls."""
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields])


def with_metadata(docs: DataFrame, options: Options, keep: set[str] = frozenset()) -> DataFrame:
    """Metadata options replace a row's own, but only those that are set."""
    made: dict[str, Column] = {"format": F.coalesce("format", uris.format_of(F.col("URI")))}
    if options.has("write.collections") and "collections" not in keep:
        made["collections"] = F.array(*[F.lit(c) for c in options.listed("write.collections")])
    if options.has("write.permissions"):
        made["permissions"] = F.create_map(*[x for r, caps in meta.permissions(options.text("write.permissions")).items() for x in (F.lit(r), F.array(*[F.lit(c) for c in caps]))])
    if values := options.family("write.metadataValues."):
        made["metadataValues"] = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    if props := options.family("write.documentProperties."):
        made["properties"] = F.lit("<properties>" + "".join(f"<{k}>{v}</{k}>" for k, v in props.items()) + "</properties>")
    if temporal := options.text("write.temporalCollection"):
        made["collections"] = F.array_union(F.coalesce(made.get("collections", F.col("collections")), F.array().cast("array<string>")), F.array(F.lit(temporal)))
    return docs.withColumns(made)


# transforms

TRANSFORMS: dict[str, Callable[[str, dict[str, str]], str]] = {}


def register_transform(name: str, function: Callable[[str, dict[str, str]], str]) -> None:
    """A function from a document's text and parameters to its new text."""
    TRANSFORMS[name] = function


def params(options: Options, prefix: str) -> dict[str, str]:
    given = [p.strip() for p in (options.text(f"{prefix}Params") or "").split(options.text(f"{prefix}ParamsDelimiter", ",")) if p.strip()]
    if len(given) % 2:
        raise OptionError(f"The {prefix}Params option must contain an equal number of parameter names and values.")
    return dict(zip(given[::2], given[1::2], strict=True))


def transformed(docs: DataFrame, options: Options, prefix: str = "write.transform", only: Column | None = None) -> DataFrame:
    """Applies the named transform to the content, of all rows or where ``only`` holds."""
    name = options.text(prefix)
    if not name:
        return docs
    if name not in TRANSFORMS:
        raise OptionError(f"no transform is registered as {name}")
    function, given = TRANSFORMS[name], params(options, prefix)

    @F.pandas_udf("binary")
    def run(content: pd.Series) -> pd.Series:
        return content.map(lambda c: None if c is None else function(bytes(c).decode(), given).encode())

    new = run("content")
    return docs.withColumn("content", new if only is None else F.when(only, new).otherwise(F.col("content")))


def streamable(options: Options) -> Column:
    """Where a transform runs while content is streamed: binary documents with one of the listed extensions."""
    listed = [e.lower().lstrip(".") for e in options.listed("streamTransformBinaryExtensions")]
    return (F.col("format") == "BINARY") & uris.extension(F.col("URI")).isin(*listed) if listed else F.lit(True)


# incremental write


def canonical(text: str, exclude: tuple[str, ...] = ()) -> str:
    """JSON with sorted keys and no spaces, without the places that the pointers name."""
    value = json.loads(text)
    for pointer in exclude:
        at, parts = value, [p.replace("~1", "/").replace("~0", "~") for p in pointer.strip("/").split("/")]
        for part in parts[:-1]:
            at = at[int(part)] if isinstance(at, list) and part.isdigit() and int(part) < len(at) else at.get(part) if isinstance(at, dict) else None
            if at is None:
                break
        if isinstance(at, dict):
            at.pop(parts[-1], None)
        elif isinstance(at, list) and parts[-1].isdigit() and int(parts[-1]) < len(at):
            del at[int(parts[-1])]
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def content_hash(options: Options | dict | None = None) -> Column:
    """xxhash64 of a document's content; JSON in canonical form unless ``write.incremental.canonicalizeJson`` is false.

    The canonical form is that of Spark's variants, whose objects are sorted by key; only where values are excluded does Python take them out first. What is no JSON is taken as it stands.
    """
    options = Options.of(options)
    exclude = tuple(options.lines("write.incremental.jsonExclusions"))
    if not options.flag("write.incremental.canonicalizeJson", True) and not exclude:
        return F.xxhash64("content")
    if not exclude:
        sorted_ = F.encode(F.to_json(F.try_parse_json(F.decode("content", "UTF-8"))), "UTF-8")
        return F.xxhash64(F.when(F.col("format") == "JSON", F.coalesce(sorted_, F.col("content"))).otherwise(F.col("content")))

    @F.pandas_udf("binary")
    def run(content: pd.Series, fmt: pd.Series) -> pd.Series:
        def one(c, f):
            if c is None or f != "JSON":
                return c
            try:
                return canonical(bytes(c).decode(), exclude).encode()
            except ValueError:
                return c

        return pd.Series([one(c, f) for c, f in zip(content, fmt, strict=True)], dtype=object)

    return F.xxhash64(run("content", "format"))


def changed(docs: DataFrame, stored: DataFrame, options: Options | dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents to write, documents to skip): those whose hash the store has for their URI are skipped. The hash goes with the metadata values."""
    options = Options.of(options)
    key = options.text("write.incremental.hashKeyName", HASH_KEY)
    stamp = options.text("write.incremental.timestampKeyName")
    hashed = docs.withColumn("__hash", F.hex(content_hash(options)))
    known = stored.select("URI", F.element_at("metadataValues", F.lit(key)).alias("__hash")).filter("__hash is not null")
    entries = F.map_filter(F.coalesce("metadataValues", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(*[n for n in (key, stamp) if n]))
    more = F.create_map(F.lit(key), F.col("__hash"), *([F.lit(stamp), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")] if stamp else []))
    new = hashed.join(known, ["URI", "__hash"], "left_anti").withColumn("metadataValues", F.map_concat(entries, more)).drop("__hash")
    return new.select(*docs.columns), hashed.join(known, ["URI", "__hash"], "left_semi").select(*docs.columns)


# failures and counts


def problem() -> Column:
    """Why a document can't be stored, or null."""
    text = F.decode("content", "UTF-8")
    bad_json = (F.col("format") == "JSON") & F.try_parse_json(text).isNull()
    bad_xml = (F.col("format") == "XML") & ~text.rlike(r"(?s)^\s*<.*>\s*$")
    none = F.col("URI").isNull() | (F.trim("URI") == "")
    return F.when(none, "no URI").when(F.col("content").isNotNull() & bad_json, "invalid JSON").when(F.col("content").isNotNull() & bad_xml, "invalid XML")


def write(df: DataFrame, store, options: Options | dict | None = None, enrich: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Writes rows as documents; returns the counts of success, failed and skipped documents.

    Documents are checked as a column, so a bad one never holds up the others: it stops the write, or with ``write.abortOnFailure`` false is
    counted, and put into an archive if a path for failed documents is given.
    """
    options = Options.of(options)
    docs = transformed(of_rows(df, options), options, only=streamable(options) if options.flag("streamFiles") else None)
    if enrich:
        docs = enrich(docs)
    checked = docs.withColumn("__problem", problem())
    if enrich or options.flag("write.incremental"):
        checked = kept(checked, "checked")  # used up to three times below; models and services are called once
    bad = checked.filter("__problem is not null")
    # rows without content or format take those that the store has; where there are none, what is stored isn't read
    failed, partial = checked.agg(F.count(F.when(F.col("__problem").isNotNull(), 1)), F.count(F.when(F.col("content").isNull() | F.col("format").isNull(), 1))).first()
    if failed and options.flag("write.abortOnFailure", True):
        first = bad.select("URI", "__problem").first()
        raise ValueError(f"Unable to write {first['URI']}: {first['__problem']}")
    good = checked.filter("__problem is null").drop("__problem")
    if failed and (path := options.text("write.archivePathForFailedDocuments")):
        from .sinks import write_files

        write_files(bad.drop("__problem"), path, {"write.files.compression": "zip"})
    skipped = 0
    if options.flag("write.incremental"):
        good, same = changed(good, store.read(), options)
        skipped = same.count()
        if skipped and options.flag("write.logSkippedDocuments"):
            log.info("skipped %d documents that have not changed", skipped)
    if every := options.number("write.logProgress", 0, 0):
        good = progressing(good, every, "documents written")
    done = store.write(good, merge_metadata=partial > 0)
    return {"success": done["success"], "failed": failed, "skipped": skipped}


def progressing(rows: DataFrame, every: int, what: str) -> DataFrame:
    """``rows`` as they are; each task logs how many it has handed on, every so many rows."""

    def run(batches):
        from pyspark import TaskContext

        n = 0
        for batch in batches:
            before, n = n, n + batch.num_rows
            if before // every < n // every:
                log.info("task %d: %d %s", TaskContext.get().partitionId(), n // every * every, what)
            yield batch

    return rows.mapInArrow(run, rows.schema)


def bitemporal(versions: DataFrame, key: str, valid: str, system: str) -> DataFrame:
    """Versions of a key with half-open intervals: valid_from, valid_to and system_from, system_to, the open ends null."""
    from pyspark.sql import Window

    by = Window.partitionBy(key)
    return versions.withColumns(
        {
            "valid_from": F.col(valid),
            "valid_to": F.lead(valid).over(by.orderBy(valid, system)),
            "system_from": F.col(system),
            "system_to": F.lead(system).over(by.orderBy(system, valid)),
        }
    )
