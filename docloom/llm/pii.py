"""PII: fixed patterns plus information-theoretic sanitisation, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .spans import counted, digest, joined

#: The fixed kinds in order. The patterns match what the plain ones match, without backtracking: quantifiers are possessive where nothing
#: that follows can take back a character, and a match starts only at the start of its run or where the last match ended. Card candidates
#: under twelve digits, which never count, are not matched at all.
BASE = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What the method adds: a term that reveals a protected entity.
TERM = "term"
#: A term discloses an entity if p(entity | term) reaches REMOVE (it is removed) or GENERALISE (it is replaced by its class) and it tells at least
#: BITS of information about it: log2 of how much likelier it makes the entity.
REMOVE, GENERALISE, BITS = 0.9, 0.5, 3.0
#: Bytes of a table of terms, or of the terms of rows, up to which it is broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Array elements that one fold appends one by one, and characters of the pieces that texts are cut into: both bound what a step copies.
FOLD, PIECE = 256, 1024

_SPAN = "array<struct<start:int,kind:int,end:int,level:string>>"
_FOUND = "array<struct<start:int,kind:int,end:int,match:string>>"


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _folded(items: Column, at: Column, empty: Column, step) -> Column:
    """What ``step(position, item)`` gives for each item in order, as one array; it returns (the next position, an array to append).

    Items are folded in blocks of ``FOLD``, so appending copies at most that many each time; a block's last position is found apart from what it gives.
    """

    def block(a: Column, first: Column) -> Column:
        mine = F.slice(items, first, F.lit(FOLD))
        after = F.aggregate(mine, a["at"], lambda b, x: step(b, x)["at"])
        start = F.struct(a["at"].alias("at"), empty.alias("out"))
        out = F.aggregate(mine, start, lambda b, x: F.struct(step(b["at"], x)["at"].alias("at"), F.concat(b["out"], step(b["at"], x)["out"]).alias("out")), lambda b: b["out"])
        return F.struct(after.alias("at"), F.concat(a["all"], F.array(out)).alias("all"))

    firsts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(FOLD))).otherwise(F.array().cast("array<int>"))
    none = F.slice(F.array(empty), 1, 0)
    return F.aggregate(firsts, F.struct(at.alias("at"), none.alias("all")), block, lambda a: F.struct(a["at"].alias("at"), F.flatten(a["all"]).alias("out")))


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, match) of a pattern's matches in order: running sums over the lengths of the texts between them, and of them, give the places.

    The text is matched and cut once; the time is linear in its length and its matches.
    """
    pattern = F.lit(pattern)
    both = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def step(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        end = start + F.length(x["match"])
        return F.struct(end.alias("at"), F.array(F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"))).alias("out"))

    return _let(F.filter(both, lambda x: x["match"].isNotNull()), lambda items: _folded(items, F.lit(0), empty, step)["out"])


def _luhn(digits: Column) -> Column:
    """Whether the digit string's checksum is right."""
    n = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.when((n - i) % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(digits, i, F.lit(1)).cast("int") + 1)).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return match.rlike(rf"\A(?:{part}|0++)(?:\.(?:{part}|0++)){{3}}\z")
    if kind == "card":
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """(start, kind, end, match) of the fixed kinds by start, then kind; kind is its place in ``BASE``. Code points, end exclusive."""
    rare = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(PATTERNS["card"]), "phone": text.rlike(r"\+[0-9]")}
    none = F.array().cast(_FOUND)

    def of(k: int, kind: str) -> Column:
        good = F.filter(_matches(text, PATTERNS[kind]), lambda m: _holds(kind, m["match"]))
        return F.when(rare[kind], F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), m["match"].alias("match")))).otherwise(none)

    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(BASE)]))


def entity(kind: Column, match: Column) -> Column:
    """What a match names: the kind, and the lower-cased address or the digits."""
    return F.concat_ws(":", kind.cast("string"), F.when(kind == 0, F.lower(match)).when(kind == 1, match).otherwise(F.regexp_replace(match, "[^0-9]", "")))


def _words(text: Column) -> Column:
    """Lower-cased runs of three or more letters; digits and marks belong to no term."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}{3,}+"), F.lit(0)), F.lower)


def _fits(table_: DataFrame, size: Column) -> bool:
    """Whether a table may be broadcast: its rows' sizes sum up to ``BROADCAST_BYTES`` at most."""
    return (table_.agg(F.sum(size.cast("long") + 64)).first()[0] or 0) <= BROADCAST_BYTES


def held(rows: DataFrame) -> DataFrame:
    """(entity, row, n): the entities of the rows (row, found), by the hash of the row's text, and how many rows have that text."""
    named = F.array_distinct(F.transform("found", lambda s: entity(s["kind"], s["match"])))
    return rows.select("row", F.explode(named).alias("entity")).groupBy("entity", "row").agg(F.count("*").alias("n"))


def disclosing(texts: DataFrame, rows: DataFrame, holds: DataFrame) -> DataFrame:
    """(entity, term, share): terms whose corpus co-occurrence with an entity discloses it.

    texts: every row's text; rows: (row, text, found) of those with fixed spans; holds: ``held(rows)``. Both sides of
    share = p(entity | term) count rows: of those that hold the term anywhere, those that hold the entity anywhere. log2(share / p(entity)) is their pointwise
    mutual information. A pair counts only if two different texts hold both, so that repeated mentions and copies of one text are no evidence.
    Pairs and terms are counted in each task before they are summed, with a state of fixed size each.
    """
    none = "entity string, term string, share double"
    spark = texts.sparkSession
    entities = written(holds.groupBy("entity").agg(F.sum("n").alias("held"), F.count("*").alias("texts")).filter("texts > 1").drop("texts"), "pii-entities")
    if entities.isEmpty():
        return spark.createDataFrame([], none)
    small = _fits(entities, F.length("entity"))
    again = holds.join(F.broadcast(entities) if small else entities, "entity").groupBy("row").agg(F.collect_list("entity").alias("entities"))
    again = written(again, "pii-recurring")
    small = _fits(again, F.aggregate("entities", F.lit(0), lambda a, e: a + F.length(e) + 16))
    of_rows = rows.select("row", F.array_distinct(_words(F.col("text"))).alias("terms")).join(F.broadcast(again) if small else again, "row")
    near = of_rows.select("row", F.explode("entities").alias("entity"), "terms").select("row", "entity", F.explode("terms").alias("term")).groupBy("entity", "term")
    pairs = written(near.agg(F.count("*").alias("both"), F.min("row").alias("a"), F.max("row").alias("b")).filter("a <> b").drop("a", "b"), "pii-pairs")

    def holding(some: DataFrame) -> DataFrame:
        return some.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))

    # rows with fixed spans alone hold a term at most as often as all rows, which rules out common words before all rows are counted
    least = holding(rows).groupBy("term").agg(F.count("*").alias("least"))
    pairs = written(pairs.join(least, "term").filter(F.col("both") >= F.col("least") * GENERALISE).drop("least"), "pii-candidates")
    terms = written(pairs.select("term").distinct(), "pii-terms")
    words = holding(texts)
    small = _fits(terms, F.length("term"))
    counted_ = (words.join(F.broadcast(terms), "term", "left_semi") if small else words).groupBy("term").agg(F.count("*").alias("rows"))
    share, every = F.col("both") / F.col("rows"), texts.count()
    told = pairs.join(counted_, "term").join(entities, "entity").withColumn("share", share)
    enough = (F.col("share") >= GENERALISE) & (F.log2(F.col("share") * every / F.col("held")) >= BITS)
    return written(told.filter(enough).select("entity", "term", "share"), "pii-told")


def _term_spans(text: Column, terms: Column, fixed: Column) -> Column:
    """Spans of the terms (term, share) in the text as whole words, but for those inside a fixed span. The text's words are found once."""
    names = F.transform(terms, lambda t: t["term"])
    empty = F.array().cast(_SPAN)

    def shown(words: Column) -> Column:
        free = F.filter(words, lambda m: F.array_contains(names, F.lower(m["match"])) & ~F.exists(fixed, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])))

        def span(m: Column) -> Column:
            share = F.element_at(terms, F.array_position(names, F.lower(m["match"])).cast("int"))["share"]
            level = F.when(share >= REMOVE, F.lit("removed")).otherwise(F.lit("generalised"))
            return F.struct(m["start"].alias("start"), F.lit(len(BASE)).alias("kind"), m["end"].alias("end"), level.alias("level"))

        return F.transform(free, span)

    return F.coalesce(shown(_matches(text, r"\p{L}{3,}+")), empty)


def found(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and ``spans``: (kind, start, end, level) by start, then kind; level is empty for the fixed kinds, else removed or generalised.

    Null and empty texts have no spans; long texts are searched whole. In each row that holds an entity, terms that disclose it are spans wherever they stand
    outside of fixed spans; of several entities the highest share counts. Rows and other columns stay whatever their names, repeated rows too; a column
    named ``spans`` is replaced. An empty table gives no rows.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    marked = docs.select(F.struct(*kept).alias("r"), text.alias("text"), base_spans(text).alias("found"))
    rows = written(marked.filter("size(found) > 0").withColumn("row", F.xxhash64("text")), "pii-rows")
    holds = written(held(rows), "pii-held")
    told = disclosing(docs.select(text.alias("text")), rows, holds)
    each = holds.join(told, "entity").groupBy("row", "term").agg(F.max("share").alias("share"))
    by_row = written(each.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("term", "share"))).alias("terms")), "pii-terms-of-rows")
    small = _fits(by_row, F.aggregate("terms", F.lit(0), lambda a, t: a + F.length(t["term"]) + 32))
    fixed = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit("").alias("level")))
    if by_row.isEmpty():
        told_rows = marked.withColumn("all", fixed)
    else:  # only rows with fixed spans, which are few, meet the terms; their patterns aren't matched again
        extra = F.when(F.col("terms").isNotNull(), _term_spans(F.col("text"), F.col("terms"), F.col("found"))).otherwise(F.array().cast(_SPAN))
        plain = marked.filter("size(found) = 0").select("r", F.array().cast(_SPAN).alias("all"))
        told_rows = plain.unionByName(rows.join(F.broadcast(by_row) if small else by_row, "row", "left").select("r", F.array_sort(F.concat(fixed, extra)).alias("all")))
    kinds = F.array(*[F.lit(k) for k in (*BASE, TERM)])
    spans = F.transform("all", lambda s: F.struct(F.element_at(kinds, s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["level"].alias("level")))
    return told_rows.select("r.*", spans.alias("spans"))


def _between(pieces: Column, a: Column, b: Column) -> Column:
    """The characters from a to b of a text that is given in pieces of ``PIECE`` characters."""

    def part(i: Column) -> Column:
        first = F.greatest(a - i * PIECE, F.lit(0))
        return F.substring(F.get(pieces, i), first + 1, F.least(b - i * PIECE, F.lit(PIECE)) - first)

    whole = F.transform(F.sequence(F.floor(a / PIECE).cast("int"), F.floor((b - 1) / PIECE).cast("int")), part)
    return F.when(a < b, F.concat_ws("", whole)).otherwise(F.lit(""))


def sanitized(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span's text replaced: by its kind in brackets, or for a generalised term by its length class.

    Spans that overlap are replaced as one, named by the first. Null texts stay null; other columns stay as they are, but for one named ``spans``, which goes.
    """
    text = F.col(f"`{text_col}`")

    def shown(s: Column) -> Column:
        size = F.when(s["end"] - s["start"] <= 5, F.lit("[SHORT WORD]")).otherwise(F.lit("[LONG WORD]"))
        return F.when(s["level"] == "generalised", size).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def clean(pieces: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            out = F.when(s["start"] >= at, F.array(_between(pieces, at, s["start"]), shown(s))).otherwise(F.array().cast("array<string>"))
            return F.struct(F.greatest(at, s["end"]).alias("at"), out.alias("out"))

        return _let(_folded(F.col("spans"), F.lit(0), F.array().cast("array<string>"), step), lambda r: F.concat(F.concat_ws("", r["out"]), _between(pieces, r["at"], F.length(text))))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), F.lit(0))
    return found(docs, text_col).withColumn(text_col, F.when(F.size("spans") > 0, _let(pieces, clean)).otherwise(text)).drop("spans")


def op7_pii(spark, sf_dir: str) -> DataFrame:
    marked = found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col("spans")
    return marked.select("doc_id", *[counted(s, k).alias(f"n_{k}") for k in BASE], digest(s, BASE).alias("base_sha256"), joined(s).alias("spans"))
