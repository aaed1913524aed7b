"""A chain language for row queries: ``op.fromView('s', 'v').where(op.eq(op.col('x'), 1)).select(['x']).orderBy(op.desc('x'))``."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import names
from .views import Views

_TOKEN = re.compile(r"""\s*(?:(?P<number>-?\d+(?:\.\d+)?)|(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<name>[A-Za-z_$][\w$]*)|(?P<mark>[.,:()\[\]{}])|(?P<end>$))""")


@dataclass(frozen=True)
class Call:
    name: str
    args: tuple


@dataclass(frozen=True)
class Chain:
    calls: tuple[Call, ...]


class DslError(ValueError):
    pass


def parse(text: str) -> Any:
    """The chain's calls. Values: numbers, strings, true, false, null, lists, objects and chains."""
    tokens, at = [], 0
    text = text.strip().removesuffix(";")
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise DslError(f"unexpected character at {at}: {text[at : at + 20]!r}")
        at = m.end()
        if m.lastgroup != "end":
            tokens.append((m.lastgroup, m[m.lastgroup]))
    pos = 0

    def peek() -> tuple[str, str]:
        return tokens[pos] if pos < len(tokens) else ("end", "")

    def take(mark: str | None = None) -> tuple[str, str]:
        nonlocal pos
        token = peek()
        if mark is not None and token[1] != mark:
            raise DslError(f"expected {mark!r}, found {token[1]!r}")
        pos += 1
        return token

    def several(close: str, item: Callable) -> list:
        out = []
        while peek()[1] != close:
            out.append(item())
            if peek()[1] != ",":
                break
            take(",")
        take(close)
        return out

    def value() -> Any:
        kind, word = take()
        if kind == "number":
            return float(word) if "." in word else int(word)
        if kind == "text":
            return re.sub(r"\\(.)", r"\1", word[1:-1])
        if word == "[":
            return several("]", value)
        if word == "{":

            def pair():
                _, key = take()
                take(":")
                return key.strip("'\""), value()

            return dict(several("}", pair))
        if kind != "name":
            raise DslError(f"unexpected {word!r}")
        if word in ("true", "false", "null"):
            return {"true": True, "false": False, "null": None}[word]
        calls, here = [], word
        while True:
            if peek()[1] == "(":
                take("(")
                calls.append(Call(here, tuple(several(")", value))))
            elif not calls and here in ("op", "cts", "sem", "rdf", "xs"):
                pass
            else:
                raise DslError(f"{here!r} is not a value")
            if peek()[1] != ".":
                return Chain(tuple(calls))
            take(".")
            _, here = take()

    found = value()
    if pos != len(tokens):
        raise DslError(f"unexpected {peek()[1]!r}")
    return found


_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
    "multiply": lambda a, b: a * b,
    "divide": lambda a, b: a / b,
}
_AGGREGATE = {"count": F.count, "sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max}


class Builder:
    """Turns parsed chains into DataFrames. Grouping, order and limits hold over all rows, however the scan is partitioned."""

    def __init__(self, views: Views, store=None, params: dict[str, Any] | None = None, triples: DataFrame | None = None):
        """triples: triple rows for ``fromTriples``; without them those of the store's documents."""
        self.views, self.store, self.params, self.triples = views, store, params or {}, triples

    def frame(self, text: str) -> DataFrame:
        chain = parse(text)
        if not isinstance(chain, Chain) or not chain.calls or not chain.calls[0].name.startswith("from"):
            raise DslError("a query starts with an accessor such as fromView")
        first, *rest = chain.calls
        df = getattr(self, f"_{first.name}", self._unknown(first))(*first.args)
        for call in rest:
            df = getattr(self, f"_{call.name}", self._unknown(call))(df, *call.args)
        return df

    def _unknown(self, call: Call) -> Callable:
        def fail(*_):
            raise DslError(f"{call.name} is not supported")

        return fail

    # accessors
    def _fromView(self, schema, view, qualifier=None, fragment=None) -> DataFrame:  # noqa: N802
        df = self.views.open(schema, view, qualifier)
        if fragment is None:
            return df
        base = self.views._views[schema, view]
        name = fragment.calls[0].args[0] if isinstance(fragment, Chain) else fragment
        prefix = (schema, view) if qualifier is None else ("", qualifier)
        return base.select(*[F.col(names.quoted(c)).alias(name if c == "__uri" else names.qualified(*prefix, c)) for c in base.columns])

    def _fromSearchDocs(self, query=None) -> DataFrame:  # noqa: N802
        from .search import query_column

        docs = self._documents()
        docs = docs if query is None else docs.filter(query_column(query))
        return docs.select(F.col("URI").alias("uri"), F.decode("content", "UTF-8").alias("doc"))

    def _fromLexicons(self, refs) -> DataFrame:  # noqa: N802
        """{name: reference}: one row for each distinct combination of a document's values."""
        docs = self._documents().select("URI", F.explode_outer("collections").alias("__collection"), F.decode("content", "UTF-8").alias("__doc"))
        cols = []
        for name, ref in refs.items():
            call = ref.calls[-1]
            if call.name == "collectionReference":
                cols.append(F.col("__collection").alias(name))
            elif call.name == "uriReference":
                cols.append(F.col("URI").alias(name))
            else:
                cols.append(F.get_json_object("__doc", f"$.{call.args[0]}").alias(name))
        return docs.select(*cols).distinct()

    def _fromTriples(self, patterns, qualifier=None, graphs=None, options=None) -> DataFrame:  # noqa: N802
        """Solutions of op.pattern(subject, predicate, object, graph) calls: op.col is a variable, sem.iri an IRI, anything else a literal; op.optional([patterns]) is left joined."""
        from ..operators import patterns as p
        from ..operators.triples import rows

        def term(value, literal: bool):
            if isinstance(value, Chain):
                call = value.calls[-1]
                if call.name in ("col", "graphCol"):
                    return p.Var(call.args[-1])
                if call.name == "iri":
                    return p.Iri(call.args[0])
                if call.name == "langString":
                    return p.Literal(call.args[0], lang=call.args[1])
                if call.name == "typed":
                    return p.Literal(str(call.args[0]), datatype=call.args[1])
                raise DslError(f"{call.name} is no term of a pattern")
            return p.Literal(str(value)) if literal else p.Iri(str(value))

        def pattern(chain: Chain) -> p.Pattern:
            call = chain.calls[-1]
            if call.name != "pattern" or not 3 <= len(call.args) <= 4:
                raise DslError("a pattern has a subject, a predicate, an object and perhaps a graph")
            return p.Pattern(*[term(a, k == 2) for k, a in enumerate(call.args)])

        each = patterns if isinstance(patterns, list) else [patterns]
        needed = [pattern(c) for c in each if c.calls[-1].name != "optional"]
        groups = [[pattern(c) for c in (g if isinstance(g, list) else [g])] for x in each if x.calls[-1].name == "optional" for g in [x.calls[-1].args[0]]]
        names_ = None if graphs is None else [g.calls[-1].args[0] if isinstance(g, Chain) else g for g in (graphs if isinstance(graphs, list) else [graphs])]
        triples = self.triples if self.triples is not None else rows(self._documents())
        found = p.solutions(triples, needed, groups, names_, (options or {}).get("dedup", "on") != "off")
        return found.select(*[F.col(names.quoted(c)).alias(names.qualified("", qualifier or "", c)) for c in found.columns])

    def _documents(self) -> DataFrame:
        if self.store is None:
            raise DslError("this accessor needs a document store")
        return self.store if isinstance(self.store, DataFrame) else self.store.read()

    # chain operators
    def _where(self, df: DataFrame, condition) -> DataFrame:
        return df.filter(self.expression(df, condition))

    def _select(self, df: DataFrame, columns, qualifier=None) -> DataFrame:
        cols = [self.expression(df, c) if isinstance(c, Chain) else names.column(names.resolve(df.columns, c)) for c in (columns if isinstance(columns, list) else [columns])]
        return df.select(*cols)

    def _bind(self, df: DataFrame, column) -> DataFrame:
        cols = [self.expression(df, c) for c in (column if isinstance(column, list) else [column])]
        return df.select("*", *cols)

    def _groupBy(self, df: DataFrame, keys, aggregates=None) -> DataFrame:  # noqa: N802
        keys = keys if isinstance(keys, list) else [] if keys is None else [keys]
        found = list(dict.fromkeys(names.resolve(df.columns, self._name(k)) for k in keys))
        made = [self._aggregate(df, a) for a in (aggregates if isinstance(aggregates, list) else [] if aggregates is None else [aggregates])]
        grouped = df.groupBy(*[names.quoted(k) for k in found])
        return grouped.agg(*made) if made else df.select(*[names.column(k) for k in found]).distinct()

    def _aggregate(self, df: DataFrame, chain: Chain) -> Column:
        call = chain.calls[-1]
        if call.name not in _AGGREGATE:
            raise DslError(f"{call.name} is not an aggregate")
        name = call.args[0]
        target = F.lit(1) if len(call.args) < 2 or call.args[1] is None else names.column(names.resolve(df.columns, self._name(call.args[1])))
        if len(call.args) > 2 and call.args[2].get("values") == "distinct":
            return {"count": F.count_distinct, "sum": F.sum_distinct}.get(call.name, _AGGREGATE[call.name])(target).alias(name)
        return _AGGREGATE[call.name](target).alias(name)

    def _orderBy(self, df: DataFrame, *keys) -> DataFrame:  # noqa: N802
        out = []
        for k in [x for key in keys for x in (key if isinstance(key, list) else [key])]:
            call = k.calls[-1] if isinstance(k, Chain) else None
            inner = call.args[0] if call and call.name in ("asc", "desc") else k
            col = names.column(names.resolve(df.columns, self._name(inner)))
            out.append(col.desc_nulls_last() if call and call.name == "desc" else col.asc_nulls_first())
        return df.orderBy(*out)

    def _limit(self, df: DataFrame, n: int) -> DataFrame:
        return df.limit(n)

    def _offset(self, df: DataFrame, n: int) -> DataFrame:
        return df.offset(n)

    def _whereDistinct(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return df.distinct()

    def _joinDoc(self, df: DataFrame, name, fragment) -> DataFrame:  # noqa: N802
        key = names.resolve(df.columns, self._name(fragment))
        docs = self._documents().select(F.col("URI").alias(key), F.decode("content", "UTF-8").alias(self._name(name)))
        return df.join(docs, names.quoted(key) if "." not in key else key, "inner")

    def _joinInner(self, df: DataFrame, other, on) -> DataFrame:  # noqa: N802
        right = getattr(self, f"_{other.calls[0].name}")(*other.calls[0].args)
        for call in other.calls[1:]:
            right = getattr(self, f"_{call.name}", self._unknown(call))(right, *call.args)
        pairs = [c.calls[-1].args for c in (on if isinstance(on, list) else [on])]
        condition = F.lit(True)
        for a, b in pairs:
            condition = condition & (df[names.quoted(names.resolve(df.columns, self._name(a)))] == right[names.quoted(names.resolve(right.columns, self._name(b)))])
        return df.join(right, condition, "inner")

    def _prepare(self, df: DataFrame, *_) -> DataFrame:
        return df

    # expressions
    def _name(self, value) -> str:
        if isinstance(value, Chain):
            call = value.calls[-1]
            if call.name in ("col", "viewCol", "schemaCol", "fragmentIdCol"):
                return ".".join(str(a) for a in call.args)
            raise DslError(f"{call.name} is not a column")
        return value

    def expression(self, df: DataFrame, value) -> Column:
        if isinstance(value, list):
            return F.array(*[self.expression(df, v) for v in value])
        if not isinstance(value, Chain):
            return F.lit(value)
        call = value.calls[-1]
        name, args = call.name, call.args
        each = lambda xs: [self.expression(df, x) for x in xs]
        if name in ("col", "viewCol", "schemaCol", "fragmentIdCol"):
            return names.column(names.resolve(df.columns, self._name(value)))
        if name == "param":
            key = args[0] if isinstance(args[0], str) else args[0].get("name")
            if key not in self.params:
                raise DslError(f"no value for parameter {key}")
            return F.lit(self.params[key])
        if name == "as":
            return self.expression(df, args[1]).alias(args[0])
        if name in _COMPARE:
            a, b = each(args)
            return _COMPARE[name](a, b)
        if name in ("and", "or"):
            out, *rest = each(args[0] if len(args) == 1 and isinstance(args[0], list) else args)
            for x in rest:
                out = out & x if name == "and" else out | x
            return out
        if name == "not":
            return ~self.expression(df, args[0])
        if name == "in":
            return self.expression(df, args[0]).isin(*args[1])
        if name == "isDefined":
            return self.expression(df, args[0]).isNotNull()
        if name == "sqlCondition":
            return F.expr(args[0])
        if name.endswith("Query"):
            from .search import query_column

            return query_column(value)
        raise DslError(f"{name} is not supported")
