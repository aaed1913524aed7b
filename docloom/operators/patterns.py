"""Graph patterns over triples as joins: what binds variables is a filter and a projection of the triples, what shares them a join."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The places of a pattern and the columns of triple rows they stand for.
PLACES = ("subject", "predicate", "object", "graph")


class PatternError(ValueError):
    pass


@dataclass(frozen=True)
class Var:
    name: str


@dataclass(frozen=True)
class Iri:
    value: str


@dataclass(frozen=True)
class Literal:
    """A literal with any datatype or language, or with the ones that are given."""

    value: str
    datatype: str | None = None
    lang: str | None = None


@dataclass(frozen=True)
class Pattern:
    subject: Var | Iri
    predicate: Var | Iri
    object: Var | Iri | Literal
    graph: Var | Iri | None = None

    def terms(self) -> list[tuple[str, object]]:
        return [(place, t) for place in PLACES if (t := getattr(self, place)) is not None]

    def variables(self) -> set[str]:
        return {t.name for _, t in self.terms() if isinstance(t, Var)}

    def weight(self) -> int:
        """How much the constants narrow the triples: a subject most, then an object, a graph and a predicate."""
        worth = {"subject": 8, "object": 4, "graph": 2, "predicate": 1}
        return sum(worth[place] for place, t in self.terms() if not isinstance(t, Var))


def bindings(rows: DataFrame, pattern: Pattern, nodes: set[str] = frozenset()) -> DataFrame:
    """A column for each variable of the pattern, a row for each triple that fits. nodes: variables that stand for nodes elsewhere, so as objects are no literals."""
    kept: Column = F.lit(True)
    found: dict[str, Column] = {}
    for place, term in pattern.terms():
        value = F.col(place)
        if isinstance(term, Var):
            if term.name in found:
                kept = kept & (found[term.name] == value)
            else:
                found[term.name] = value
            if place == "object" and (term.name in nodes or term.name in {t.name for p, t in pattern.terms() if p != "object" and isinstance(t, Var)}):
                kept = kept & F.col("datatype").isNull()
            kept = kept & value.isNotNull()
        else:
            kept = kept & (value == term.value)
            if place == "object":
                kept = kept & (F.col("datatype").isNull() if isinstance(term, Iri) else F.col("datatype").isNotNull())
                if isinstance(term, Literal) and term.datatype:
                    kept = kept & (F.col("datatype") == term.datatype)
                if isinstance(term, Literal) and term.lang:
                    kept = kept & (F.lower("lang") == term.lang.lower())
    rows = rows.filter(kept)
    return rows.select(*[c.alias(n) for n, c in found.items()])


def ordered(patterns: list[Pattern]) -> list[Pattern]:
    """The patterns as they are joined: first the one with the most telling constants, then of those that share a variable with what is there the one that shares and fixes most."""
    left, known, out = list(patterns), set(), []
    while left:
        able = [p for p in left if p.variables() & known] if known else left
        if not able:
            raise PatternError("patterns that share no variable would pair all their rows")
        best = max(able, key=lambda p: (len(p.variables() & known), p.weight()))
        left.remove(best)
        known |= best.variables()
        out.append(best)
    return out


def solutions(rows: DataFrame, patterns: list[Pattern], optional: Iterable[list[Pattern]] = (), graphs: list[str] | None = None, distinct: bool = True) -> DataFrame:
    """(variables) of each way in which the patterns fit triples together; groups of ``optional`` patterns add to it where they fit, null where not.

    A variable is the text of a term. One that is a subject, predicate or graph anywhere is a node, so the object it meets must be none but a node. A variable that only optional groups
    bind joins nothing outside its group. graphs: read these alone. Solutions are distinct unless told otherwise. No pattern, or patterns that share no variable, are refused.
    """
    if not patterns:
        raise PatternError("there is no pattern")
    if graphs is not None:
        rows = rows.filter(F.col("graph").isin(*graphs))
    optional = [list(g) for g in optional]
    nodes = {t.name for p in [*patterns, *[q for g in optional for q in g]] for place, t in p.terms() if place != "object" and isinstance(t, Var)}

    def joined(group: list[Pattern]) -> DataFrame:
        out = None
        for p in ordered([p for p in group if p.variables()]):
            here = bindings(rows, p, nodes)
            out = here if out is None else out.join(here, sorted(set(out.columns) & p.variables()))
        if out is None:
            raise PatternError("there is no variable")
        for p in group:
            if not p.variables() and bindings(rows, p).isEmpty():  # all constants: it holds or nothing does
                out = out.limit(0)
        return out

    found = joined(patterns)
    certain = set(found.columns)
    for group in optional:
        more = joined(group)
        shared = sorted(certain & set(more.columns))
        if not shared:
            raise PatternError("an optional group must share a variable with the patterns")
        if again := sorted((set(found.columns) - certain) & set(more.columns)):
            raise PatternError(f"{again} are bound by two optional groups")
        found = found.join(more.distinct() if distinct else more, shared, "left")
    return found.distinct() if distinct else found
