"""Secret scans: fixed patterns, and assignment-aware lexing of name-literal pairs with constant propagation."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, replaced, slices, table
from .spans import counted, digest, joined

#: The fixed patterns, in the order of their kinds, each with the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
BASE = ("assign", "access", "hex")
#: The kind of the spans that lexing adds: the characters of a string literal or bare value.
LITERAL = "literal"

#: How strongly a word in a target's name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "auth": 0.7, "authorization": 0.8, "bearer": 0.9, "private": 0.5, "key": 0.5, "access": 0.3, "api": 0.4, "signing": 0.4, "encryption": 0.4, "client": 0.2,
    "session": 0.3, "salt": 0.6, "cert": 0.4, "certificate": 0.4, "pem": 0.5, "mnemonic": 1.0, "phrase": 0.2,
}
#: Targets whose values may hold white space; of others it shows a sentence.
SPACED = {"passphrase", "phrase", "mnemonic", "private", "pem", "certificate"}
#: A literal counts as secret from this product of its target's and its own score.
THRESHOLD = 0.5

_TOKEN = re.compile(
    r"""(?P<end>[\n;,(){}])|(?P<word>[A-Za-z_$][\w$]*(?:[.-]+[\w$]+)*)|(?P<quote>\"{3}|'{3}|["'`])|(?P<compare>[!<>=]=+)|(?P<op>=>|:=|[=:])"""
    r"""|<(?P<element>[A-Za-z_][\w.:-]*)(?P<rest>\s[^<>]*)?>|(?P<close>/?>)|(?P<other>[^\s\w])"""
)
_SPACE = re.compile(r"[ \t]*")
_SPACES = re.compile(r"\s*")
_PREFIX = re.compile(r"[rbfuRBFU]{0,2}(?=[\"'`])")
_NAME = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*(?![\w+/=-])")
_BARE = re.compile(r"[^\s,;#\"'`(){}\[\]<>&=]+={0,2}")
_JOIN = re.compile(r"(?:\+|\.\.|&|\|\|)(?=\s*[\w\"'`$])|(?=[\"'])")
_TYPE = re.compile(r"[ \t]*(?:\[[\w., \[\]]*\])?[ \t]*=(?!=)")
_BLOCK = re.compile(r"[ \t]*[|>][+-]?\d?[+-]?[ \t]*(?:#[^\n]*)?\n")
_LINE = re.compile(r"([ \t]*)([^\n]*)(?:\n|\Z)")
_TEXT = re.compile(r"[^<>]*(?=</)")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_PLACEHOLDER = re.compile(r"\$\{|\$\(|<.*>\Z|%\w+%\Z|\{\{", re.DOTALL)
_REFERENCE = re.compile(r"[A-Za-z_$]+(?:\.[A-Za-z_$]+)+\Z")


class Value:
    """What a name stands for: one literal, or other values joined. Joined ones are kept by reference with the counts of their characters,
    so values that double from line to line stay as small as the text that makes them."""

    __slots__ = ("count", "head", "last", "parts", "reported", "size", "span", "text", "url")

    def __init__(self, text: str = "", span: tuple[int, int] | None = None, parts: list[Value] | None = None):
        self.span, self.parts, self.reported, self.text = span, parts, False, text
        if parts is None:
            self.size, self.head, self.last, self.count = len(text), text[:64], text[-1:], None
            scheme = text.rfind("://")
            self.url = None if scheme < 0 else "@" not in text[scheme:]
        else:
            self.size, self.count, self.head, self.last, self.url = sum(p.size for p in parts), Counter(), "", "", None
            for p in parts:
                self.count.update(p.characters())
                self.head, self.last = (self.head + p.head)[:64] if self.size else "", p.last or self.last
                self.url = p.url if p.url is not None else False if self.url and "@" in p.characters() else self.url

    def characters(self) -> Counter:
        if self.count is None:
            self.count = Counter(self.text)  # once, however often the constant is used
        return self.count

    def literals(self):
        """The spans of the literals in it that weren't given out before."""
        open_ = [self]
        while open_:
            v = open_.pop()
            if not v.reported:
                v.reported = True
                if v.span:
                    yield v.span
                open_ += v.parts or ()


def words_of(name: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(name)]


def sensitivity(name: str) -> float:
    """0 to 1, from the words of a name in snake, kebab, dotted or camel case; the last part counts in full, those before it half."""
    parts = name.split(".")
    best = 0.0
    for k, part in enumerate(parts):
        words = words_of(part)
        words += [a + b for a, b in zip(words, words[1:], strict=False)]
        score = min(1.0, sum(sorted((SENSITIVE.get(w, 0.0) for w in words), reverse=True)[:2]))
        best = max(best, score * (1.0 if k == len(parts) - 1 else 0.5))
    return best


def strength(value: Value, spaced: bool = False) -> float:
    """0 to 1: how much a literal looks like key material, by length, entropy and character classes. Placeholders, addresses without
    credentials, and texts with white space unless ``spaced``, are none."""
    if value.size < 8 or value.url or _PLACEHOLDER.match(value.head if value.size <= 64 else value.head + value.last):
        return 0.0
    count, n = value.characters(), value.size
    if not spaced and any(c.isspace() for c in count):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in count.values())
    classes = {"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "." for c in count}
    return min(1.0, entropy / 3) * (1.0 if len(classes) > 1 else 0.6)


class _Lexer:
    """One pass over source or configuration text, which gives its name-literal pairs.

    A target is the last name, key or index before an assignment sign on its line; its value is a string in one of the quotes, single or triple, a
    bare word, a known name, several of these joined, an indented block, or an element's or attribute's text. A quote that isn't closed on its line (a triple
    one: nowhere) opens no string, nor do others like it on the rest of the line, so no part of the text is searched again and again.
    """

    def __init__(self, text: str):
        self.text, self.known, self.out = text, {}, []
        self.open_until: dict[str, int] = {}  # of each quote, the place up to which it opens no string

    def string(self, quote: str, at: int) -> int | None:
        """Where the string ends that ``quote`` opens, ``at`` being the first place inside; None if it is none."""
        text = self.text
        if at <= self.open_until.get(quote, -1):
            return None
        if len(quote) == 3:
            end = text.find(quote, at)
            if end < 0:
                self.open_until[quote] = len(text)
            return None if end < 0 else end
        line = text.find("\n", at)
        line = len(text) if line < 0 else line
        here = at
        while True:
            end = text.find(quote, here, line)
            if end < 0:
                self.open_until[quote] = line
                return None
            back = end
            while back > here and text[back - 1] == "\\":
                back -= 1
            if (end - back) % 2 == 0:
                return end
            here = end + 1

    def trimmed(self, a: int, b: int) -> Value:
        piece = self.text[a:b]
        a += len(piece) - len(piece.lstrip())
        piece = piece.strip()
        return Value(piece, (a, a + len(piece)))

    def term(self, at: int) -> tuple[Value, int, bool] | None:
        """(value, end, whether it is a literal) of the term at ``at``."""
        text = self.text
        prefix = _PREFIX.match(text, at)
        begin = prefix.end() if prefix else at
        if prefix:
            quote = text[begin] * 3 if text[begin] != "`" and text.startswith(text[begin] * 3, begin) else text[begin]
            end = self.string(quote, begin + len(quote))
            if end is None:
                return None
            inner = begin + len(quote)
            return (self.trimmed(inner, end) if len(quote) == 3 else Value(text[inner:end], (inner, end))), end + len(quote), True
        if name := _NAME.match(text, at):
            if name.end() < len(text) and text[name.end()] in "([":  # a call or an index
                return None
            if found := self.known.get(name[0]):
                return found, name.end(), False
            return Value(name[0], None if _REFERENCE.match(name[0]) else name.span()), name.end(), False
        if bare := _BARE.match(text, at):
            return Value(bare[0], bare.span()), bare.end(), True
        return None

    def value(self, at: int) -> tuple[Value | None, int, bool]:
        """(value, end, whether it is a lone name) of the expression at ``at``; lines inside brackets go on."""
        text = self.text
        at = _SPACE.match(text, at).end()
        inside = text.startswith("(", at)
        skip = _SPACES if inside else _SPACE
        at = skip.match(text, at + inside).end()
        parts, alone, end = [], True, at
        while found := self.term(at):
            piece, at, literal = found
            parts.append(piece)
            end, alone = at, not literal and len(parts) == 1
            after = skip.match(text, at).end()
            join = _JOIN.match(text, after)
            if not join or (after == at and join.end() == after):
                break
            at = skip.match(text, join.end()).end()
        if not parts:
            return None, end, False
        return (parts[0] if len(parts) == 1 else Value(parts=parts)), end, alone

    def block(self, at: int, key: int) -> tuple[Value, int] | None:
        """The block scalar whose sign follows ``at``: all lines after it that are indented further than the line of ``key``."""
        head = _BLOCK.match(self.text, at)
        if not head:
            return None
        line = self.text.rfind("\n", 0, key) + 1
        depth, end = _SPACE.match(self.text, line).end() - line, head.end()
        while end < len(self.text):
            m = _LINE.match(self.text, end)
            if m[2].strip() and len(m[1]) <= depth:
                break
            end = m.end()
        return self.trimmed(head.end(), end), end

    def give(self, name: str, value: Value) -> None:
        self.known[name] = self.known[name.rpartition(".")[2]] = value
        self.out.append((name, value))

    def run(self) -> list[tuple[str, Value]]:
        text, at = self.text, 0
        target = key = None  # name and place of the last name; the key that a tag's attribute names
        while m := _TOKEN.search(text, at):
            kind, at = m.lastgroup if m.lastgroup != "rest" else "element", m.end()
            if kind == "word":
                target = (m[0], m.start())
            elif kind == "quote":
                end = self.string(m[0], at)
                if end is not None:
                    name = text[at:end]
                    target, at = ((name, m.start()) if name else None), end + len(m[0])
            elif kind == "op":
                if target is None:
                    continue
                if m[0] == ":" and (found := self.block(at, target[1])):
                    value, at = found
                    self.give(target[0], value)
                    target = None
                    continue
                value, end, alone = self.value(at)
                if m[0] == ":" and alone and _TYPE.match(text, end):  # a type; the value follows
                    at = end
                    at += text.index("=", at) - at
                    m = None
                if m is not None and value is not None:
                    name = target[0]
                    if name in ("key", "name", "id") and not alone:
                        key = value.text
                    self.give(key if name == "value" and key else name, value)
                    target, at = None, end
            elif kind == "element":
                if m["rest"] is not None:  # its attributes are read like other assignments
                    at = m.start("rest")
                    key = None
                elif inner := _TEXT.match(text, at):
                    value = self.trimmed(at, inner.end())
                    if value.size and text.startswith(m["element"], inner.end() + 2):
                        self.give(m["element"].rpartition(":")[2], value)
                        at = inner.end()
                target = None
            elif kind == "close":
                key = target = None
            elif kind == "end" or kind == "compare":
                target = None
        return self.out


def pairs(text: str) -> list[tuple[str, Value]]:
    """Name-literal pairs of assignments, mappings, settings and elements, in order; names used as values stand for what they were given before."""
    return _Lexer(text).run()


def literals(text: str) -> set[tuple[int, int]]:
    """Spans of literals that reach a sensitive name."""
    out: set[tuple[int, int]] = set()
    for name, value in pairs(text):
        weight = sensitivity(name)
        if weight and weight * strength(value, not SPACED.isdisjoint(words_of(name))) >= THRESHOLD:
            out.update(s for s in value.literals() if s[0] < s[1])
    return out


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive. Null and empty texts have none."""
    if not text:
        return []
    low, found = text.lower(), []
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    if any(w in low for w in SENSITIVE) and ("=" in text or ":" in text or "</" in text):
        found += [(3, a, b) for a, b in literals(text)]
    kinds = (*BASE, LITERAL)
    return [(kinds[k], a, b) for k, a, b in sorted(found, key=lambda x: (x[1], x[0], x[2]))]


def scanned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and ``spans``, an array of (kind, start, end) by start, then kind.

    Rows and other columns stay, repeated rows and null ids too; a column named ``spans`` is replaced. Null and empty texts have no spans. Long texts are
    scanned whole, in time linear in their length; a worker holds one at once. Spans of one kind never tie. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.drop("spans")
    schema = extended(base, "spans array<struct<kind:string,start:int,end:int>>")
    arrow = to_arrow_schema(schema)
    kind = arrow.field("spans").type

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            for a, b in slices(texts):
                spans = [[{"kind": k, "start": x, "end": y} for k, x, y in scan(t)] for t in texts[a:b]]
                yield replaced(batch.slice(a, b - a), {"spans": pa.array(spans, kind)}, arrow)

    return base.mapInArrow(run, schema)


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col("spans")
    return found.select("doc_id", *[counted(s, k).alias(f"n_{k}") for k in BASE], digest(s, BASE).alias("base_sha256"), joined(s).alias("spans"))
