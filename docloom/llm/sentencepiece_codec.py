"""SentencePiece encoding and decoding without its encoder: exact merge-type encoding by backtracking."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from array import array
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import extended, replaced, slices, spared

SPACE = "▁"
#: Entries of each half of a worker's memory of chunk encodings, and of its memory of pair checks.
MEMORY = 300_000
#: Longer chunks are encoded each time.
LONG = 64


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("docloom.bytewise", _one_by_one)


class _Row(dict):
    """Of a left piece: whether each right piece stays apart from it when the text of both is merged anew."""

    def __init__(self, codec: Codec, left: str):
        self.codec, self.left = codec, left

    def __missing__(self, right: str) -> bool:
        c, left = self.codec, self.left
        free = left not in c.longest_first or right not in c.longest_first  # the start, or a character of no piece
        self[right] = found = free or c.merged(left + right) == [left, right]
        c.rows.pairs += 1
        return found


class _Rows(dict):
    pairs = 0

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, left: str) -> _Row:
        self[left] = row = _Row(self.codec, left)
        return row


class Codec:
    """Encodes and decodes as the library does, for merge-type models with identity normalisation and byte fallback.

    A token sequence is the merge result of its text if and only if each token is the merge result of its
    own text and each adjacent pair stays apart when the pair's text is merged anew. So the encoder walks
    the text with the longest vocabulary match at each position (found by one Aho-Corasick pass), checks the
    match against the previous token by re-merging the two, tries shorter matches when that fails, and steps back
    when none is left; a bitfield marks positions from which no valid rest exists, so none is tried twice.

    Two things bound the text that is walked at once. No piece has a space after another character,
    so text can be cut before runs of spaces; characters in no piece become bytes and never merge. Pieces made of spaces
    alone share one score, below all others: their merges come last and leftmost first, so runs of spaces are merged directly.
    """

    def __init__(self, model: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {self.names[i]: i for i in normal}
        self.score = {self.names[i]: sp.get_score(i) for i in normal}
        self.byte = {int(self.names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        inner = [p for p in self.ids if SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE))]
        if inner:
            raise ValueError(f"pieces with spaces inside are not supported: {inner[:3]}")
        breaks = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+" + (f"|[{breaks}]" if breaks else "")).findall
        self.text = [str(i) for i in range(n)]
        self.raw = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.names)]
        self.shown = [not sp.is_control(i) for i in range(n)]
        self.known: dict[str, list[int]] = {}
        self.recent: dict[str, tuple[int, ...]] = {}
        own = {p for p in self.ids if self.merged(p) == [p]}  # others never come out of merging
        self.longest_first = {p: tuple(p[:k] for k in range(len(p), 0, -1) if p[:k] in own) for p in own}
        self.rows = _Rows(self)
        self.matcher = ahocorasick.Automaton()
        for p in own:
            self.matcher.add_word(p, len(p))
        self.matcher.make_automaton()

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves: the best-scored adjacent pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        nxt, prev = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(-score[p], i, p) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in score]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = nxt[i]
            if not parts[i] or j >= len(parts) or parts[i] + parts[j] != p:
                continue
            parts[i], parts[j] = p, ""
            nxt[i] = k = nxt[j]
            if k < len(parts):
                prev[k] = i
                if (q := p + parts[k]) in score:
                    heapq.heappush(heap, (-score[q], i, q))
            if (h := prev[i]) >= 0 and (q := parts[h] + p) in score:
                heapq.heappush(heap, (-score[q], h, q))
        return [p for p in parts if p]

    def walk(self, text: str) -> list[int]:
        """Ids of a text with no two leading spaces, by backtracking."""
        n, rows, choices = len(text), self.rows, self.longest_first
        if n <= LONG:  # from each position on, as it is met
            first = self.matcher.iter_long
            size_at = lambda at: size if (found := next(first(text, at), None)) and found[0] + 1 - (size := found[1]) == at else 0
        else:  # of all positions by one pass of the automaton
            longest = array("H", bytes(2 * n))
            for end, size in self.matcher.iter(text):
                if size > longest[end + 1 - size]:
                    longest[end + 1 - size] = size
            size_at = longest.__getitem__
        failed: bytearray | None = None  # bit i: no valid encoding goes through position i
        path: list[str] = []
        untried: list = []  # of each step, an iterator over the shorter matches
        at, left, matches = 0, "", None
        if rows.pairs >= MEMORY:
            rows.clear()
            rows.pairs = 0
        while at < n:
            if matches is None:
                size = size_at(at)
                # a character of no piece never merges: it is its own token and always stays apart
                matches = iter(choices[text[at : at + size]] if size else (text[at],))
            row = rows[left]
            for piece in matches:
                if row[piece]:
                    end = at + len(piece)
                    if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                        path.append(piece)
                        untried.append(matches)
                        at, left, matches = end, piece, None
                        break
            else:
                if not path:
                    raise ValueError("no merge-type encoding")  # merging ends for any text, so there is one
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(path.pop())
                left, matches = path[-1] if path else "", untried.pop()
        out: list[int] = []
        for p in path:
            if (i := self.ids.get(p)) is not None:
                out.append(i)
            elif self.byte:
                out.extend(self.byte[b] for b in p.encode())
            else:
                out.append(self.unknown)
        return out

    @lru_cache(maxsize=1024)  # noqa: B019
    def spaces(self, n: int) -> list[int]:
        return [self.ids[p] for p in self.merged(SPACE * n)]

    def chunk(self, text: str) -> list[int]:
        word = text.lstrip(SPACE)
        lead = len(text) - len(word)
        if not word:
            return self.spaces(lead)
        if lead < 2:
            return self.walk(text)
        rest = self.walk(SPACE + word)
        if self.names[rest[0]] == SPACE:
            return [*self.spaces(lead), *rest[1:]]
        return [*self.spaces(lead - 1), *rest]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for c in self.chunks(SPACE + text.replace(" ", SPACE)):
            ids = known.get(c)
            if ids is None:
                ids = self.recent.get(c)
                if ids is None:
                    ids = tuple(self.chunk(c))
                if len(c) <= LONG:
                    if len(known) >= MEMORY:  # the older half goes; what is met again moves to the newer
                        self.recent = known
                        self.known = known = {}
                    known[c] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "docloom.bytewise")
        first = next((i for i in ids if self.shown[i]), None)
        return text[1:] if first is not None and self.names[first].startswith(SPACE) else text

    def joined(self, ids: list[int]) -> str:
        text = self.text
        return ",".join([text[i] for i in ids])


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    return Codec(model)


def encoded(docs: DataFrame, model: str, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """``docs`` and a column of token ids, without begin and end ids; a null text counts as empty and has no ids.

    ``out_col`` replaces a column of that name. Rows stay as they are, repeated ones included.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.drop(out_col)
    schema = extended(base, f"`{out_col}` array<int>")
    arrow = to_arrow_schema(schema)

    def run(batches):
        c = codec(model)
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            for a, b in slices(texts):
                ids = pa.array([c.encode(t or "") for t in texts[a:b]], pa.list_(pa.int32()))
                yield replaced(batch.slice(a, b - a), {out_col: ids.cast(arrow.field(out_col).type)}, arrow)

    return base.mapInArrow(run, schema)


def decoded(tokens: DataFrame, model: str, tokens_col: str = "tokens", out_col: str = "decoded") -> DataFrame:
    """``tokens`` and a column of the text that its ids stand for; null ids give null."""
    from pyspark.sql.pandas.types import to_arrow_schema

    base = tokens.drop(out_col)
    schema = extended(base, f"`{out_col}` string")
    arrow = to_arrow_schema(schema)

    def run(batches):
        c = codec(model)
        for batch in batches:
            ids = batch.column(batch.schema.names.index(tokens_col)).to_pylist()
            yield replaced(batch, {out_col: pa.array([None if x is None else c.decode(x) for x in ids], pa.string())}, arrow)

    return base.mapInArrow(run, schema)


def tokenized(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """``docs`` with tokens, n_tokens and round_trip, whether the ids decode to the text (a null text: to an empty one), in one pass."""
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.drop("tokens", "n_tokens", "round_trip")
    schema = extended(base, "tokens array<int>, n_tokens long, round_trip boolean")
    arrow = to_arrow_schema(schema)

    def run(batches):
        c = codec(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index(text_col)).to_pylist()]
            for a, b in slices(texts):
                ids = [c.encode(t) for t in texts[a:b]]
                same = [c.decode(i) == t.replace(SPACE, " ") for i, t in zip(ids, texts[a:b], strict=True)]
                columns = {"tokens": pa.array(ids, pa.list_(pa.int32())).cast(arrow.field("tokens").type), "n_tokens": pa.array([len(i) for i in ids], pa.int64()), "round_trip": pa.array(same)}
                yield replaced(batch.slice(a, b - a), columns, arrow)
        c.known, c.recent = {}, {}  # other stages run in the same worker
        spared()

    return base.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to: one pass, nothing kept of a text but its digests.

    A null text counts as empty; null ids and repeated rows stay. Long texts are encoded whole, in time linear in their length also where a word is long; a worker
    holds one at once. Other columns are not read. An empty table gives no rows.
    """

    def run(batches):
        c = codec(model)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            n, ids_hex, text_hex = [], [], []
            for text in texts:
                ids = c.encode(text or "")
                n.append(len(ids))
                ids_hex.append(hashlib.sha256(c.joined(ids).encode()).hexdigest())
                text_hex.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(text_hex)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return round_trip(table(spark, sf_dir, "documents"), model_path())
