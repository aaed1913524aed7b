"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extended, replaced, slices, table, written

#: Hash buckets of the n-grams, and the lengths that are hashed.
BUCKETS = 1 << 16
LENGTHS = (1, 2, 3)
#: Languages whose log probabilities are broadcast at once: 4 bytes x BUCKETS each, so 64 MB. With more, texts meet one such block after the other.
MOST_LANGUAGES = 256
#: Characters that are hashed at once; longer texts are cut, and each part reaches into the next as far as n-grams do.
PART_CHARS = 1 << 19
#: Languages that a training task counts before it hands its counts on.
OPEN_LANGUAGES = 32
UNDETERMINED = "und"


def buckets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram length, the bucket of the n-gram that starts at each character; and where each text starts.

    Texts are lower-cased before, and n-grams at the end reach into spaces, so a text's n-grams depend on it alone.
    """
    ahead = max(LENGTHS) - 1
    low = texts
    sizes = np.array([len(t) for t in low], np.int64)
    code = np.frombuffer((" " * ahead).join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.cumsum(sizes) - sizes
    inside = np.arange(sizes.sum()) + np.repeat(ahead * np.arange(len(low)), sizes)
    out, h = [], np.zeros(len(inside), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(max(LENGTHS)):
            h = (h ^ code[inside + k]) * np.uint32(0x9E3779B1) + np.uint32(k + 1)
            if k + 1 in LENGTHS:
                g = h ^ (h >> np.uint32(15))
                out.append(((g * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.int64) % BUCKETS)
    return out, starts


def letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def parts_of(texts: list[str]):
    """(owners, lower-cased parts, characters of each part that start n-grams), in slices of about ``PART_CHARS``."""
    ahead = max(LENGTHS) - 1
    cut = []
    for i, t in enumerate(texts):
        low = t.lower()
        for a in range(0, len(low), PART_CHARS):
            part = low[a : a + PART_CHARS + ahead]
            cut.append((i, part, min(PART_CHARS, len(low) - a)))
    for a, b in slices([p for _, p, _ in cut], PART_CHARS):
        yield [i for i, _, _ in cut[a:b]], [p for _, p, _ in cut[a:b]], np.array([n for _, _, n in cut[a:b]], np.int64)


def sparse(texts: list[str]):
    """(owners, buckets, counts) of the texts' distinct n-gram buckets, slice by slice; the counts of a text that was cut add up."""
    for owners, parts, own in parts_of(texts):
        grams, starts = buckets(parts)
        sizes = np.diff(np.append(starts, len(grams[0])))
        place = np.arange(len(grams[0])) - np.repeat(starts, sizes)
        inside = place < np.repeat(own, sizes)
        row = np.repeat(np.arange(len(parts)), sizes)[inside]
        key, n = np.unique(np.concatenate([row * BUCKETS + g[inside] for g in grams]), return_counts=True)
        yield np.array(owners)[key // BUCKETS], key % BUCKETS, n


class Model:
    """languages, and their (BUCKETS, languages) log probabilities and log priors: of all languages, or of a block of them."""

    def __init__(self, languages: list[str], counts: np.ndarray, rows: np.ndarray, total: int | None = None, smoothing: float = 0.5):
        self.languages = languages
        counts = counts + smoothing
        self.table = np.ascontiguousarray(np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32).T) if len(languages) else counts
        self.prior = np.log(np.maximum(rows, 1) / max(1, rows.sum() if total is None else total)) if len(languages) else rows

    def totals(self, texts: list[str]) -> np.ndarray:
        """(texts, languages) log probabilities: sparse counts times the matrix, some languages at once."""
        out = np.repeat(self.prior[None, :], len(texts), axis=0).astype(np.float64)
        for owner, bucket, n in sparse(texts):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            for a in range(0, len(self.languages), 16):
                each = self.table[bucket, a : a + 16] * n[:, None].astype(np.float64)
                np.add.at(out[:, a : a + 16], owner[first], np.add.reduceat(each, first, axis=0))
        return out

    def judged(self, texts: list[str | None], before: tuple[list, np.ndarray, np.ndarray]) -> tuple[list, np.ndarray, np.ndarray]:
        """(language, its log probability, the log of the sum of all) of each text, after the languages of the blocks before."""
        pred, best, mass = before
        use = [i for i, t in enumerate(texts) if letters(t)]
        if not use or not self.languages:
            return pred, best, mass
        total = self.totals([texts[i] for i in use])
        top = total.argmax(axis=1)
        for i, k, row in zip(use, top.tolist(), total, strict=True):
            if row[k] > best[i]:  # a tie stays with the language before, which is the first by name
                pred[i], best[i] = self.languages[k], row[k]
            mass[i] = np.logaddexp(mass[i], row[k] + np.log(np.exp(row - row[k]).sum()))
        return pred, best, mass

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its posterior probability."""
        return finished(*self.judged(texts, unjudged(len(texts))))


def unjudged(n: int) -> tuple[list, np.ndarray, np.ndarray]:
    return [None] * n, np.full(n, -np.inf), np.full(n, -np.inf)


def finished(pred: list, best: np.ndarray, mass: np.ndarray) -> tuple[list[str], list[float]]:
    score = [min(1.0, float(np.exp(b - m))) if p is not None else 0.0 for p, b, m in zip(pred, best, mass, strict=True)]
    return [UNDETERMINED if p is None else p for p in pred], score


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, b, n): each language's counts by bucket, those of its rows as bucket -1. Summed in each task, then by (language, bucket)."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def flush():
            for lang, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at - 1, pa.int64()), pa.array(c[at])], names=["lang", "bucket", "n"])

        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                mine = [t for t, own in zip(texts, langs, strict=True) if own == lang]
                c = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                c[0] += len(mine)  # position 0: rows, given out as bucket -1
                for _, parts, own in parts_of(mine):
                    grams, starts = buckets(parts)
                    sizes = np.diff(np.append(starts, len(grams[0])))
                    inside = np.arange(len(grams[0])) - np.repeat(starts, sizes) < np.repeat(own, sizes)
                    for g in grams:
                        c[1:] += np.bincount(g[inside], minlength=BUCKETS)
                if len(counts) > OPEN_LANGUAGES:
                    yield from flush()
                    counts.clear()
        yield from flush()

    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    summed = known.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("c"))  # at most BUCKETS + 1 a language
    return written(packed.select("lang", F.col("c.bucket").alias("b"), F.col("c.n").alias("n")), "language-counts")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Iterator[Model]:
    """The models of blocks of languages, by name, learnt from all rows with a text and a language; one block unless there are over ``MOST_LANGUAGES``.

    The driver holds one block at a time. Without such rows there is one model, which knows no language.
    """
    packed = counted(docs, text_col, lang_col)
    total = packed.select(F.coalesce(F.sum(F.get("n", F.lit(0))), F.lit(0))).first()[0]  # bucket -1 comes first
    last = None
    while True:
        rest = packed if last is None else packed.filter(F.col("lang") > F.lit(last))
        rows = rest.orderBy("lang").limit(MOST_LANGUAGES).toArrow()
        languages = rows.column("lang").to_pylist()
        if not languages and last is not None:
            return
        counts = np.zeros((len(languages), BUCKETS + 1))
        for k in range(len(languages)):
            counts[k, rows.column("b")[k].values.to_numpy() + 1] = rows.column("n")[k].values.to_numpy()
        yield Model(languages, counts[:, 1:], counts[:, 0], total)
        if len(languages) < MOST_LANGUAGES:
            return
        last = languages[-1]


def identified(docs: DataFrame, models: Iterator[Model] | Model, text_col: str = "text") -> DataFrame:
    """``docs`` and lang_pred, score: a learned language, or ``und`` with 0.0 where the text is null or has no letter.

    Languages of equal probability go by name. Rows and other columns stay, repeated rows and null ids too; columns named lang_pred and score are replaced, no other name clashes. Long texts are
    scored whole, part by part. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.drop("lang_pred", "score")
    out = base
    models = [models] if isinstance(models, Model) else models
    taken = {c.lower() for c in base.columns}
    inner = {n: next(x for x in (f"__{n}{'_' * k}" for k in range(len(taken) + 1)) if x not in taken) for n in ("pred", "best", "mass")}
    judged = extended(base, f"{inner['pred']} string, {inner['best']} double, {inner['mass']} double")
    arrow = to_arrow_schema(judged)
    for nth, model in enumerate(models):
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches, shared=shared, nth=nth):
            m = shared.value
            for batch in batches:
                texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
                for a, b in slices(texts):
                    part = batch.slice(a, b - a)
                    before = unjudged(b - a)
                    if nth:
                        names = part.schema.names
                        before = (part.column(names.index(inner["pred"])).to_pylist(), *[part.column(names.index(inner[c])).to_numpy().copy() for c in ("best", "mass")])
                    pred, best, mass = m.judged(texts[a:b], before)
                    yield replaced(part, {inner["pred"]: pa.array(pred, pa.string()), inner["best"]: pa.array(best), inner["mass"]: pa.array(mass)}, arrow)

        out = out.mapInArrow(run, judged)
    pred, best, mass = (F.col(inner[n]) for n in ("pred", "best", "mass"))
    score = F.when(pred.isNotNull(), F.least(F.lit(1.0), F.exp(best - mass))).otherwise(F.lit(0.0))
    return out.select(*[F.col(f"`{c}`") for c in base.columns], F.coalesce(pred, F.lit(UNDETERMINED)).alias("lang_pred"), score.alias("score"))


def held_out(id_col: str = "doc_id") -> Column:
    """One row in five, by the checksum of its id (a null id: of no characters)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = train(docs.filter(~held_out()))
    found = identified(docs.select("doc_id", "text", held_out().alias("held_out")), models)
    return found.select("doc_id", "held_out", "lang_pred", "score")
