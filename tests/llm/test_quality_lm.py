import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import ODD

from docloom.llm import quality_lm as q


class Plain:
    """The same model with dicts."""

    def __init__(self, texts, order=q.ORDER):
        self.order, c = order, Counter()
        for t in texts:
            for i in range(len(t) - order + 1):
                c[t[i : i + order]] += 1
        self.c = {order: c}
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d = {k: q.discounts([sum(v == n for v in self.c[k].values()) for n in range(1, 5)]) for k in self.c}
        self.total, self.took = defaultdict(Counter), defaultdict(lambda: defaultdict(float))
        for k, grams in self.c.items():
            for g, n in grams.items():
                self.total[k][g[:-1]] += n
                self.took[k][g[:-1]] += self.d[k][min(n, 3) - 1]

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / (len(self.c[1]) + 1)
        ctx = g[:-1]
        if not self.total[k][ctx]:
            return self.p(g[1:])
        n = self.c[k][g]
        return ((n - self.d[k][min(n, 3) - 1]) if n else 0) / self.total[k][ctx] + self.took[k][ctx] / self.total[k][ctx] * self.p(g[1:])

    def logp(self, t):
        return sum(math.log(self.p(t[max(0, i - self.order + 1) : i + 1])) for i in range(len(t)))


def corpus(words):
    good = [(k, words(30 + k % 40, k) + ".", "en" if k % 2 else "fr") for k in range(80)]
    rng = random.Random(1)
    bad = [(1000 + k, " ".join(w + rng.choice(["***", "%%%", "$$"]) for w in words(40, 2000 + k).upper().split()), "en") for k in range(12)]
    more = [(500 + k, words(40, 700 + k) + ".", "en" if k % 2 else None) for k in range(40)]
    labels = [(i, 1, 0) for i, *_ in good] + [(i, 0, 0) for i, *_ in bad[:4]] + [(1005, 1, 0), (1005, 0, 0), (None, 1, 0), (7, 1, 1)]
    return good, bad, more, labels


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def held(model):
    packed, of = q.shards(model)
    return [q.Shard(q._unpacked(r["payload"]), r["shard"], of) for r in packed.collect()]


def test_probabilities_are_those_of_the_plain_model(make, words):
    good, bad, more, _ = corpus(words)
    plain = Plain([t for _, t, _ in good])
    model = q.estimate(make(good))
    texts = [t for _, t, _ in more[:10] + bad[:3] + good[:3]] + ["", "q", "zz", "é😀 unseen"]
    want = [plain.logp(t) for t in texts]
    assert sum(s.score(texts) for s in held(model)) == pytest.approx(want, rel=1e-4, abs=1e-4)
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r["logp"] for r in q.scored(make(rows), model).collect()}
    assert [got[k] for k, _ in rows] == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_probabilities_sum_to_one(words):
    plain = Plain([words(60, k) for k in range(5)])
    letters = list(plain.c[1])
    for ctx in ("", "a", "ab", "e th", "zzzz"):
        assert sum(plain.p(ctx[-4:] + c) for c in letters) + plain.p(ctx[-4:] + "😀") == pytest.approx(1, abs=1e-9)


def test_shards_add_up(make, words, monkeypatch):
    good, bad, more, _ = corpus(words)
    docs = make(more + bad + ODD)
    model = q.estimate(make(good))
    order = lambda df: sorted((str(r["doc_id"]), r["chars"], round(r["logp"], 3)) for r in df.collect())
    whole = order(q.scored(docs, model))
    monkeypatch.setattr(q, "SHARD_ROWS", 1000)
    assert q.shards(model)[1] > 3
    monkeypatch.setattr(q, "GRAMS_A_COPY", 0.3)
    assert order(q.scored(docs, model)) == whole and len(whole) == len(more + bad + ODD)


def test_long_texts_are_scored_in_parts(make, words, monkeypatch):
    good, _, more, _ = corpus(words)
    model = q.estimate(make(good))
    (part,) = held(model)
    texts = [t for _, t, _ in more[:6]]
    whole = part.score(texts)
    counted = sorted(map(tuple, q.counts(make(good)).collect()))
    monkeypatch.setattr(q, "PART_CHARS", 37)
    assert part.score(texts) == pytest.approx(whole)
    assert sorted(map(tuple, q.counts(make(good)).collect())) == counted


def test_texts_are_not_shuffled(make, words, spark, monkeypatch):
    plans = []
    plain = q.written
    monkeypatch.setattr(q, "written", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or plain(df, name))
    good, _, more, _ = corpus(words)
    q.scored(make(more), q.estimate(make(good)))
    (plan,) = [p for n, p in plans if n == "lm-scores"]
    assert "Bucketed: true" in plan and "ShuffledHashJoin" in plan


def test_no_stage_of_a_model_has_many_times_the_shuffle_partitions(make, words, spark):
    good, _, _, _ = corpus(words)
    context, conf = spark.sparkContext, {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        context.setJobGroup("lm-stages", "")
        q.estimate(make(good))
        tracker = context.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("lm-stages") for s in tracker.getJobInfo(j).stageIds]
        tasks = [s.numTasks for s in stages if s]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 16 <= max(tasks) <= 32  # one plan of all joins and sums: 88


def test_windows_are_the_texts_last_characters():
    texts = ["", "ab", "abcabcabc", "é😀\0x"]
    want = set()
    for t in texts:
        for i in range(len(t)):
            w = [ord(c) + 1 for c in t[max(0, i - 4) : i + 1]]
            want.add((*[0] * (5 - len(w)), *w))
    assert {tuple(w) for w in q.grams(texts)[1].tolist()} == want and len(q.grams(texts)[0]) == len(want)
    assert (np.diff(q.grams(texts, 3)[2]) >= 0).all() and q.grams([])[1].shape == (0, 5)


def test_limits_are_the_plain_quantiles(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["en", "fr", "de", None]), rng.random() < 0.6, rng.gauss(3, 0.2)) for _ in range(3000)] + [("xx", False, 2.0), ("yy", True, 2.5)]
    limits, overall = q.quantiles(spark.createDataFrame(rows, "lang string, judge boolean, score double"))

    def spread(xs):
        return sum(x * x for x in xs) - sum(xs) ** 2 / len(xs) if xs else 0.0

    steps = [(g, j, math.ceil(x / q.STEP)) for g, j, x in rows]
    groups = {g: [[x for h, j, x in steps if h == g and j is k] for k in (True, False)] for g in ("en", "fr", "de", "xx", "yy")}
    pooled = sum(spread(a) + spread(b) for a, b in groups.values()) / sum(len(a) + len(b) for a, b in groups.values())

    def limit(judges):
        n = len(judges)
        at = sorted(judges)[max(0, math.ceil(n * q.QUANTILE - 1e-9) - 1)]
        return (at + (max(0, -math.log((1 - q.QUANTILE) * n)) + q.ERRORS / math.sqrt(n)) * math.sqrt(max(spread(judges) / n, pooled))) * q.STEP

    got = {r["lang"]: r["own"] for r in limits.collect()}
    assert got == pytest.approx({g: limit(a) for g, (a, _) in groups.items() if a}) and overall == pytest.approx(limit([x for _, j, x in steps if j]))


def test_junk_goes_and_clean_texts_stay(make, labels, words):
    good, bad, more, marks = corpus(words)
    docs = make(good + bad + more + ODD, extra=True)
    kept = q.filtered(docs, labels(marks)).collect()
    ids = {r["doc_id"] for r in kept}
    assert {i for i, *_ in good + more} <= ids and not ids & {i for i, *_ in bad}
    assert {1, 2, 3, None} <= ids and kept[0]["keep"] == 7
    assert sum(r["text"] == "word" for r in kept) == 2


def test_repeated_words_go(make, labels, words):
    good, _, more, marks = corpus(words)
    rng = random.Random(3)
    runs = [(2000 + k, " ".join(w for w in rng.sample(good[k][1].strip(".").split(), 8) for _ in range(9)) + ".", "en" if k % 2 else "fr") for k in range(20)]
    lines = [(3000 + k, "\n".join([words(5, 900 + k) + "."] * 12), "en") for k in range(5)]
    ids = {r["doc_id"] for r in q.filtered(make(good + more + runs + lines), labels(marks)).collect()}
    assert {i for i, *_ in good + more} <= ids and not ids & {i for i, *_ in runs + lines}


def test_rhythms():
    assert q.rhythm("a b A a c\tb " + "x y " * 2) == "KKBAKDKKBB"
    assert q.rhythm(None) == q.rhythm(" \n") == ""
    assert q.rhythm(" ".join(map(str, [0, *range(64), 0]))) == "KA" + "K" * 63 + "J"


def test_join_instead_of_broadcast(make, labels, words, monkeypatch):
    good, bad, more, marks = corpus(words)
    monkeypatch.setattr(q, "BROADCAST_IDS", 0)
    ids = {r["doc_id"] for r in q.filtered(make(good + bad + more), labels(marks)).collect()}
    assert {i for i, *_ in good + more} <= ids and not ids & {i for i, *_ in bad}


def test_without_labels_or_rows(make, labels):
    assert q.filtered(make(ODD), labels([])).count() == len(ODD)
    assert q.classified(make([]), labels([(1, 1, 0)])).collect() == []


def test_rhythm_of_a_long_text_is_that_of_its_words(monkeypatch, words):
    text = words(3000, 3) + " same" * 500 + "\u2028Same  " + words(200, 3)
    whole = q.rhythm(text)
    monkeypatch.setattr(q, "PART_CHARS", 37)
    assert q.rhythm(text) == whole and len(whole) == len(text.split())


def test_a_row_goes_by_its_id_and_text(make, labels, words):
    """Of rows that repeat an id those with a junk text go; junk without an id goes too."""
    good, bad, _, marks = corpus(words)
    junk = bad[0][1]
    rows = [(5000, good[0][1]), (5000, junk), (None, good[1][1]), (None, junk)]
    kept = q.filtered(make(good + bad + rows), labels(marks)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept if r["doc_id"] in (5000, None)) == sorted([(5000, good[0][1]), (0, good[1][1])])
    assert {i for i, *_ in good} <= {r["doc_id"] for r in kept}
