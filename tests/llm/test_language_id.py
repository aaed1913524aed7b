import math
import random
import zlib
from collections import Counter

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from docloom.llm import language_id as m


def texts(n, seed):
    rng = random.Random(seed)
    parts = {"aa": ["tion", "the", "ing", "wh", "er"], "bb": ["ção", "lhe", "nho", "que", "ão"], "cc": ["sch", "ung", "ä", "keit", "tz"]}
    return [(k, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 40))), lang) for k in range(n) for lang in [rng.choice(list(parts))]]


def test_held_out_rows_are_identified(make):
    rows = texts(400, 1)
    docs = make(rows, extra=True)
    model = m.train(docs.filter(~m.held_out()))
    got = m.identified(docs.withColumn("held", m.held_out()), model).collect()
    held = [r for r in got if r["held"]]
    assert {r["doc_id"] for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_counts_are_those_of_one_pass(make):
    rows = texts(60, 2) + [(900, None, "aa"), (901, "text", None), (902, "", "aa")]
    (model,) = m.train(make(rows))
    import numpy as np

    for k, lang in enumerate(model.languages):
        mine = [t for _, t, x in rows if x == lang and t is not None]
        grams, _ = m.buckets(mine)
        counts = sum(np.bincount(g, minlength=m.BUCKETS) for g in grams) + 0.5
        assert np.allclose(model.table[:, k], np.log(counts / counts.sum()), atol=1e-5)


def brute(rows, texts_):
    """Naive Bayes straight from its definition, with dicts over the same buckets."""
    bucket = lambda t: [int(b) for g in m.buckets([t.lower()])[0] for b in g]
    counts, n = {}, Counter(lang for _, t, lang in rows if t is not None)
    for _, t, lang in rows:
        if t is not None:
            counts.setdefault(lang, Counter()).update(bucket(t) if t else [])
    out = []
    for t in texts_:
        if t is None or not any(c.isalpha() for c in t):
            out.append(("und", 0.0))
            continue
        logs = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + 0.5 * m.BUCKETS
            logs[lang] = math.log(n[lang] / sum(n.values())) + sum(math.log((counts[lang][b] + 0.5) / total) for b in bucket(t))
        best = max(sorted(logs), key=lambda k: logs[k])
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def test_predictions_are_those_of_the_definition(make):
    rows = texts(50, 7)
    some = [t for _, t, _ in texts(30, 8)] + ["", None, "x", "Schu\nng THE", "12", "ab" * 3]
    want = brute(rows, some)
    for got in (list(zip(*list(m.train(make(rows)))[0].predict(some), strict=True)),):
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-3)


def test_more_languages_than_a_block(make, monkeypatch):
    rows = [(k, t, f"{lang}{k % 3}") for k, t, lang in texts(120, 9)]
    some = [(k, t) for k, (_, t, _) in enumerate(texts(25, 10))] + ODD
    (whole,) = m.train(make(rows))
    want = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in m.identified(make(some), whole).collect()}
    monkeypatch.setattr(m, "MOST_LANGUAGES", 4)
    blocks = list(m.train(make(rows)))
    assert [len(b.languages) for b in blocks] == [4, 4, 1]
    for r in m.identified(make(some, extra=True), iter(blocks)).collect():
        assert r["lang_pred"] == want[r["doc_id"], r["text"]][0] and r["score"] == pytest.approx(want[r["doc_id"], r["text"]][1], rel=1e-6)
        assert r["keep"] == 7


def test_long_texts_go_in_parts(make, monkeypatch):
    (model,) = m.train(make(texts(60, 11)))
    some = [t * 9 for _, t, _ in texts(10, 12)] + ["İ" * 50 + "the"]
    whole = model.predict(some)
    monkeypatch.setattr(m, "PART_CHARS", 13)
    parts = model.predict(some)
    assert parts[0] == whole[0] and parts[1] == pytest.approx(whole[1], rel=1e-6)


def test_a_text_scores_alike_in_any_batch(make):
    (model,) = m.train(make(texts(60, 3)))
    some = [t for _, t, _ in texts(20, 4)] + ["", None, "x"]
    alone = [tuple(v[0] for v in model.predict([t])) for t in some]
    together = list(zip(*model.predict(some), strict=True))
    assert [a[0] for a in alone] == [b[0] for b in together]
    assert [a[1] for a in alone] == pytest.approx([b[1] for b in together])
    for grams, starts in [m.buckets(["ab", "", "xyz"])]:
        assert starts.tolist() == [0, 2, 2] and all(len(g) == 5 for g in grams)
        assert [g[2:].tolist() for g in grams] == [g.tolist() for g in m.buckets(["xyz"])[0]]


def test_odd_rows(make, monkeypatch):
    monkeypatch.setattr(m, "OPEN_LANGUAGES", 1)
    (model,) = m.train(make(texts(60, 5)))
    got = m.identified(make(ODD + [(50, "123 ... !!")]), model).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        has = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not has)


def test_nothing_to_learn_from(make):
    (model,) = m.train(make([]))
    assert [tuple(r) for r in m.identified(make([(1, "abc")]), model).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert m.identified(make([]), model).collect() == []
    (model,) = m.train(make([(1, "abc", "aa")]).withColumn("lang", F.lit(None).cast("string")))
    assert model.languages == []
