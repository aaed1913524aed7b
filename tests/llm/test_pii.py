import hashlib
import math
import random
import re
import time

from conftest_llm import ODD
from pyspark.sql import functions as F

from docloom.llm import pii

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return [(PLAIN[k][0], a, b) for a, k, b in sorted(out)]


def odd_texts(n):
    rng = random.Random(1)
    bits = ["a", "b.c", "@", "x@y.zz", ".", "..", "1", "12", "255", "256", "001", " ", "-", "+", "+1 (743) 555-3824", "4111 1111 1111 1111", "4111-1111", "10.0.0.1", "😀", "é", "\n", "(", ")", "_%", "0" * 13, "a@b.c_d@e.f"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def spans(df):
    return {(r["doc_id"], r["text"]): [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in df.collect()}


def test_fixed_kinds_are_those_of_the_plain_patterns(make):
    rows = list(enumerate(odd_texts(1500), 100)) + ODD + [(9000, "9" * 20000), (9001, "a" * 30000), (9002, "1 2" * 8000), (9003, "x@y.z " * 500), (9004, "1." * 9000)]
    got = spans(pii.found(make(rows, extra=True)))
    for i, t in rows:
        assert [s for s in got[i, t] if s[0] != pii.TERM] == brute(t), (i, (t or "")[:80])


def leaking(words):
    """Different texts in which a rare name stands by one address, and other texts."""
    rows = [(k, f"{words(12, 50 + k)} contact zebulonia at zeb@corp.example.com or {words(9, 90 + k)}") for k in range(6)]
    rows += [(100 + k, f"{words(40, 300 + k)} mail me{k}@other.example.com {words(20, 600 + k)}") for k in range(40)]
    return rows + [(200 + k, words(60, 900 + k)) for k in range(40)]


def test_terms_that_reveal_an_entity_are_found_and_replaced(make, words):
    rows = leaking(words)
    got = spans(pii.found(make(rows)))
    for i, t in rows:
        terms = [t[a:b] for kind, a, b in got[i, t] if kind == pii.TERM]
        assert ("zebulonia" in terms) == (i < 6)
        assert not terms or i < 6
    clean = {r["doc_id"]: r["text"] for r in pii.sanitized(make(rows)).collect()}
    assert all("zebulonia" not in clean[k] and "zeb@" not in clean[k] and "[EMAIL]" in clean[k] for k in range(6))
    assert all(clean[200 + k] == words(60, 900 + k) for k in range(40))


def told(docs):
    rows = docs.select(F.xxhash64("text").alias("row"), "text", pii.base_spans(F.col("text")).alias("found")).filter("size(found) > 0")
    return {(r["entity"], r["term"]): r["share"] for r in pii.disclosing(docs.select("text"), rows, pii.held(rows)).collect()}


def test_share_is_the_plain_estimate(make, words):
    rows = leaking(words) + [(300, "zebulonia alone"), (301, "zebulonia again")]
    assert told(make(rows))["0:zeb@corp.example.com", "zebulonia"] == 6 / 8


def test_repeated_mentions_in_one_text_and_copies_are_no_evidence(make, words):
    one = " ".join(f"zebra at z@w.example {words(12, k)}" for k in range(3))
    rest = [(10 + k, f"zebra {words(20, 40 + k)}") for k in range(3)] + [(50 + k, words(30, 400 + k)) for k in range(40)]
    assert not [k for k in told(make([(1, one), *rest])) if k[1] == "zebra"]
    assert told(make([(k, one) for k in range(9)] + rest[3:])) == {}


def brute_terms(texts):
    """Share of each (entity, term) that discloses, straight from the definition."""
    held, words_ = [], []
    for t in texts:
        spans_ = brute(t)
        held.append({f"{[k for k, _ in PLAIN].index(kind)}:" + (t[a:b].lower() if kind == "email" else t[a:b] if kind == "ip" else re.sub("[^0-9]", "", t[a:b])) for kind, a, b in spans_})
        words_.append({w.lower() for w in re.findall(r"[^\W\d_]{3,}", t)})
    out = {}
    for e in set().union(*held):
        have = [k for k in range(len(texts)) if e in held[k]]
        for term in set().union(*[words_[k] for k in have]):
            both = [k for k in have if term in words_[k]]
            share = len(both) / sum(term in w for w in words_)
            if len({texts[k] for k in both}) > 1 and share >= pii.GENERALISE and math.log2(share * len(texts) / len(have)) >= pii.BITS:
                out[e, term] = share
    return out


def test_terms_are_those_of_the_definition(make):
    rng = random.Random(3)
    vocabulary = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}x" for k in range(60)]
    names = [f"p{k}@q.example" for k in range(8)]
    rows = []
    for k in range(160):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.3:
            i = rng.randrange(8)
            own += [names[i], f"near{'abcdefgh'[i]}", names[rng.randrange(8)]] * rng.randint(1, 2)
        rng.shuffle(own)
        rows.append((k, " ".join(own)))
    rows += [(500 + k, rows[k][1]) for k in range(0, 160, 7)]
    want = brute_terms([t for _, t in rows])
    assert want and told(make(rows)) == want


def test_more_rows_than_are_broadcast(make, words, monkeypatch):
    rows = leaking(words) + ODD
    want = sorted((str(k), v) for k, v in spans(pii.found(make(rows))).items())
    monkeypatch.setattr(pii, "BROADCAST_BYTES", 0)
    assert sorted((str(k), v) for k, v in spans(pii.found(make(rows))).items()) == want


def test_many_matches_take_linear_time(make):
    def seconds(n):
        text = " ".join(f"user{k}@host{k % 7}.example and more words" for k in range(n))
        docs = make([(1, text)], parts=1)
        start = time.perf_counter()
        out = pii.sanitized(docs).collect()[0]["text"]
        assert out == " ".join(["[EMAIL] and more words"] * n)
        return time.perf_counter() - start

    seconds(100)
    short, long = min(seconds(2000) for _ in range(2)), min(seconds(8000) for _ in range(2))
    assert long < 4 * short + 2


def test_clashing_names_stay(make):
    docs = make([(1, "x a@b.cc")]).withColumns({c: F.lit(c) for c in ("found", "row", "terms", "r", "all", "__found")})
    out = pii.found(docs).collect()[0]
    assert [out[c] for c in ("found", "row", "terms", "r", "all", "__found")] == ["found", "row", "terms", "r", "all", "__found"] and len(out["spans"]) == 1


def test_replacement_keeps_the_rest(make):
    text = "é😀 a@b.cc, 4111 1111 1111 1111 and +4111111111111111; 10.0.0.1!"
    out = pii.sanitized(make([(1, text), (2, None), (3, "nothing")], extra=True)).orderBy("doc_id").collect()
    assert out[0]["text"] == "é😀 [EMAIL], [CARD] and [PHONE]; [IP]!" or out[0]["text"] == "é😀 [EMAIL], [CARD] and +[CARD]; [IP]!"
    assert out[1]["text"] is None and out[2]["text"] == "nothing" and out[2]["fp"] == 7


def test_query_columns(spark, tmp_path, make):
    make([(1, "x a@b.cc"), (2, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    r = {r["doc_id"]: r for r in pii.op7_pii(spark, str(tmp_path)).collect()}
    assert r[1]["spans"] == "email:2:8" and r[1]["n_email"] == 1 and r[1]["base_sha256"] == hashlib.sha256(b"email:2:8").hexdigest()
    assert r[2]["spans"] == "" and r[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table(make):
    assert pii.found(make([])).collect() == []


def test_no_python_runs_in_the_plan(make):
    plan = pii.sanitized(make([(1, "a@b.cc")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
