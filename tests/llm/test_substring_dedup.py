import random

import pytest
from pyspark.sql import functions as F

from docloom.llm import substring_dedup as sd


def brute(rows, n=sd.WORDS):
    """(doc_id, words, removed, kept text) of each row by comparing all windows."""
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    least = {}
    for i, w in split:
        for a in range(len(w) - n + 1) if i is not None else ():
            g = tuple(w[a : a + n])
            least[g] = min(i, least.get(g, i))
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - n + 1) if i is not None else ():
            if least[tuple(w[a : a + n])] < i:
                gone |= set(range(a, a + n))
        stay = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(w) - len(stay), b" ".join(stay).decode()))
    return sorted(map(repr, out))


def got(df, **how):
    return sorted(repr(tuple(r)) for r in sd.deduplicated(df, **how).select("doc_id", "n_words", "n_removed", "kept").collect())


def corpus(words, n=120):
    """Texts that share whole texts, passages and lines, some below the length."""
    rng = random.Random(4)
    line, passage, short = words(20, 1), words(70, 2), words(12, 3)
    rows = []
    for i in range(n):
        text = words(rng.randrange(5, 160), 100 + i)
        if i % 3 == 0:
            text += f" {line} {words(3, i)}"
        if i % 5 == 1:
            cut = passage.split()
            a = rng.randrange(40)
            text = " ".join(cut[a : a + rng.randrange(10, 30)]) + "\n" + text
        if i % 4 == 1:
            text = f"{text}\t{short}"
        if i % 7 == 0 and rows:
            text = rows[rng.randrange(len(rows))][1]
        if i % 11 == 0 and rows:  # a near copy
            other = rows[rng.randrange(len(rows))][1].split(" ")
            other[rng.randrange(len(other))] = "altered"
            text = " ".join(other)
        rows.append((rng.randrange(10_000), text))
    return rows


@pytest.mark.parametrize("holders", [1, 8, 256])
def test_against_brute_force(spark, make, words, monkeypatch, holders):
    monkeypatch.setattr(sd, "HOLDERS", holders)
    monkeypatch.setattr(sd, "SHARD_WORDS", 300)
    monkeypatch.setattr(sd, "PART_BITS", 3)
    rows = corpus(words)
    assert got(make(rows)) == brute(rows)


def test_other_lengths(spark, make, words):
    rows = corpus(words, 60)
    for n in (3, 5, 30):
        assert got(make(rows), words=n) == brute(rows, n)


def test_odd_rows(spark, make, words):
    t = words(40, 9)
    rows = [(3, t), (3, t), (5, t + " " + t), (None, t), (None, None), (1, None), (2, ""), (4, " \t\n\x0b\x0c\r"), (9, "one"), (7, t.upper()), (8, "a\x1cb " * 30), (6, "Ünï 中文 😀 " * 20), (10, "Ünï 中文 😀 " * 20)]
    assert got(make(rows, extra=True)) == brute(rows)
    assert got(make([])) == []


def test_names_that_are_its_own(spark, make, words):
    rows = corpus(words, 30)
    df = make(rows).withColumns({c: F.lit(1) for c in ("rid", "part", "raw", "anchor", "home", "words", "runs", "k1", "doc", "shard")})
    assert got(df) == brute(rows)


def test_removed_ranges_are_those_of_the_words(spark, make, words):
    rows = corpus(words, 60)
    text = dict(rows)
    for r in sd.deduplicated(make(list(text.items()))).collect():
        w = text[r["doc_id"]].split()
        gone = {j for s in r["removed"] for j in range(s["start"], s["end"])}
        assert r["kept"] == " ".join(x for j, x in enumerate(w) if j not in gone) and len(gone) == r["n_removed"]


def test_very_long_text(spark, make, words):
    """A text of many parts, and one long word."""
    long = words(2000, 5)
    rows = [(1, long), (2, " ".join(words(30_000, k) for k in range(8)) + " " + long), (3, "x" * 3_000_000 + " " + words(20, 7)), (4, words(20, 7))]
    assert got(make(rows)) == brute(rows)


def test_hashes_across_parts(monkeypatch):
    texts = [b"", b"one", b" a b  c\td ", b"z" * 500 + b" " + b"y " * 300, b"last words here"]
    whole, begin = sd.word_hashes(texts)
    monkeypatch.setattr(sd, "PART_BYTES", 64)
    again, cut = sd.word_hashes(texts)
    assert whole.tolist() == again.tolist() and begin.tolist() == cut.tolist() == [0, 0, 1, 5, 306, 309]


def test_automaton_against_plain_search():
    rng = random.Random(8)
    texts = [([rng.choice("abc") for _ in range(rng.randrange(1, 60))], rng.randrange(100)) for _ in range(40)]
    automaton = sd.Automaton(texts)
    for n in (1, 4, 9):
        for text in [t for t, _ in texts] + [[rng.choice("abcd") for _ in range(50)] for _ in range(20)]:
            want = [min((d for t, d in texts if any(t[j : j + n] == text[i : i + n] for j in range(len(t) - n + 1))), default=None) for i in range(len(text) - n + 1)]
            assert automaton.earliest(text, n) == want
