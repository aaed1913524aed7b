import random

import numpy as np
from conftest_llm import ODD

from docloom.llm import decontamination as d


def brute(docs, items):
    out = []
    for i, t in docs:
        own = d.shingles(t)
        for k, text in dict.fromkeys(items):
            s = d.shingles(text)
            if s and len(s & own) >= d.CONTAINMENT * len(s):
                out.append((i if i is not None else -1, k, len(s & own), len(s)))
    return sorted(out)


def world(words):
    rng = random.Random(3)
    items = [(k, words(rng.randint(5, 70), 100 + k).capitalize() + ".") for k in range(60)] + [(70, "too short"), (71, ""), (72, None), (73, "word"), (74, words(900, 5)), (3, words(20, 103))]
    docs = []
    for k in range(240):
        text = words(rng.randint(0, 400), 1000 + k).split()
        if k % 3 == 0:
            item = rng.choice(items[:60])[1].split()
            if k % 2:
                item[rng.randrange(len(item))] = "edited"
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() for w in item] if k % 4 == 0 else item
        docs.append((k, " ".join(text)))
    docs.append((500, words(300, 1) + " " + words(900, 5) + " " + words(20000, 2)))
    docs.append((501, " ".join([words(3000, 8), *items[0][1].split()[:40], words(5000, 9)])))
    return docs + ODD + [(900, "too short"), (901, "Too, SHORT!")], items


def table(spark, items):
    return spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int").repartition(2)


def test_leaks_are_those_of_all_pairs(spark, make, words):
    docs, items = world(words)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["item_id"], r["shared"], r["shingles"]) for r in d.leaks(make(docs, extra=True), table(spark, items)).collect())
    want = brute(docs, [(k, t) for k, t in items])
    assert got == want and len(want) > 60


def test_a_benchmark_of_many_blocks(spark, make, words, monkeypatch):
    docs, items = world(words)
    monkeypatch.setattr(d, "BLOCK_BYTES", 4000)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["item_id"], r["shared"], r["shingles"]) for r in d.leaks(make(docs), table(spark, items)).collect())
    assert got == brute(docs, items)
    kept = d.decontaminated(make(docs, extra=True), table(spark, items)).collect()
    clean = [(i, t) for i, t in docs if not brute([(i, t)], items)]
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept) == sorted((str(i), str(t)) for i, t in clean)


def test_batch_hashes_agree_with_the_shingles(words):
    texts = [t for _, t in ODD] + [words(n, n) for n in (1, 4, 5, 6, 200)] + ["A-b c'd E.F 9 é"]
    hashes, begin = d.hashed(texts)
    seen = {}
    for k, t in enumerate(texts):
        own = hashes[begin[k] : begin[k + 1]]
        assert len(set(own.tolist())) == len(d.shingles(t))
        for s, h in zip([" ".join(w) for w in _runs(t)], own.tolist(), strict=True):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def _runs(t):
    w = [x for x in d.words(t) if x]
    return [w[i : i + d.WORDS] for i in range(max(1, len(w) - d.WORDS + 1))] if w else []


def test_signatures_find_copies_at_the_threshold():
    rng = random.Random(4)
    missed = tried = 0
    for k in range(150):
        item = [f"w{rng.randrange(10**9)}" for _ in range(rng.randint(15, 60))]
        items = d.Items([(0, " ".join(item))])
        doc = [f"x{rng.randrange(10**9)}" for _ in range(3000)]
        copy = list(item)
        copy[rng.choice([0, len(copy) - 1])] = "edge"
        at = rng.randrange(len(doc))
        text = " ".join(doc[:at] + copy + doc[at:])
        if len(d.shingles(" ".join(item)) & d.shingles(text)) >= d.CONTAINMENT * len(items.sets[0]):
            tried += 1
            missed += not items.candidates(*d.hashed([text]))
    assert tried > 100 and missed == 0


def test_no_copy_of_a_small_item_is_missed():
    rng = random.Random(6)
    new = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    items = [" ".join(new(5 + k % 3)) for k in range(6000)] + ["one two one two one two one two"]
    whole = d.Items(list(enumerate(items)))
    texts = [" ".join(x for item in items[a : a + 100] for x in [*new(30), item.upper(), *new(30)]) for a in range(0, len(items), 100)]
    got = {(t, k) for t, k, _ in whole.contained(["", None, *texts])}
    assert got == {(2 + k // 100, k) for k in range(len(items))}
    near = " ".join([*new(50), *items[0].split()[:4], "other", *new(50)])
    assert not list(whole.contained([near]))


def test_empty_tables(spark, make):
    none = table(spark, [])
    assert d.leaks(make([(1, "a b c d e f")]), none).collect() == []
    assert d.leaks(make([]), table(spark, [(1, "a b c d e f")])).collect() == []
    assert d.decontaminated(make([(1, "x")]), none).count() == 1
    assert np.array_equal(d.hashed([])[1], [0])


def test_long_texts_are_searched_in_parts(words, monkeypatch):
    docs, items = world(words)
    made = d.Items([(k, t) for k, t in items if t])
    texts = [t for _, t in docs] + ["x" * 999 + " " + t for _, t in docs[:40]] + [(docs[0][1] + " ") * 30]
    whole = sorted(made.contained(texts))
    hashes = d.hashed(texts)
    monkeypatch.setattr(d, "PART_BYTES", 200)
    monkeypatch.setattr(d, "PART_SHINGLES", 50)
    assert all((a == b).all() for a, b in zip(d.hashed(texts), hashes, strict=True))
    assert sorted(made.contained(texts)) == whole and len(whole) > 60
