import random
import re

import numpy as np
import xxhash
from conftest_llm import ODD

from docloom.llm import common
from docloom.llm import simhash as s


def brute_fp(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    if not sh:
        return 0
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(nodes, distance=4):
    """nodes: (id, fingerprint); the least id of each row's component."""
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(nodes)):
        for j in range(i):
            if (nodes[i][1] ^ nodes[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(nodes):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(nodes))]


def test_fingerprints(words):
    for t in [t for _, t in ODD] + [words(n, n) for n in (1, 3, 4, 5, 100, 900)] + ["A  b\x0bC d E é f G"]:
        assert s.fingerprint(t).tolist() == [brute_fp(t)]


def test_manhattan_distance_of_popcounts_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, 5000, np.uint64), rng.integers(0, 1 << 63, 5000, np.uint64)
    counts = lambda x: np.array([[(int(v) >> 2 * k & 3).bit_count() for k in range(32)] for v in x])
    manhattan = np.abs(counts(a) - counts(b)).sum(axis=1)
    assert (np.bitwise_count(s.unary(a) ^ s.unary(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_every_link_meets_in_a_cell():
    rng = random.Random(2)
    for count in (100, 10**6, 10**9, 10**12):
        masks = s.grids(count, 4)
        a = [rng.getrandbits(64) for _ in range(200)]
        b = [x ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 4))) for x in a]
        met = [{}, {}]  # of residents and visitors: the cells of each position
        for side, fps in enumerate((a, b)):
            for at, _, grid, cell, visitor in s.visits(np.array(fps, np.uint64), masks):
                for i, c in zip(at.tolist(), cell.tolist(), strict=True):
                    met[side].setdefault((i, visitor), set()).add((grid, c))
        for i in range(200):
            home, guest = [m[i, False] for m in met], [m.get((i, True), set()) for m in met]
            assert home[0] & home[1] or home[0] & guest[1] or home[1] & guest[0]


def test_long_texts_are_hashed_in_parts(words, monkeypatch):
    texts = [words(n, n) for n in (1, 4, 5, 300)] + ["x" * 500, " a  b c\td e f g " * 40, " " * 99]
    whole = [(s.fingerprint(t).tolist(), s.fingerprint(t, 5, extra=3).tolist()) for t in texts]
    monkeypatch.setattr(s, "PART_CHARS", 16)
    assert [(s.fingerprint(t).tolist(), s.fingerprint(t, 5, extra=3).tolist()) for t in texts] == whole


def near_copies(words, n, seed):
    rng = random.Random(seed)
    base = words(400, seed).split()
    out = []
    for _ in range(n):
        w = list(base)
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    return out


def check(found, rows):
    nodes = [(i, brute_fp(t)) for i, t in rows]
    want = sorted(((i if i is not None else -1), f, c) for (i, f), c in zip(nodes, brute_groups(nodes), strict=True))
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["fp"] % (1 << 64), r["component_id"]) for r in found.collect())
    assert got == want


def test_groups_are_those_of_all_pairs(make, words):
    texts = [words(30 + k % 200, k) for k in range(150)] + near_copies(words, 60, 7) + ["copy of one text here"] * 40
    rows = list(enumerate(texts, 100)) + ODD
    check(s.grouped(make(rows, extra=True)), rows)


def test_hot_cells_are_compared_block_by_block(make, words, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 8)
    rows = list(enumerate(near_copies(words, 90, 9) + [words(60, k) for k in range(60)]))
    check(s.grouped(make(rows)), rows)
    monkeypatch.setattr(s, "HOT_CELLS", 0)
    check(s.grouped(make(rows)), rows)


def test_hot_keys_are_broadcast(make, words, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = list(enumerate([words(40, k % 30) for k in range(100)] + ["one text"] * 60))
    check(s.grouped(make(rows)), rows)


def jaccard(a, b):
    x, y = [set(zip(*[t.lower().split()[k:] for k in range(5)], strict=False)) or {tuple(t.lower().split())} for t in (a, b)]
    return len(x & y) / len(x | y)


def changed(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for k in rng.sample(range(len(w)), n):
        w[k] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_one_row_of_each_group_stays(make, words):
    base = [words(20 + 7 * k, 1000 + k) for k in range(60)]
    near = [changed(t, max(0, len(t.split()) // 60), k) for k, t in enumerate(base)]
    apart = [changed(t, len(t.split()) // 8, k) for k, t in enumerate(base)]
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, t) for k, t in enumerate(near)] + [(200 + k, t) for k, t in enumerate(apart)]
    rows += [(300, base[5]), (300, base[5]), (None, base[0]), (400, words(30, 1)), (400, words(30, 2)), (400, words(30, 2)), (500, None), (501, " "), (502, "")]
    kept = s.deduplicated(make(rows, extra=True)).collect()
    ids = [r["doc_id"] for r in kept]
    close = [k for k in range(60) if jaccard(base[k], near[k]) >= s.SIMILARITY]
    assert len(close) > 40 and all(k in ids for k in range(60)) and all(200 + k in ids for k in range(60) if jaccard(base[k], apart[k]) < s.SIMILARITY and jaccard(near[k], apart[k]) < s.SIMILARITY)
    assert sum(100 + k in ids for k in close) <= 2  # a pair just at the similarity is missed with odds of MISSED
    assert 300 not in ids and ids.count(None) == 1 and ids.count(400) == 2 and 500 in ids and 501 not in ids and 502 not in ids and kept[0]["keep"] == 7


def test_recall_at_the_similarity(make, words):
    rows, pairs = [], 0
    for k in range(150):
        t = words(150, 5000 + k)
        for n in (4, 3, 5, 6):
            other = changed(t, n, k)
            if 0.8 <= jaccard(t, other) < 0.86:
                rows += [(2 * k, t), (2 * k + 1, other)]
                pairs += 1
                break
    kept = {r["doc_id"] for r in s.deduplicated(make(rows)).collect()}
    assert pairs > 100 and sum(r[0] in kept for r in rows if r[0] % 2) <= 0.12 * pairs and all(r[0] in kept for r in rows if r[0] % 2 == 0)


def test_pages_of_one_template_hide_no_copies(make, words):
    base = words(400, 77)
    pages = [changed(base, 9, 100 + k) for k in range(60)]  # of a similarity about 0.65 to each other
    copies = [changed(t, 2, 900 + k) for k, t in enumerate(pages)]
    assert all(jaccard(a, b) > 0.9 for a, b in zip(pages, copies, strict=True)) and max(jaccard(pages[0], p) for p in pages[1:]) < s.SIMILARITY
    kept = {r["doc_id"] for r in s.deduplicated(make(list(enumerate(pages + copies)))).collect()}
    assert kept == set(range(60))


def test_texts_of_one_fingerprint_are_each_verified(make, words, monkeypatch):
    real = s.fingerprint
    monkeypatch.setattr(s, "fingerprint", lambda t, width=4, seed=42, extra=0: np.concatenate([np.zeros(1, np.uint64), real(t, width, seed, extra)[1:]]))
    texts = [words(100, 40 + k) for k in range(12)]
    rows = list(enumerate(texts + [changed(t, 2, k) for k, t in enumerate(texts)] + [t.replace(" ", "  ") for t in texts]))
    edges = s.similar(make(rows).select("doc_id", "text"))[1]
    assert edges.count() == 12 and sorted(r[0] for r in s.deduplicated(make(rows)).select("doc_id").collect()) == list(range(12))


def test_empty_table(make):
    assert s.grouped(make([])).collect() == [] and s.deduplicated(make([])).collect() == []


def test_pairs_that_cannot_be_alike_are_no_rows(spark, make, words, monkeypatch):
    core, sizes = words(150, 1), []
    plain = s.written
    monkeypatch.setattr(s, "written", lambda df, name: (lambda out: (name == "near" and sizes.append(out.count())) or out)(plain(df, name)))
    docs = make([(k, f"{core} {words(70, 100 + k)}") for k in range(40)] + [(50, core), (51, f"{core} {words(20, 9)}")])
    kept = {r["doc_id"] for r in s.deduplicated(docs).select("doc_id").collect()}
    assert kept == {*range(40), 50}
    assert len(sizes) == 2 and sizes[1] < 100  # 780 pairs of those that share the core


def test_marks_leave_out_no_pair_that_is_alike():
    rng = random.Random(3)
    for n in (1, 5, 40, 400, 5000):
        for _ in range(30):
            own = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            other = [w if rng.random() > 0.03 else "x" for w in own]
            x, y = (set(np.concatenate(list(s.shingle_hashes(" ".join(t), 5, 42))).tolist()) for t in (own, other))
            (a, m), (b, k) = s.marked(" ".join(own)), s.marked(" ".join(other))
            p, q = (np.frombuffer(raw, "<u8")[None, :] for raw in (a, b))
            if len(x & y) >= s.SIMILARITY * len(x | y):
                assert s.alike(p, q, np.array([m + k])).all()
