import hashlib
import random
import time

import sentencepiece
from conftest_llm import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import sentencepiece_codec as s

MODEL = s.model_path()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CODEC = s.codec(MODEL)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_the_library_does(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = LIBRARY.encode(text)
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


def test_pieces_and_spaces():
    rng = random.Random(1)
    names = list(CODEC.ids)
    for k in range(6000):
        text = "".join(rng.choice(names) for _ in range(rng.randint(1, 6))) if k % 2 else "".join(rng.choice([" ", "  ", " " * rng.randint(1, 40), "the", "\n", "x", "é"]) for _ in range(8))
        assert CODEC.encode(text) == LIBRARY.encode(text), text


def test_any_ids_are_decoded_as_the_library_does():
    rng = random.Random(2)
    for _ in range(4000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randint(0, 12))]
        assert CODEC.decode(ids) == LIBRARY.decode(ids), ids


def test_long_texts():
    for text in ("ab" * 20000, "x" * 20000, " " * 30000, "中" * 5000):
        assert CODEC.encode(text) == LIBRARY.encode(text)


def test_long_words_take_linear_time():
    rng = random.Random(6)

    def seconds(n):
        text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/") for _ in range(n))
        start = time.perf_counter()
        ids = CODEC.encode(text)
        spent = time.perf_counter() - start
        assert ids == LIBRARY.encode(text)
        return spent

    seconds(20_000)
    assert min(seconds(200_000) for _ in range(2)) < 3 * min(seconds(100_000) for _ in range(2)) + 0.2


def test_memory_is_emptied_without_a_trace(monkeypatch):
    monkeypatch.setattr(s, "MEMORY", 50)
    c = s.Codec(MODEL)
    rng = random.Random(3)
    for _ in range(300):
        text = " ".join("".join(rng.choice("abcdeinrst") for _ in range(rng.randint(1, 9))) for _ in range(10))
        assert c.encode(text) == LIBRARY.encode(text)


def test_tables(make):
    docs = make(ODD, extra=True)
    got = s.round_trip(docs, MODEL).collect()
    want = sorted((i or -1, hashlib.sha256(",".join(map(str, LIBRARY.encode(t or ""))).encode()).hexdigest()) for i, t in ODD)
    assert sorted((r["doc_id"] or -1, r["ids_sha256"]) for r in got) == want
    both = s.decoded(s.encoded(docs, MODEL), MODEL).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in both) and len(both) == len(ODD)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["tokens"]) for r in s.tokenized(docs, MODEL).collect())
    assert s.round_trip(make([]), MODEL).collect() == []
