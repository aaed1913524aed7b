import hashlib
import random

import pyarrow as pa
import pytest

from docloom.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string, conversation string"


@pytest.fixture
def turns(spark):
    return lambda rows: spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] if r[1] is not None else -1, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        out[conv] = (len(mine), hashlib.sha256(every.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_escapes_are_reversible():
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice("<|\\im_startend>\nxé😀") for _ in range(rng.randint(0, 25)))
        assert c.unescape(c.escape(t)) == t
        assert "<|" not in c.escape(t)


def test_formatted_text_reads_back(turns):
    rng = random.Random(4)
    bits = ["<|im_end|>", "<|im_start|>assistant ok", "<\\|", "<", "|", "\\", "\n", "né😀", "plain words"]
    rows = [(k // 5, k % 5, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))) for k in range(600)]
    rows += [(500, 0, "user", None), (500, 1, None, "x"), (500, 1, None, "x"), (None, 0, "assistant", "no id"), (501, 0, "odd\nrole<|", ""), (502, 3, "assistant", "long " * 20000)]
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in c.digests(c.formatted(turns(rows))).collect()}
    assert got == brute(rows)


def test_batches_and_parts_of_any_size(monkeypatch):
    rng = random.Random(9)
    rows = [(rng.randint(0, 12), k, rng.choice(["user", "assistant"]), "é<|x" * rng.randint(0, 30)) for k in range(150)] + [(None, k, "assistant", "n" * k) for k in range(9)]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    kinds = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    for part in (1, 90, 700, 1 << 20):
        monkeypatch.setattr(c, "PART_BYTES", part)
        for n in (1, 2, 7, 40, 500):
            batches = [pa.RecordBatch.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in rows[k : k + n]], kinds) for k in range(0, len(rows), n)]
            own = {}
            for made in c.assembled(iter(batches), c.Template()):
                made.validate(full=True)
                for r in made.to_pylist():
                    own.setdefault(r["conv_id"], []).append(r)
            assert list(own) == list(dict.fromkeys(r[0] for r in rows))
            for conv, parts in own.items():
                assert [r["part"] for r in parts] == list(range(len(parts)))
                said = [(r, c.parse(r["formatted"])) for r in parts]
                assert [x for _, turns_ in said for x in turns_] == [(r[2], r[3]) for r in rows if r[0] == conv]
                for r, turns_ in said:
                    assert len(turns_) == r["n_turns"]
                    assert [c.unescape(r["formatted"][x["start"] : x["end"]]) for x in r["loss_spans"]] == [t for role, t in turns_ if role == "assistant"]
                assert all(len(r["formatted"].encode()) >= part for r in parts[:-1])


def test_a_long_conversation(turns):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} " * 50) for k in range(40)] + [(2, 0, "user", "hi")]
    spans = c.formatted(turns(rows))
    whole = {r["conv_id"]: r for r in c.digests(spans).collect()}
    assert whole[1]["n_turns"] == 40
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in whole.values()} == brute(rows)


def test_loss_spans_are_the_assistant_texts(turns):
    r = c.formatted(turns([(1, 0, "user", "q"), (1, 1, "assistant", "a<|b"), (1, 2, "assistant", "")])).first()
    assert [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]] == ["a<\\|b", ""]


def test_empty_table(turns):
    assert c.digests(c.formatted(turns([]))).collect() == []
