import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (id, text) or (id, text, lang) rows, with a column whose name clashes with an operator's own."""

    def f(rows, extra=False, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts)
        if extra:
            from pyspark.sql import functions as F

            for name in ("spans", "tokens", "score", "fp", "keep", "shard", "n", "lang_pred", "size", "__pred", "__best", "__mass", "text_hash", "block"):
                df = df.withColumn(name, F.lit(7))
        return df

    return f


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def text(n, seed):
        own = random.Random(seed)
        return " ".join(own.choice(vocabulary) for _ in range(n))

    return text
