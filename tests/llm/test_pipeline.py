import importlib
import random

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture
def sf(spark, make, words, tmp_path):
    """A corpus with junk, copies, a benchmark passage and personal data."""
    rng = random.Random(1)
    good = [(k, words(60 + k % 30, k) + ".") for k in range(120)]
    junk = [(200 + k, " ".join(w + rng.choice(["***", "%%%"]) for w in words(50, 3000 + k).upper().split())) for k in range(10)]
    copies = [(300, good[5][1]), (301, good[5][1]), (302, good[6][1].replace(".", " !"))]
    item = words(30, 7777)
    leak = [(400, f"{words(40, 78)} {item} {words(40, 79)}")]
    private = [(500, f"{words(30, 80)} write to a.b@c.example.com {words(30, 81)}")]
    folder = str(tmp_path)
    make(good + junk + copies + leak + private + ODD).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good[:100]] + [(i, 0, 0) for i, _ in junk[:3]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_takes_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
        rows = docs.collect()
        kept[name] = {r["doc_id"]: r for r in rows}
        docs = spark.createDataFrame(rows, docs.schema)
        if name != "sentencepiece":
            assert docs.columns == list(pipeline.COLUMNS)
    assert not set(range(200, 210)) & set(kept["quality_classifier"]) and set(range(120)) <= set(kept["quality_classifier"])
    near = set(kept["simhash_near_dedup"])
    assert not {300, 301} & near and 5 in near and {400, 500} <= near
    assert 400 not in kept["benchmark_decontamination"] and near - set(kept["benchmark_decontamination"]) == {400}
    text = kept["pii"][500]["text"]
    assert "[EMAIL]" in text and "@" not in text and kept["pii"][500]["n_chars"] == len(text)
    assert all(r["text"] == kept["pii"][i]["text"] for i, r in kept["benchmark_decontamination"].items() if i != 500)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["tokens"]) for r in kept["sentencepiece"].values())


def test_run_is_the_stages_one_after_the_other(spark, sf):
    got = pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "tokens", "round_trip"]
    assert got.filter("doc_id = 500").select(F.size("tokens")).first()[0] > 50 and got.filter("doc_id in (200, 300, 400)").count() == 0


def test_empty_tables(spark, make, tmp_path):
    make([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
