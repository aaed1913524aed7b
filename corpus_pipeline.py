"""A training corpus from raw documents: each stage applies one operator to all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontamination, pii, quality_lm, sentencepiece_codec, simhash
from docloom.llm.common import table, written

#: The columns of ``documents``, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the labels of the corpus say which texts it trusts."""
    return quality_lm.filtered(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays, the one with the least id."""
    return simhash.deduplicated(docs).select(*COLUMNS)


def decontamination_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, are replaced in the text; n_chars is that of the new text."""
    return pii.sanitized(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    out = sentencepiece_codec.tokenized(docs.select(*COLUMNS), sentencepiece_codec.model_path())
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "tokens", "round_trip")


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination_),
    ("pii", personal_data),
    ("sentencepiece", sentencepiece),
]

#: SQL can't express the first two stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
