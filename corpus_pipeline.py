"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import decontam, langid, minhash, packing, toxicity
from skyledger.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from `lang`, without those that are rejected as unclear."""
    return langid.keep_clear(docs, langid.fit(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model learned from the `toxic` labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.keep_clean(docs, toxicity.fit(toxicity.labelled_sample(docs, labels)))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near duplicates."""
    return minhash.keep_one(docs, minhash.Settings(percent=80, bands=32, rows=5))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences of 2048."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("toxicity", toxic), ("near-duplicates", deduplicated),
    ("decontamination", decontaminated), ("packing", packed)]

# Compression sizes, fitted weights and token ids are beyond SQL. The pipeline's test checks
# which documents each stage drops in one planted table; near-duplicates, decontamination and
# packing are held against brute force as operators, not on the pipeline's own rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
