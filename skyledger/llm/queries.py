"""The operators applied to whole tables with production settings, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import (
    chat, decontam, embeddings, langid, lm, minhash, packing, pieces, ranked, repair, sharding, toxicity, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, n: int):
    """crc32 of an id as text, modulo n; a null id has none."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def held_out(n: int, value: int):
    return F.coalesce(remainder("doc_id", n) == value, F.lit(False)).alias("held_out")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = toxicity.fit(toxicity.labelled_sample(docs, labels.select("doc_id", F.col("toxic").alias("label"))))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lm.train(docs.where(F.coalesce(remainder("doc_id", 7) != 2, F.lit(True))))
    return lm.score(docs, model).select(
        "doc_id", held_out(7, 2), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = langid.fit(docs.where(remainder("doc_id", 3) != 1))
    return langid.classify(docs, learned).select("doc_id", held_out(3, 1), "lang_pred", "score", "rejected")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # pages name no capture time: a second per page after a fixed moment stands in
    captured = F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + 1_704_067_200).alias("captured")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", captured)
    return warc.archive_and_index(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# A conversation whose texts hold the template's own control strings.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(chat.format_turns(turns, path), path)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), 24)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pieces.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "item_id", "rank", "doc_id", "score")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    reports = repair.repair(repair.damage(turns)).reports().withColumnRenamed("conv_id", "own_id")
    # a conversation that lost all its rows has no report
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(reports, F.col("conv_id").eqNullSafe(F.col("own_id")), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_minhash, op2_toxicity, op3_packing, op4_lm, op5_langid, op6_warc, op7_chat,
        op8_decontamination, op9_embeddings, op10_sharding, op11_pieces, op12_ranked, op13_repair)}
