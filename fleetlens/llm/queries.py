"""Training-data operators as named queries over one test-data folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    bytebpe,
    chat,
    clustering,
    decontaminate,
    langid,
    lines,
    packing,
    pii,
    quality,
    repair,
    simhash,
    substrings,
    tokenfiles,
)
from fleetlens.llm.oracle import oracle_sql  # noqa: F401  (the entry module reads both from here)
from fleetlens.llm.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary and ids as ranks, and the pattern that parts words.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = quality.learn_rules(quality.labelled(docs, _table(spark, sf_dir, "labels")))
    return quality.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base.kind", pii.is_kind(kind))).cast("long").alias(f"n_{kind}")
              for kind in pii.PATTERNS]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedupe_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    read = chat.conversations(chat.windows(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), BYTE_BPE)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write_token_files(
        _table(spark, sf_dir, "documents"), WORD_BPE, scratch_path(spark, "tokens"))
    return tokenfiles.read_documents(spark, manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.with_inertia(*clustering.cluster(_table(spark, sf_dir, "embeddings")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.summaries(repair.damaged(_table(spark, sf_dir, "conversations")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bytebpe.encode(_table(spark, sf_dir, "documents"), *BYTE_RANKS)
    return bytebpe.decode(encoded, BYTE_RANKS[0]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_pii": op2_pii,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_simhash": op4_simhash,
        "op5_decontamination": op5_decontamination,
        "op6_line_dedup": op6_line_dedup,
        "op7_chat_format": op7_chat_format,
        "op8_packing": op8_packing,
        "op9_token_files": op9_token_files,
        "op10_language_id": op10_language_id,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_byte_bpe": op13_byte_bpe,
    }
