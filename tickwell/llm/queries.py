"""The registered queries of the subpackage: each applies an operator, with its production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, langid, licenses, line_dedup, near_dup, packing, pieces, quality, repair, runs, secrets, tokenfile
from .storage import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", *columns)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = chat.format_conversations(turns.unionByName(extra)).withColumns({"turns": chat.read_back(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("bigint").alias("formatted_chars"), "valid", F.coalesce("bad_turn", F.lit(-1)).cast("bigint").alias("bad_turn"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_documents(spark, sf_dir, "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir, "text", "lang"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir, "text"), k=4, percent=80)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_documents(spark, sf_dir, "text"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write_documents(_documents(spark, sf_dir, "text"), TOKENIZER, end=1)
    return tokenfile.read_documents(manifest)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(_documents(spark, sf_dir, "text"), read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select(
        "doc_id", F.col("__d_n_words").alias("n_words"), F.col("__d_n_hit").alias("n_hit"), F.size("__d_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("__d_items", ","), 256).alias("items_sha256"), (F.col("__d_n_hit") > 0).alias("contaminated"),
        F.size("__d_near_items").cast("bigint").alias("n_near_items"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir, "text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir, "text"), TOKENIZER)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(_documents(spark, sf_dir, "lang", "source", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *quality.MEASURES)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    return repair.repair_report(repair.damaged(turns), turns.select("conv_id").distinct())


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.find_runs(runs.with_planted_tail(_documents(spark, sf_dir, "text"))).withColumn("best", runs.strongest(F.col("runs")))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return out.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode_documents(_documents(spark, sf_dir, "text"), PIECES)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_chat_formatting, op2_line_dedup, op3_language_id, op4_minhash_near_dedup, op5_secret_scan, op6_token_files, op7_decontamination, op8_license_scan, op9_packing, op10_quality_rules,
             op11_conversation_repair, op12_periodic_runs, op13_sentencepiece)
    return {f.__name__: f for f in every}
