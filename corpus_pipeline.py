"""The corpus pipeline: documents through quality rules, line dedup, near-dedup, decontamination and packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame; ``run`` writes
each stage's rows as Parquet in the shared folder and reads them back as the next one's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import decontam, line_dedup, near_dup, packing, quality
from tickwell.llm.storage import Scratch, columns_of, read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that other documents repeat; n_chars counts what is left. Every document stays."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(columns_of(docs))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words of a benchmark item in a row (or a shorter item whole) go."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Quantile sketches, MinHash and packing have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.save(stage(spark, docs, sf_dir), name)
    return docs
