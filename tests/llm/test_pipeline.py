"""The pipeline's stages against plain versions, each on its own input, and the whole."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from tickwell.llm import quality  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents and benchmark as tables: brute.documents and clean ones, two of them with a benchmark passage."""
    out = str(tmp_path_factory.mktemp("tables"))
    clean = [(1000 + i, " ".join(f"c{i}w{j}" for j in range(80))) for i in range(30)]
    item = " ".join(f"bench{j}" for j in range(14))
    clean += [(2000, clean[0][1] + " extra " + item), (2001, item.upper() + "\n" + " ".join(f"other{j}" for j in range(60)))]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in brute.documents() + clean]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_equal_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "minhash_near_dedup", "decontamination", "packing"]
    before = rows(docs)

    docs = stages["quality_rules"](spark, docs, folder)
    judged = {r.doc_id: r.kept for r in quality.quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    after = rows(docs)
    assert after == [d for d in before if judged[d[0]]]
    assert {i for i, _ in before if i >= 1000} <= {i for i, _ in after}
    assert not [i for i, t in after if brute.counts(t)["n_words"] < 50]

    before, docs = after, stages["line_dedup"](spark, docs, folder)
    after = rows(docs)
    assert [(i, brute.sha(t)) for i, t in after] == [(i, s) for i, _, _, s in sorted(brute.line_dedup(before))]
    assert docs.where(F.col("n_chars") != F.char_length("text")).count() == 0

    before, docs = after, stages["minhash_near_dedup"](spark, docs, folder)
    after = rows(docs)
    assert [i for i, _ in after] == [i for i, _, c in brute.near_dup(before, k=5) if i == c]

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before, docs = after, stages["decontamination"](spark, docs, folder)
    after = rows(docs)
    assert [i for i, _ in after] == sorted(r[0] for r in brute.decontaminate(before, bench) if not r[2])
    assert {2000, 2001}.isdisjoint(i for i, _ in after)
    assert docs.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")

    pieces = stages["packing"](spark, docs, folder).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in after}
    assert all(sum(p.length for p in pieces if p.doc_id == i) == next(p.doc_tokens for p in pieces if p.doc_id == i) for i, _ in after)


def test_run_applies_all_stages(spark, folder):
    pieces = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
