"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's documents.

==========  =================================================================
toxicity    documents that the ordinal model rejects go
near_dups   of each group of near-duplicates the smallest doc_id stays
benchmark   documents that hold a benchmark item go
secrets     documents in which a secret is reported go
encode      ids of every document: doc_id, n_tokens, and digests of the ids and
            of the decoded text
==========  =================================================================

Defined cases (all stages): a null text counts as empty and is kept by every
filter; a row with a null doc_id cannot be named and is kept by every filter;
rows with one doc_id share a decision, equal rows of a kept doc_id all stay;
further columns pass through the filters untouched; empty tables give no rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartgrid.llm import bpe, decontaminate, secrets, simhash, toxicity
from chartgrid.llm.common import keep, table
from chartgrid.llm.queries import WORD_BPE

#: The rows depend on a fitted model, fingerprints and tokenizer files.
ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose doc_id is not among ``gone`` (a column doc_id)."""
    gone = gone.select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return _without(docs, keep(scored.filter("toxic").select("doc_id"), "toxic-ids"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs)
    return _without(docs, found.filter("doc_id <> component_id"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(docs)
    return _without(docs, found.filter((F.size("base") > 0) | (F.size("linked") > 0)))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, WORD_BPE)


STAGES = [("toxicity", toxicity_stage), ("near_dups", near_dup_stage), ("benchmark", benchmark_stage),
          ("secrets", secret_stage), ("encode", encode_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
