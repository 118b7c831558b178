"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the columns of ``docs``.
Each stage numbers its rows once and drops by row: null and repeated doc_ids have verdicts of
their own, and exactly one row of a group of copies stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm import bpe, decontaminate, exact_dedup, quality, simhash
from parley.llm.common import release, stash, table
from parley.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose perplexity is above their language's threshold (trusted: labelled good)."""
    return quality.keep_quality(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the smallest doc_id (null last)."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one row, with the smallest doc_id (null last)."""
    return simhash.drop_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that overlap a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the remaining documents."""
    return bpe.encode_table(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("benchmark", benchmark_stage),
          ("tokens", token_stage)]

#: SQL has no language model, SimHash components or BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stash(docs, f"stage-{name}")
            release(spark)
    return docs
