"""The registered queries: thin, over the whole given tables, through the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (bpe, decontaminate, exact_dedup, fim, hard_negatives, html_extract, langid, piece_bpe, quality,
                        quotations, simhash, suffix_dedup, token_counts)
from parley.llm.common import table

TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine and the executors."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"{TOKENIZERS}/{name}"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, extra={"held_out": held_out})


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_table(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.link_quotes(table(spark, sf_dir, "conversations"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.transform(table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = piece_bpe.encode_table(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, label=label,
                               positives=5, negatives=5, low=80, scale=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_quality, op3_langid, op4_decontaminate, op5_html_extract,
                            op6_exact_dedup, op7_simhash, op8_bpe, op9_quotations, op10_token_counts, op11_fim,
                            op12_piece_bpe, op13_hard_negatives)}
