"""The operators over the whole given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from carelens.llm import alignment, bpe, embeddings, html, jaccard, language, lines, mixing, negatives, quality, secrets, toxicity, wavelet
from carelens.llm.common import table

#: The tokenizer files; only the driver reads them.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extraction_digest(table(spark, sf_dir, "pages"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embeddings_digest(table(spark, sf_dir, "embeddings"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digest(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_documents(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.near_lines(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)


def op13_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.shards_digest(table(spark, sf_dir, "documents"), TOKENIZER)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_html_text": op2_html_text,
        "op3_bpe": op3_bpe,
        "op4_quality": op4_quality,
        "op5_embedding_near_dedup": op5_embedding_near_dedup,
        "op6_language": op6_language,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_mixing": op8_mixing,
        "op9_line_dedup": op9_line_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_token_alignment": op12_token_alignment,
        "op13_token_shards": op13_token_shards,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op1_secret_scan": secrets.oracle(),
        "op5_embedding_near_dedup": embeddings.ORACLE,
        "op7_jaccard_join": jaccard.ORACLE,
        "op8_mixing": mixing.ORACLE,
        "op11_hard_negatives": negatives.ORACLE,
    }
