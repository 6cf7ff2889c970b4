"""The corpus pipeline: documents through five stages, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelens.llm import bpe, jaccard, lines, mixing, toxicity
from carelens.llm.common import stored, table
from carelens.llm.queries import TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from the labels of
    those that are not held out."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line stands for."""
    return lines.without_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count and hashes of each document of the mix."""
    return bpe.encode_digest(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: The classifier, the edit join and the tokenizer can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        if i:
            docs = stored(docs, f"stage-{i}")
        docs = stage(spark, docs, sf_dir)
    return docs
