"""A training corpus from raw documents: toxicity, exact and near duplicates, mixing, tokens.

Every stage takes (session, documents, data folder), works on all rows its
predecessor kept, and returns the columns of documents; the last one returns
tokens. The learned first stage has no SQL, so ``ORACLE_SQL`` is None and the
stages are tested against brute force.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinara.llm import bpe, exact_dedup, mixing, simhash, toxicity
from opinara.llm.common import fold, read_documents
from opinara.session import scratch_path

#: Labels of this fold (crc32 of the id as text, modulo 3) are never learned from.
TOXICITY_FOLDS, TOXICITY_HELD_OUT = 3, 1
RANKS = "byte_bpe_multi_50k.tiktoken"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn toxicity from the labels of the training folds, drop what scores 0.7 or more."""
    model = toxicity.fit(docs, read_documents(spark, sf_dir, "labels"),
                         trainable=fold("id", TOXICITY_FOLDS) != TOXICITY_HELD_OUT)
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash one row stays."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    return mixing.mix_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of ids and decoded bytes."""
    coded = bpe.encode(spark, docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic), ("exact_dedup", drop_exact_copies), ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources), ("bpe", encode_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = read_documents(spark, sf_dir)
    job = uuid.uuid4().hex
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{job}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
