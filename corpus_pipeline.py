"""The corpus pipeline: quality, near-duplicates, personal data, mix, tokens.

Each stage takes what the one before has written and calls one operator of
``ratewatch.llm``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratewatch.llm import bpe, mixing, pii, quality, simhash
from ratewatch.llm.common import shared_folder, table

#: Shingle length and differing bits of the near-duplicate stage.
SHINGLE, BITS = 4, 4


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from ``labels``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, docs.columns, score_col="_quality").where("_quality >= 0.5").drop("_quality")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.representatives(docs, BITS, SHINGLE)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard by shard."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, and the digests of these and of the bytes that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.roundtrip(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: No SQL: models, fingerprints and token merges are beyond it. ``tests/llm`` holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
