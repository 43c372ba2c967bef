"""The corpus pipeline: documents in, encoded training mix out. Each stage is one operator of ``peoplelake.llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.llm import bpe, exact_dedup, language, mixing, simhash
from peoplelake.llm.common import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: SQL cannot state the trained and hashed stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near to a known language; centroids are learnt from the documents themselves."""
    return language.drop_rejected(docs, language.train(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints differ in four bits or fewer, that with the smallest id stays: operator 6.

    Documents that share four fifths of their five-word shingles differ in more bits; their links are added to those.
    """
    return simhash.drop_near_copies(docs, radius=simhash.RADIUS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words by source at target weights; a document comes once per epoch, with the words that the mix takes of it."""
    mixed = mixing.mixed_texts(docs, mixing.mix(docs))
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digests of the ids and of the text they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN, ids_col="ids")


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
