"""The registered training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.llm import (
    bpe,
    embeddings,
    exact_dedup,
    language,
    mixing,
    negatives,
    pieces,
    quality,
    sharding,
    simhash,
    toxicity,
    warc,
    whitening,
)
from peoplelake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = exact_dedup.DigestIndex.open(spark, scratch_path(spark, "digest-index"))
    report = exact_dedup.dedup_report(table(spark, folder, "documents"), index, "first")
    index.close()
    return report.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def fold(docs: DataFrame, of: int) -> Column:
    """CRC-32 of the id as text, modulo ``of``; null ids count as the empty text."""
    return F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % of


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with their labels: one row per labelled document; of labels that repeat an id, the largest holds."""
    once = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    # the same plan at any size: texts are shuffled once, whether or not the labels would fit a broadcast
    return docs.select("doc_id", "text").join(once.hint("merge"), "doc_id")


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(docs, 3) == 1
    labels = table(spark, folder, "labels")
    learnt = with_labels(docs.filter(~held_out), labels.filter(fold(labels, 3) != 1))
    model = toxicity.train(learnt.withColumnRenamed("toxic", "label"))
    scored = toxicity.score(docs.withColumn("held_out", held_out), model)
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.archive(table(spark, folder, "pages"))
    stored = F.col("payload").isNotNull()
    return read.select(
        "page_id",
        F.when(stored, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


@query
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN)


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Grades 0 (poor), 1 (well written but toxic), 2 (good) from the two labels; a text is selected if grade 1 is likely."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(docs, 4) == 3
    labels = table(spark, folder, "labels")
    ratings = labels.filter(fold(labels, 4) != 3).select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
    model = quality.train(docs, ratings)
    rated = quality.rate(docs.withColumn("held_out", held_out), model)
    tail = F.coalesce(F.get("tails", F.lit(0)), F.lit(1.0))
    return rated.select(
        "doc_id", "held_out", "expected_grade", tail.alias("p_fair"),
        F.coalesce(F.get("tails", F.lit(1)), tail).alias("p_good"), (tail >= 0.5).alias("selected"))


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row")


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold(docs, 4) == 2
    model = language.train(docs.filter(~held_out))
    found = language.identify(docs.drop("lang").withColumn("held_out", held_out), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    rows = mixed.rows.join(mixed.taken(), "row_id", "left")
    per_source = mixed.sources.select("source_rank", "source_size", "target")
    return rows.join(per_source, "source_rank").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


@query
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode_digests(docs, public_tokenizers.path(PIECES), agrees_col="library_agrees")


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Where vec_id is divisible by 7 the label is first moved on by one; anchors are the ids divisible by 50."""
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))
