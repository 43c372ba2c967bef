"""Operator 8, sharding: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import positions, ship, staged, total_of
from peoplelake.llm.feistel import permute

SHARDS = 8
SEED = 20240611


def row_numbers(rows: DataFrame, order: list[str], label: str = "numbered") -> tuple[DataFrame, int]:
    """``rows`` with ``row`` = 0, 1, ... in ``order``, and how many there are; no task sees more than its partition."""
    placed = positions(rows, order, label)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition of the range exchange
    starts = sizes.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    out = placed.join(F.broadcast(starts), "part").withColumn("row", F.col("first") + F.col("nth"))
    return out.drop("part", "nth", "first"), total_of(sizes, "held")


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Deal ``docs`` into shards in a reproducible random order: id, size, text_crc32, row, shard, slot.

    Rows are numbered by (id, text_crc32, size), nulls first; rows equal in these are interchangeable. The permutation
    sends a row number to a place; ``shard = place % shards``, ``slot = place // shards``, so shard sizes differ by one at
    most and slots have no gaps. Neither file layout nor partitioning matters. A null text counts as empty; size is its
    UTF-8 length plus 1. Other columns are not looked at. Equal texts may lie in different shards. No rows give no rows.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    numbered, n = row_numbers(staged(narrow, "shard-rows"), ["id", "text_crc32", "size"])

    @F.pandas_udf("bigint")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    placed = numbered.withColumn("place", place("row"))
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", "row",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {int(shards)}").alias("slot"),
    )


def row_at(shard, slot, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """The row numbers that lie at these shards and slots, computed without any lookup."""
    place = np.asarray(slot, dtype=np.int64) * shards + np.asarray(shard, dtype=np.int64)
    return permute(place, n, seed, forward=False)
