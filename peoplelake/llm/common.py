"""Shared pieces of the training-data operators: staged tables, skew-safe joins, dense row positions."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import peoplelake
from peoplelake.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: A key that holds at least one row in so many is joined by broadcast; there are at most so many such keys.
HOT_SHARE = 1000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, so a cluster needs no installation of it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(peoplelake.__file__).parent
    path = f"{tempfile.mkdtemp()}/peoplelake.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def total_of(df: DataFrame, column: str | Column) -> int:
    """Sum of a column as a Python integer, 0 for no rows."""
    return int(df.agg(F.sum(column).alias("total")).first()["total"] or 0)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or with underscores in front until no column of ``taken`` is called so (case aside)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def hashed_sample(rows: DataFrame, group: str, text: str, most: int, held: dict) -> DataFrame:
    """(group, text): ``most`` different texts of each group or all if fewer, those with the smallest hashes.

    ``held`` has the rows of each group; of groups with many, the different hashes are counted first. Before texts are
    shuffled, those are dropped whose hash is far above that of the last one wanted, and copies are folded where they lie,
    so a group of any size sends a few times ``most`` texts per task at the most.
    """
    place = F.shiftrightunsigned(F.xxhash64(text), 11)  # 53 bits, exact as a double
    wanted = 3.0 * most + 30  # on average; fewer than ``most`` come in less than one case of 10**12
    many = [g for g, n in held.items() if n > wanted]
    different = rows.filter(F.col(group).isin(many)).select(group, place.alias("place")).distinct()
    counted = {r[group]: r["count"] for r in different.groupBy(group).count().collect()} if many else {}
    shares = [F.when(F.col(group) == F.lit(g), F.lit(min(1.0, wanted / counted.get(g, n)) * 2.0**53)) for g, n in held.items() if n]
    if not shares:
        return rows.select(group, text).limit(0)
    near = rows.select(group, text, place.alias("place")).filter(F.col("place") < F.coalesce(*shares))
    once = near.groupBy(group, "place").agg(F.min(text).alias(text))
    order = Window.partitionBy(group).orderBy("place")
    return once.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).select(group, text)


def join_by_key(rows: DataFrame, facts: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Equi-join of ``rows`` (any number per key) with ``facts`` (one row per key, ``weight`` = its rows on the left).

    Keys that hold at least 1 / HOT_SHARE of the total weight, at most HOT_SHARE of them, are joined by broadcast where
    their rows lie; all others are shuffled. So no task gets more than its share, whatever one key holds. ``rows`` is
    read twice and should be staged and narrow. Null keys match nothing.
    """
    total = total_of(facts, weight)
    hot = facts.filter(F.col(weight) * HOT_SHARE >= F.lit(total))
    cold = facts.filter(F.col(weight) * HOT_SHARE < F.lit(total))
    at_once = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return at_once.unionByName(others)


def positions(
    rows: DataFrame, order: list[str], label: str, then: Callable[[DataFrame], DataFrame] = lambda ranged: ranged
) -> DataFrame:
    """Stage ``rows`` in ``order`` with their range partition ``part`` and their place ``nth`` in it, both from 0.

    ``then`` may work on the sorted partitions before they are written.

    Ties in ``order`` are broken by the reading position, so equal keys may be split over partitions; callers put every
    column that matters into ``order``. Boundaries are drawn once, as the result is a written table.
    """
    ranged = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie")
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return staged(then(ranged.withColumns({"part": F.spark_partition_id(), "nth": local})), label)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
