"""Connected components of a link table by alternating stars, each round a few joins and a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node reachable.

    Large star: each node links its larger neighbours to the smallest node it knows; small star: each node and its smaller
    neighbours link to the smallest of them. Both keep components and end in one star per component, after a number of
    rounds that grows with the logarithm of the nodes. Minima are combined before the shuffle, and the joins are plain
    ones that adaptive execution splits, so a node with very many links is no task of its own. Null ends and links of
    a node to itself are left out.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
    pairs = staged(pairs.distinct(), "links")
    state = _state(pairs)
    while True:
        pairs = staged(_small_star(_large_star(pairs)), "links")
        if (now := _state(pairs)) == state:
            break
        state = now
    roots = pairs.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct()
    return pairs.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(roots)


def _large_star(pairs: DataFrame) -> DataFrame:
    down = pairs.select(F.col("child").alias("u"), F.col("parent").alias("v"))
    up = pairs.select(F.col("parent").alias("u"), F.col("child").alias("v"))
    low = down.unionByName(up).groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return up.join(low, "u").select(F.col("v").alias("child"), F.col("low").alias("parent"))


def _small_star(pairs: DataFrame) -> DataFrame:
    low = pairs.groupBy("child").agg(F.min("parent").alias("low"))
    others = pairs.join(low, "child").filter("parent <> low").select(F.col("parent").alias("child"), F.col("low").alias("parent"))
    return others.unionByName(low.select("child", F.col("low").alias("parent"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("child", "parent"))).first())
