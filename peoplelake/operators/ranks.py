"""Exact values at given ranks, per group, by counting over range partitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.session import scratch_path


def value_counts(df: DataFrame, measure: str, by: Sequence[str], path: str) -> DataFrame:
    """(group, value, n, part) written to ``path``: each different value of a group once, in range partitions ``part``.

    Copies fold in the map tasks, so a value that holds a third of the rows is one row per task. Partitions are ranges of
    (group, value), so a group of any size is cut, and their order is the order of values. Being written, the ranges and
    their numbers stay what they are, whatever task is run again.
    """
    valid = df.filter(F.col(measure).isNotNull() & ~F.isnan(F.col(measure).cast("double")))
    counted = valid.groupBy(*by, F.col(measure).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange(*by, "value").sortWithinPartitions(*by, "value")
    ranged.withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


def rank_of(point: float, rows: Column) -> Column:
    """1-based rank of the smallest value that has at least the share ``point`` of ``rows`` values up to it."""
    return F.greatest(F.lit(1).cast("bigint"), rows - F.floor(rows - F.lit(point) * rows))


def exact_quantiles(
    df: DataFrame, measure: str, points: Sequence[float], by: Sequence[str] = (), *, path: str | None = None
) -> DataFrame:
    """(group, q): the discrete quantiles of ``measure`` at ``points``, exact and the same in every run.

    The value at a rank lies in the partition where the running count of the group's partitions passes the rank, so only
    these are looked into, each by itself. No task sees a whole group: windows run over one row per partition, then over
    one group's values within one partition. Null and NaN values are left out; a null group is a group; groups without
    values give no row, but without ``by`` there is always one row, with nulls if there are no values.
    """
    path = path or scratch_path(df.sparkSession, "value-counts")
    counts = value_counts(df, measure, by, path)
    per_part = counts.groupBy(*by, "part").agg(F.sum("n").alias("held"))
    running = Window.partitionBy(*by).orderBy("part")
    upto = per_part.withColumns({
        "upto": F.sum("held").over(running), "rows": F.sum("held").over(Window.partitionBy(*by))})
    wanted = F.explode(F.array(*[
        F.struct(F.lit(i).alias("point"), rank_of(p, F.col("rows")).alias("rank")) for i, p in enumerate(points)])).alias("w")
    targets = upto.select(*by, "part", "upto", "held", wanted).filter(
        (F.col("w.rank") <= F.col("upto")) & (F.col("w.rank") > F.col("upto") - F.col("held")))
    targets = targets.select(
        *by, "part", F.col("w.point").alias("point"), (F.col("w.rank") - F.col("upto") + F.col("held")).alias("rank"))
    looked_into = counts.alias("c").join(
        targets.select(*by, "part").distinct().alias("t"), _same("c", "t", [*by, "part"]), "left_semi")
    within = Window.partitionBy(*by, "part").orderBy("value")
    placed = looked_into.withColumn("last", F.sum("n").over(within))
    hit = _same("p", "t", [*by, "part"]) & (F.col("t.rank") <= F.col("p.last")) & (F.col("t.rank") > F.col("p.last") - F.col("p.n"))
    found = placed.alias("p").join(targets.alias("t"), hit).select(
        *[F.col(f"p.{c}") for c in by], F.col("t.point"), F.col("p.value"))
    return found.groupBy(*by).agg(
        F.array(*[F.max(F.when(F.col("point") == i, F.col("value"))) for i in range(len(points))]).alias("q"))
