"""What follows a row within its key, over range partitions, and what comes of it: validity intervals and offset gaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.operators.latest import _orderable
from peoplelake.session import scratch_path


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "next", *, path: str | None = None
) -> DataFrame:
    """``df`` with ``out``: the ``value`` of the next row of equal ``keys`` in ``order``, and ``<out>_there``: whether there is one.

    Rows are sorted by keys, order and all other columns into range partitions, which are written to ``path``; the last row
    of each takes over the first of the following one. So a key of any size is cut over tasks, copies too, and windows run
    over one range partition or over one row per partition. Rows with a null key have no next row.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "sequence")
    sorted_by = [*keys, *order, *_orderable(df, [*keys, *order]), "_tie"]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*sorted_by)
    ranged.sortWithinPartitions(*sorted_by).withColumn("_part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    head = F.struct(*[F.col(c) for c in sorted_by])
    firsts = rows.groupBy("_part").agg(F.min(head).alias("_first"))
    following = firsts.select("_part", F.lead("_first").over(Window.orderBy("_part")).alias("_follows"))
    lead = rows.withColumn("_follows_here", F.lead(F.struct(*[F.col(c) for c in {*keys, value}])).over(
        Window.partitionBy("_part").orderBy(*sorted_by)))
    joined = lead.join(following, "_part", "left")

    def of_next(column: str):
        return F.when(F.col("_follows_here").isNotNull(), F.col("_follows_here")[column]).otherwise(F.col("_follows")[column])

    same = reduce(lambda a, b: a & b, (F.col(k) == of_next(k) for k in keys))
    there = F.coalesce(same, F.lit(False))
    return joined.select(*df.columns, F.when(there, of_next(value)).alias(out), there.alias(f"{out}_there"))


def version_intervals(df: DataFrame, key: str, version_by: str = "event_ts", *, path: str | None = None) -> DataFrame:
    """Every version of every key with ``valid_from``, ``valid_to`` (where the next one begins, null for the last) and
    ``is_current``, true for exactly one row of a key.

    Versions of equal time follow each other in the order of the other columns; all but the last are valid for no time.
    Rows without a key are no versions of anything: not current, without an end. Columns of these names are replaced.
    """
    made = ("valid_from", "valid_to", "is_current")
    rows = df.drop(*[c for c in df.columns if c in made])
    follows = with_next(rows, [key], [version_by], version_by, "_valid_to", path=path)
    return follows.select(
        *rows.columns, F.col(version_by).alias("valid_from"), F.col("_valid_to").alias("valid_to"),
        (F.col(key).isNotNull() & ~F.col("_valid_to_there")).alias("is_current"))


def offset_gaps(
    log: DataFrame, keys: Sequence[str] = ("topic", "partition"), offset: str = "offset", *, path: str | None = None
) -> DataFrame:
    """Offsets that are missing between those of a log: (keys, gap_from, gap_to, missing), one row per gap.

    Offsets that were delivered twice count once; what lies before the first and after the last can't be known.
    Rows without key or offset are left out.
    """
    once = log.select(*keys, offset).dropna().distinct()
    follows = with_next(once, keys, [offset], offset, path=path)
    gap = follows.filter(F.col("next") > F.col(offset) + 1)
    return gap.select(
        *keys, (F.col(offset) + 1).alias("gap_from"), (F.col("next") - 1).alias("gap_to"),
        (F.col("next") - F.col(offset) - 1).alias("missing"))
