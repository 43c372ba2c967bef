"""Latest-wins deduplication and current-version marking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType


def _orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and not isinstance(f.dataType, (MapType, VariantType))
    ]


def total_order(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> list[Column]:
    """``newest_by`` descending, then every other column, so equal timestamps still give one repeatable winner."""
    lead = [c for c in newest_by if c in df.columns]
    rest = _orderable(df, [*keys, *lead])
    return [F.col(c).desc_nulls_last() for c in (*lead, *rest)]


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest.

    Written as ``row_number() = 1`` because Spark plans that with a group limit *before* the shuffle: each map task
    keeps one row per key, so a key that owns a third of the table sends one row per task instead of a third of the
    data to one reducer.
    """
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, newest_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_across(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """:func:`latest_per_key` of a union of tables that have each key once, or a few times.

    There is no key with many rows, so a group limit before the shuffle would sort, and spill, whole tables to drop next to
    nothing. The rows are shuffled first and sorted once.
    """
    return latest_per_key(df.repartition(*keys), keys, newest_by)


def mark_current(df: DataFrame, key: str, version_by: str = "event_ts", flag: str = "is_current") -> DataFrame:
    """Keep every version of every key and flag the newest one.

    A window over the key would put all versions of a hot key in one task. Here exact copies collapse to one counted
    row, the newest version per key comes from a partial aggregate, and the join back is an ordinary equi-join whose
    large side adaptive execution can split. Exactly one row per key is flagged, copies included; a missing key has no
    current row.
    """
    columns = df.columns
    order = [version_by, *_orderable(df, [key, version_by])]
    versions = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    versions = versions.withColumn("_version", F.struct(*[F.col(c) for c in order]))
    newest = versions.groupBy(F.col(key).alias("_key")).agg(F.max("_version").alias("_newest"))
    flagged = versions.join(newest, F.col(key) == F.col("_key"), "left")
    return flagged.select(
        *columns,
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
        F.coalesce(F.col("_version") == F.col("_newest"), F.lit(False)).alias("_is_newest"),
    ).select(*columns, (F.col("_is_newest") & (F.col("_copy") == 1)).alias(flag))


def upsert(existing: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Insert-or-replace by key: a row from ``updates`` beats one from ``existing``."""
    both = existing.withColumn("_batch", F.lit(0)).unionByName(updates.withColumn("_batch", F.lit(1)))
    return latest_per_key(both, [key], ["_batch"]).drop("_batch")
