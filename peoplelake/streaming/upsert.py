"""Continuous latest-wins upsert of a feed into a cleaned table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from peoplelake.sources import versions
from peoplelake.sources.lake import Lake


def batch_writer(
    path: str, name: str, clean: Callable[[DataFrame], DataFrame], keys: Sequence[str], newest_by: str,
    partition_by: str | None = None, compact_after: int = 8,
) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does: clean its rows, keep the newest per key and publish them with the batch id in the commit.

    The table and the id change together, so a batch that is tried again after a crash, before or after its commit, leaves
    the same table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        held = versions.current(batch.sparkSession, path)
        if held and held.batches.get(name, -1) >= batch_id:
            return
        versions.upsert_version(
            clean(batch), path, keys, newest_by, partition_by, stream=name, batch_id=batch_id, compact_after=compact_after)

    return write


def start_upsert(
    rows: DataFrame, lake: Lake, table: str, clean: Callable[[DataFrame], DataFrame], keys: Sequence[str], newest_by: str,
    partition_by: str | None = None, *, once: bool = True, interval: str = "30 seconds", compact_after: int = 8,
) -> StreamingQuery:
    """Start the named query that keeps ``silver/<table>`` at the newest row per key of the stream ``rows``."""
    name = f"silver_{table}"
    writer = rows.writeStream.queryName(name).option("checkpointLocation", lake.checkpoint(name)).foreachBatch(
        batch_writer(lake.silver(table), name, clean, keys, newest_by, partition_by, compact_after))
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
