"""Continuous ingest of JSON feeds into the append-only raw table."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from peoplelake.schemas import stream_schema
from peoplelake.sources.lake import Lake
from peoplelake.sources.log import kafka_stream, parse_messages

# Fixed value: micro-batch interval of a continuous run.
TRIGGER_INTERVAL = "30 seconds"


def start_ingest(
    messages: DataFrame,
    stream: str,
    lake: Lake,
    *,
    once: bool = True,
    interval: str = TRIGGER_INTERVAL,
    ingest_ts: Column | None = None,
) -> StreamingQuery:
    """Start the named query that parses ``messages`` and appends them, partitioned by ingest day.

    Paths follow from the stream name. Stateless, so the checkpoint holds only offsets; together with the file sink's
    commit log a restart neither loses nor repeats rows. ``once`` drains what is available and stops.
    """
    name = f"bronze_{stream_schema(stream).name}"
    writer = (
        parse_messages(messages, stream, ingest_ts)
        .writeStream.format("parquet")
        .queryName(name)
        .outputMode("append")
        .partitionBy("ingest_date")
        .option("path", lake.bronze(stream))
        .option("checkpointLocation", lake.checkpoint(name))
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    batch_log(messages.sparkSession)  # before the first batch
    return writer.trigger(**trigger).start()


def ingest_topic(
    spark: SparkSession, servers: str, topic: str, stream: str, lake: Lake, *, once: bool = False, **source
) -> StreamingQuery:
    """Broker topic to raw table."""
    return start_ingest(kafka_stream(spark, servers, topic, **source), stream, lake, once=once)


class BatchLog(StreamingQueryListener):
    """Progress of every batch of every query run, as Spark reports it: nothing is asked for, so nothing is missed."""

    def __init__(self):
        self._batches: dict[str, dict[int, StreamingQueryProgress]] = defaultdict(dict)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen, p = self._batches[str(event.progress.runId)], event.progress
        # an idle trigger repeats the id of the batch before with no rows
        if p.batchId not in seen or p.numInputRows:
            seen[p.batchId] = p

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, patience: float = 120.0) -> dict[int, StreamingQueryProgress]:
        """All batches of a query that has ended, by id. Reports come behind the run and in order; its end is the last."""
        run = str(query.runId)
        if not self._ended[run].wait(patience):
            raise RuntimeError(f"the end of run {run} was not reported")
        return self._batches.pop(run, {})


_LOGS: dict[str, BatchLog] = {}


def batch_log(spark: SparkSession) -> BatchLog:
    """The application's log, listening from the first call on."""
    application = spark.sparkContext.applicationId
    if application not in _LOGS:
        _LOGS[application] = BatchLog()
        spark.streams.addListener(_LOGS[application])
    return _LOGS[application]


def watch(query: StreamingQuery) -> dict[int, StreamingQueryProgress]:
    """Wait for a query of :func:`start_ingest` to end; the progress of every batch by its id."""
    query.awaitTermination()
    return batch_log(SparkSession.active()).of(query)


def progress_report(spark: SparkSession, batches: Mapping[int, StreamingQueryProgress]) -> DataFrame:
    """One row per micro-batch of :func:`watch`: batch id, input rows and source descriptions."""
    rows = [
        (p.name, int(p.batchId), int(p.numInputRows), [s.description for s in p.sources])
        for _, p in sorted(batches.items())
    ]
    return spark.createDataFrame(rows, "name string, batch_id bigint, input_rows bigint, sources array<string>")
