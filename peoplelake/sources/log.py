"""The raw event log: message sources, payload parsing, incremental reads, audit and replay, record publishing.

Every function works on a *message frame* with the columns of Spark's Kafka source
(``key, value, topic, partition, offset, timestamp``), whichever source produced it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.schemas import LOG_COLUMNS, stream_schema

MESSAGE_DDL = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
# Back-pressure and audit preview defaults.
MAX_OFFSETS_PER_TRIGGER = 50_000
PREVIEW_CHARS = 200


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "latest",
    max_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    fail_on_data_loss: bool = True,
    **options: str,
) -> DataFrame:
    """Message frame from a broker. Needs the public ``spark-sql-kafka`` connector on the classpath.

    Offsets that the broker has dropped end the query; with ``fail_on_data_loss`` off it goes on, and
    ``sequences.offset_gaps`` tells what is missing.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
        .load()
    )


def file_stream(
    spark: SparkSession, path: str, schema: str, *, file_format: str = "parquet", max_files_per_trigger: int = 1000
) -> DataFrame:
    """Streaming scan of landed files; the file cap plays the part of the offset cap."""
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )


def parse_messages(messages: DataFrame, stream: str, ingest_ts: Column | None = None) -> DataFrame:
    """Flatten the JSON payload next to the log coordinates and stamp the ingest time.

    Parsing is permissive: a broken payload gives null fields and the row stays, with its text in ``_raw``. The
    clock can be replaced by a column for replays and tests.
    """
    schema = stream_schema(stream).struct
    stamped = messages.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_ts"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("_raw"),
        (F.current_timestamp() if ingest_ts is None else ingest_ts).alias("ingest_ts"),
    )
    return stamped.select(
        *LOG_COLUMNS,
        F.from_json("_raw", schema).alias("payload"),
        "ingest_ts",
        F.to_date("ingest_ts").alias("ingest_date"),
    ).select(*LOG_COLUMNS, "payload.*", "ingest_ts", "ingest_date")


def read_since(spark: SparkSession, path: str, since: dt.date | str | None = None) -> DataFrame:
    """Raw table from ``since`` on; the date literal becomes a partition filter, so older folders are not listed."""
    df = spark.read.parquet(path)
    return df if since is None else df.filter(F.col("ingest_date") >= F.lit(str(since)).cast("date"))


def audit(
    log: DataFrame,
    topic: str,
    *,
    from_offset: int = 0,
    to_offset: int | None = None,
    partition: int | None = None,
    max_messages: int | None = None,
    preview_chars: int = PREVIEW_CHARS,
) -> DataFrame:
    """Messages of a topic in log order: the payload when it is JSON, otherwise a short preview of the text.

    ``max_messages`` is the operator's stop-after-N switch; Spark plans it as a bounded top-N per task.
    """
    rows = log.filter((F.col("topic") == topic) & (F.col("offset") >= from_offset))
    if to_offset is not None:
        rows = rows.filter(F.col("offset") < to_offset)
    if partition is not None:
        rows = rows.filter(F.col("partition") == partition)
    is_json = F.try_parse_json("_raw").isNotNull()
    rows = rows.select(
        "topic",
        "partition",
        "offset",
        "kafka_key",
        is_json.alias("is_json"),
        F.when(is_json, F.col("_raw")).otherwise(F.substring("_raw", 1, preview_chars)).alias("payload"),
    )
    if max_messages:
        rows = rows.orderBy("partition", "offset").limit(max_messages)
    return rows


def replay(log: DataFrame, stream: str, topic: str, *, from_offset: int = 0, to_offset: int | None = None) -> DataFrame:
    """Parse the kept ``_raw`` text again, e.g. after a schema change; ingest stamps stay those of the first pass."""
    rows = log.filter((F.col("topic") == topic) & (F.col("offset") >= from_offset))
    if to_offset is not None:
        rows = rows.filter(F.col("offset") < to_offset)
    messages = rows.select(
        F.col("kafka_key").alias("key"),
        F.col("_raw").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("kafka_ts").alias("timestamp"),
        "ingest_ts",
    )
    return parse_messages(messages, stream, F.col("ingest_ts"))


def to_records(rows: DataFrame, key: str = "employee_id", list_field: str = "skills", separator: str = "|") -> DataFrame:
    """Rows to message records: key text and a JSON value that keeps nulls.

    NaN becomes null (JSON has no NaN) and a separator-joined list field becomes a JSON array without empty items.
    """
    fields = []
    for f in rows.schema.fields:
        c = F.col(f.name)
        kind = f.dataType.simpleString()
        if kind in ("double", "float"):
            c = F.nullif(c, F.lit(float("nan")).cast(kind))
        elif f.name == list_field and kind == "string":
            c = F.filter(F.split(c, F.lit("\\Q" + separator + "\\E")), lambda item: item != "")
        fields.append(c.alias(f.name))
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rows.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def publish(records: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Write records to a broker with idempotent, fully acknowledged sends."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .options(**options)
        .save()
    )
