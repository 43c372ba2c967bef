"""Tables published by version: rows go to a folder of their own, then one small commit file makes them the table.

Layout below a table's path: ``versions/<id>/`` hold rows, ``_commits/<number>.json`` say which of them are the table. The commit
with the largest number holds. A commit file is renamed into place, which fails if another writer took the number, so a job
that dies before leaves the table as it was and two writers can't undo each other.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peoplelake.operators.latest import latest_across
from peoplelake.sources.lake import write_table


class ConcurrentPublish(RuntimeError):
    """Another writer published first; read the table again and repeat."""


@dataclass(frozen=True)
class Commit:
    """The state of a table: its folders, oldest first. With ``keys``, a later folder's row replaces an older one's of equal
    keys unless that is newer by ``newest_by``. ``schema`` holds for all, so a table without rows can be read, and a folder
    without a column has nulls. ``batches`` has the last batch id of each stream that wrote."""

    number: int
    folders: tuple[str, ...]
    schema: str
    keys: tuple[str, ...] = ()
    newest_by: str = ""
    batches: dict[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _read_text(spark: SparkSession, path: str) -> str:
    files, place = _files(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> Commit | None:
    """The commit that holds, None for a table that was never published."""
    numbers = [n for n in _names(spark, f"{path}/_commits") if n.endswith(".json")]
    if not numbers:
        return None
    held = json.loads(_read_text(spark, f"{path}/_commits/{numbers[-1]}"))
    return Commit(held["number"], tuple(held["folders"]), held["schema"], tuple(held["keys"]), held["newest_by"], held["batches"])


def write_version(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None) -> str:
    """Write rows to a new folder that no reader sees yet; its name below the table's path."""
    folder = f"versions/{uuid.uuid4().hex}"
    write_table(df, f"{path}/{folder}", partition_by)
    return folder


def commit(spark: SparkSession, path: str, state: Commit) -> None:
    """Make ``state`` the table, if its number is still free."""
    files, place = _files(spark, f"{path}/_commits/.{uuid.uuid4().hex}")
    stream = files.create(place, False)
    stream.write(bytearray(json.dumps(asdict(state)).encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/_commits/{state.number:020d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(place, target, no_options)
    except Exception as error:
        files.delete(place, False)
        if "FileAlreadyExists" in str(error):
            raise ConcurrentPublish(f"{path}: version {state.number} is taken") from error
        raise


def publish(
    df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None, *, mode: str = "overwrite", keep: int = 2
) -> Commit:
    """Write ``df`` as the next version and make it the table; ``append`` keeps the rows that are there. Older versions than
    the last ``keep`` are deleted, so readers that began on the one before still end."""
    spark, before = df.sparkSession, current(df.sparkSession, path)
    folder = write_version(df, path, partition_by)
    held = before.folders if before and mode == "append" else ()
    state = Commit(_next(before), (*held, folder), df.schema.json())
    commit(spark, path, state)
    expire(spark, path, keep)
    return state


def _next(before: Commit | None) -> int:
    return before.number + 1 if before else 0


def upsert_version(
    df: DataFrame, path: str, keys: Sequence[str], newest_by: str, partition_by: str | None = None, *,
    stream: str = "", batch_id: int = -1, compact_after: int = 8, keep: int = 2,
) -> Commit:
    """Publish rows that replace those of equal keys, writing no others; a batch that a stream published before changes nothing.

    Readers take the newest row per key over the folders. After ``compact_after`` of them a version is written whole, so what
    a batch costs is its own rows plus a bounded share of the table's. ``newest_by`` decides, on a tie the later batch.
    """
    spark, before = df.sparkSession, current(df.sparkSession, path)
    if before and stream and before.batches.get(stream, -1) >= batch_id:
        return before
    folder = write_version(df, path, partition_by)
    state = Commit(
        _next(before), (*(before.folders if before else ()), folder), df.schema.json(), tuple(keys), newest_by,
        {**(before.batches if before else {}), **({stream: batch_id} if stream else {})})
    if len(state.folders) > compact_after:
        whole = write_version(_merged(spark, path, state), path, partition_by)
        state = replace(state, folders=(whole,))
    commit(spark, path, state)
    expire(spark, path, keep)
    return state


def _merged(spark: SparkSession, path: str, state: Commit) -> DataFrame:
    reader = spark.read.schema(StructType.fromJson(json.loads(state.schema)))
    parts = [reader.parquet(f"{path}/{folder}").withColumn("_batch", F.lit(i)) for i, folder in enumerate(state.folders)]
    rows = reduce(DataFrame.unionByName, parts)
    if state.keys and len(parts) > 1:
        rows = latest_across(rows, list(state.keys), [state.newest_by, "_batch"])
    return rows.drop("_batch")


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as published, None if it never was."""
    state = current(spark, path)
    return _merged(spark, path, state) if state else None


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files of the table as published, or below the folder if it never was; found by listing alone."""
    state = current(spark, path)
    found, waiting = [], [f"{path}/{folder}" for folder in state.folders] if state else [path]
    while waiting:
        files, place = _files(spark, waiting.pop())
        for status in files.listStatus(place) if files.exists(place) else ():
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                waiting.append(status.getPath().toString())
            elif name.endswith(".parquet"):
                found.append(status.getPath().toString())
    return sorted(found)


def row_count(spark: SparkSession, files: Sequence[str]) -> int:
    """Rows of Parquet files by their footers; no page is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for file in files:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            total += reader.getRecordCount()
        finally:
            reader.close()
    return total


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, hidden ones left out; none if it is not there."""
    files, place = _files(spark, path)
    listed = files.listStatus(place) if files.exists(place) else ()
    return sorted(s.getPath().getName() for s in listed if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def expire(spark: SparkSession, path: str, keep: int = 2, orphans_after: float = 86_400.0) -> None:
    """Delete commits older than the last ``keep`` with the folders that only they name, and folders that no commit names after
    ``orphans_after`` seconds, which jobs that died have left."""
    names = [n for n in _names(spark, f"{path}/_commits") if n.endswith(".json")]
    states = {n: json.loads(_read_text(spark, f"{path}/_commits/{n}"))["folders"] for n in names}
    live = {f for n in names[-keep:] for f in states[n]}
    gone = {f for n in names[:-keep] for f in states[n]} - live
    for name in names[:-keep]:
        files, place = _files(spark, f"{path}/_commits/{name}")
        files.delete(place, False)
    for version in _names(spark, f"{path}/versions"):
        files, place = _files(spark, f"{path}/versions/{version}")
        folder = f"versions/{version}"
        left = folder not in live and time.time() - files.getFileStatus(place).getModificationTime() / 1000 > orphans_after
        if folder in gone or left:
            files.delete(place, True)
