"""Table layout and batch sinks/scans of the lake."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lake:
    """Paths below one root: ``bronze/<stream>``, ``silver/<table>``, ``gold/<domain>/<metric>``, ``checkpoints/<job>``."""

    root: str

    def bronze(self, stream: str) -> str:
        return f"{self.root}/bronze/{stream}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, mart: str = "") -> str:
        return f"{self.root}/gold/{mart}".rstrip("/")

    def insights(self) -> str:
        return f"{self.root}/vectors/insights"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"


# Partition column of each cleaned table.
SILVER_PARTITIONS = {
    "dim_employee": "department",
    "dim_employee_history": "department",
    "fct_attendance": "work_date",
    "fct_performance": "cycle",
    "fct_recruitment": "department",
}

# Partition columns of the chunk collection.
CHUNK_PARTITIONS = ("domain", "kind")


def write_table(
    df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None, *, mode: str = "overwrite", dynamic: bool = False
) -> None:
    """Parquet sink, optionally Hive-partitioned.

    The rebalance hint groups rows of a partition value into few files and lets adaptive execution split the value
    that holds most of the rows, instead of one task per value (skew) or every value in every task (tiny files).
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
        return
    names = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    writer = df.hint("rebalance", *[F.col(n) for n in names]).write.mode(mode).partitionBy(*names)
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """Parquet scan, of the version that holds if the table is published by version. Partition columns come back last and
    with inferred types; ``like`` restores order and types."""
    from peoplelake.sources.versions import read_current  # which writes through this module

    df = read_current(spark, path)
    if df is None:
        df = spark.read.parquet(path)
    if like is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_format(df: DataFrame, path: str, file_format: str, list_field: str = "skills") -> None:
    """CSV (list field pipe-joined), JSON lines or Parquet."""
    if file_format == "csv":
        if list_field in df.columns:
            df = df.withColumn(list_field, F.array_join(list_field, "|"))
        # Surrounding spaces survive. An empty cell is a missing value, so empty text comes back as null.
        df.write.options(**CSV_OPTIONS).csv(path)
    elif file_format == "json":
        df.write.option("ignoreNullFields", False).json(path)
    elif file_format == "parquet":
        df.write.parquet(path)
    else:
        raise ValueError(f"unsupported format {file_format!r}")


def read_format(spark: SparkSession, path: str, file_format: str, schema, list_field: str = "skills") -> DataFrame:
    """Scan with an explicit schema (no inference pass over the data); the list field is an array in every format."""
    if file_format == "csv":
        flat = [
            (f"`{f.name}` string" if f.name == list_field else f"`{f.name}` {f.dataType.simpleString()}")
            for f in schema.fields
        ]
        df = spark.read.schema(", ".join(flat)).options(**CSV_OPTIONS).csv(path)
        if list_field in df.columns:
            df = df.withColumn(list_field, F.split(list_field, r"\|"))
        return df
    return spark.read.schema(schema).format(file_format).load(path)


def file_states(spark: SparkSession, files: list[str]) -> tuple[tuple[str, int, int], ...]:
    """(name, length, time of change) of files in any store, from its directory: no file is opened."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = [path(f).getFileSystem(conf).getFileStatus(path(f)) for f in sorted(files)]
    return tuple((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found)
