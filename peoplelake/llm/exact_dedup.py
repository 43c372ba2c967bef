"""Operator 1, exact deduplication: a persistent digest index, bucketed and sorted by hash; SQL functions only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.llm.common import fresh, join_by_key, staged, union_all
from peoplelake.session import scratch_path
from peoplelake.sources import versions


def digest(text: str | Column) -> Column:
    """SHA-256 of the UTF-8 text as 32 bytes; null counts as the empty text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary"), 256))


#: Spark then trusts that a bucket of one file is sorted, as it was written, and merges it without sorting it again.
SORTED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"
#: Runs of an index from which they are merged into one.
RUNS = 8


@dataclass
class DigestIndex:
    """Known digests in ``path``: (digest, keep_id, batch) in runs, one per batch, each in hash buckets of one sorted file.

    The number of buckets is chosen when the index is made (default: the session's shuffle partitions) and written
    beside it, so every later session reads it with the layout it was written in. Runs count once a small commit names them, so
    a batch that died has added nothing and two writers can't undo each other. No digest is in two runs. ``open`` sets
    SORTED_BUCKETS in the session.
    """

    spark: SparkSession
    path: str
    buckets: int
    id_type: str
    names: dict[str, str]

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint") -> DigestIndex:
        """Open the index in ``path``, or make an empty one."""
        layout = "buckets int, id_type string"
        try:
            made = spark.read.schema(layout).parquet(f"{path}/layout").first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            made = (buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), id_type)
            spark.createDataFrame([made], layout).coalesce(1).write.parquet(f"{path}/layout")
        spark.conf.set(SORTED_BUCKETS, "true")
        return cls(spark, path, made[0], made[1], {})

    def _run(self, folder: str) -> DataFrame:
        """A run as a bucketed table; the name is the session's own."""
        if folder not in self.names:
            self.names[folder] = f"digest_run_{uuid.uuid4().hex}"
            place = f"{self.path}/{folder}".replace("'", r"\'")
            self.spark.sql(
                f"CREATE TABLE {self.names[folder]} (digest BINARY, keep_id {self.id_type}, batch STRING) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(self.names[folder])

    def runs(self) -> list[DataFrame]:
        state = versions.current(self.spark, self.path)
        return [self._run(folder) for folder in state.folders] if state else []

    def table(self) -> DataFrame:
        """All known digests."""
        empty = self.spark.createDataFrame([], f"digest binary, keep_id {self.id_type}, batch string")
        return union_all(self.runs() or [empty])

    def _write(self, rows: DataFrame) -> str:
        folder = f"versions/{uuid.uuid4().hex}"
        self._run(folder)
        (rows.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.names[folder]))
        self.spark.catalog.refreshTable(self.names[folder])
        return folder

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the digests of ``groups`` (digest, keep_id; one row each) that the index lacks, as a run of their own.

        The new digests are shuffled and sorted once and go through sort-merge anti-joins with every run, whose buckets are
        neither shuffled nor sorted. Running a batch again adds nothing. From RUNS runs on they are merged into one.
        """
        before = versions.current(self.spark, self.path)
        new = groups.select("digest", "keep_id").repartition(self.buckets, "digest")
        for run in self.runs():
            new = new.join(run.hint("merge"), "digest", "left_anti")
        folders = (*(before.folders if before else ()), self._write(new.withColumn("batch", F.lit(batch))))
        if len(folders) > RUNS:
            folders = (self._write(union_all([self._run(f) for f in folders]).repartition(self.buckets, "digest")),)
        schema = self._run(folders[-1]).schema.json()
        versions.commit(self.spark, self.path, versions.Commit(before.number + 1 if before else 0, folders, schema))
        versions.expire(self.spark, self.path)

    def look_up(self, groups: DataFrame) -> DataFrame:
        """``groups`` (digest, ...) with keep_id and batch of their digests, by sort-merge joins with every run."""
        dealt = groups.repartition(self.buckets, "digest")
        return union_all([dealt.join(run.hint("merge"), "digest") for run in self.runs()])

    def close(self) -> None:
        """Forget the table names; the files stay, and so do frames that read them."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = {}


def dedup_report(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Deduplicate ``docs`` against ``index`` and within itself, and append its new digests.

    One row per row of ``docs``: id, keep_id, group_size, kept, digest. Texts are equal when their bytes are; null counts
    as empty. Of the rows with a text that the index lacks, that with the largest id stays (null ids come last); of rows
    that repeat both text and id, one stays. A text that an earlier batch holds keeps that batch's id and no row of this
    one. group_size counts this batch. Other columns of ``docs`` are not looked at. No rows give no rows.
    """
    digests = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"))
    rows = staged(digests.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("copies")), "dedup-rows")
    groups = staged(
        rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")), "dedup-groups")
    index.append(groups, batch)
    facts = staged(index.look_up(groups.drop("keep_id")), "dedup-facts")
    out = join_by_key(rows, facts, "digest", "group_size")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1) & (F.col("batch") == batch)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", stays.alias("kept"), "digest")


def drop_exact_copies(
    docs: DataFrame, index: DigestIndex | None = None, batch: str = "first",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that :func:`dedup_report` keeps, with all their columns and nothing else.

    Without ``index`` a new one is made in the shared folder. Texts are shuffled once, by (digest, id).
    """
    spark = docs.sparkSession
    index = index or DigestIndex.open(spark, scratch_path(spark, "digest-index"), id_type=docs.schema[id_col].dataType.simpleString())
    report = dedup_report(docs, index, batch, id_col, text_col)
    index.close()
    mark, own = fresh("text_digest", docs.columns), fresh("own_id", docs.columns)
    keepers = staged(report.filter("kept").select(F.col(id_col).alias(own), F.col("digest").alias(mark)), "dedup-kept")
    marked = docs.withColumn(mark, digest(text_col))
    same_id = marked[id_col].eqNullSafe(keepers[own])
    kept = marked.join(keepers, (marked[mark] == keepers[mark]) & same_id, "left_semi")
    return kept.dropDuplicates([mark, id_col]).drop(mark)
