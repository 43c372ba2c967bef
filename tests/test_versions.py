"""Publication by version: what readers see when a job dies, when two write, and when a stream repeats a batch."""

import pytest
from pyspark.sql import functions as F

from peoplelake.plans import catalog, jobs
from peoplelake.sources import versions
from peoplelake.sources.lake import Lake, read_table
from peoplelake.streaming.upsert import batch_writer, start_upsert
from tests.test_cleaning import FEED, feed_row

AS_OF = "2024-06-30"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_job_that_dies_before_the_swap_leaves_the_table_whole(spark, lake, monkeypatch):
    def feed(count):
        return spark.createDataFrame([feed_row(f"E{i}", i) for i in range(count)], FEED)

    jobs.clean_employees(feed(20), lake, AS_OF)
    target = lake.silver("dim_employee")
    seen = rows(read_table(spark, target).select("employee_id", "salary"))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", dies)
        for mode in jobs.MODES:
            with pytest.raises(RuntimeError, match="lost"):
                jobs.clean_employees(feed(3), lake, AS_OF, mode=mode)
    assert rows(read_table(spark, target).select("employee_id", "salary")) == seen
    assert len(versions._names(spark, f"{target}/versions")) == 3  # two that nobody reads
    jobs.clean_employees(feed(3), lake, AS_OF)
    assert read_table(spark, target).count() == 3
    versions.expire(spark, target, keep=1, orphans_after=-1.0)
    assert len(versions._names(spark, f"{target}/versions")) == 1 and read_table(spark, target).count() == 3


def test_a_reader_that_began_before_ends(spark, lake):
    path = lake.gold("a/b")
    versions.publish(spark.range(5), path)
    reader = read_table(spark, path)
    versions.publish(spark.range(7), path)
    assert reader.count() == 5 and read_table(spark, path).count() == 7
    versions.publish(spark.range(2), path, mode="append")
    assert read_table(spark, path).count() == 9
    assert versions.current(spark, lake.gold("none")) is None and versions.read_current(spark, lake.gold("none")) is None


def test_tables_without_rows_and_with_a_later_column(spark, lake):
    path = lake.silver("empty")
    versions.publish(spark.createDataFrame([], "a int, p string"), path, "p")
    assert read_table(spark, path).count() == 0 and sorted(read_table(spark, path).columns) == ["a", "p"]
    versions.publish(spark.createDataFrame([(1, 2, "x")], "a int, b int, p string"), path, "p", mode="append")
    assert rows(read_table(spark, path).select("a", "b", "p")) == [(1, 2, "x")]


def test_two_writers_do_not_undo_each_other(spark, lake):
    path = lake.gold("a/b")
    versions.publish(spark.range(5), path)
    taken = versions.Commit(1, (versions.write_version(spark.range(6), path),), spark.range(6).schema.json())
    versions.publish(spark.range(7), path)
    with pytest.raises(versions.ConcurrentPublish):
        versions.commit(spark, path, taken)
    assert read_table(spark, path).count() == 7


def write_days(spark, folder, days):
    for n, day in enumerate(days):
        spark.createDataFrame(day, "id string, team string, at int").coalesce(1).write.mode("append").parquet(folder)


DAYS = [
    [("a", "x", 1), ("b", "x", 1), ("c", "y", 5)],
    [("a", "y", 2), ("c", "x", 4), (None, "x", 1)],
    [("d", "z", 1), ("b", "z", 3), ("b", "x", 2)],
]
NEWEST = [("a", "y", 2), ("b", "z", 3), ("c", "y", 5), ("d", "z", 1)]


@pytest.mark.parametrize("compact_after", [1, 2, 8])
def test_stream_upsert_keeps_the_newest_row(spark, lake, tmp_path, compact_after):
    feed = str(tmp_path / "feed")
    write_days(spark, feed, DAYS)

    def clean(df):
        return df.filter("id IS NOT NULL").groupBy("id").agg(F.max_by("team", "at").alias("team"), F.max("at").alias("at"))

    stream = spark.readStream.schema("id string, team string, at int").option("maxFilesPerTrigger", 1).parquet(feed)
    query = start_upsert(stream, lake, "people", clean, ["id"], "at", compact_after=compact_after)
    query.awaitTermination()
    table = lake.silver("people")
    assert rows(read_table(spark, table).select("id", "team", "at")) == NEWEST
    state = versions.current(spark, table)
    assert len(state.folders) <= compact_after and state.batches == {"silver_people": 2}
    # a batch that comes again, with whatever rows, changes nothing
    again = batch_writer(table, "silver_people", clean, ["id"], "at", compact_after=compact_after)
    again(spark.createDataFrame([("a", "wrong", 99)], "id string, team string, at int"), 2)
    assert versions.current(spark, table) == state and rows(read_table(spark, table).select("id", "team", "at")) == NEWEST


def test_a_batch_lost_between_write_and_commit_is_repeated(spark, lake, tmp_path, monkeypatch):
    feed = str(tmp_path / "feed")
    write_days(spark, feed, DAYS)
    real, calls = versions.commit, []

    def once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*args)

    def run():
        stream = spark.readStream.schema("id string, team string, at int").option("maxFilesPerTrigger", 1).parquet(feed)
        newest = lambda df: df.filter("id IS NOT NULL").groupBy("id").agg(F.max_by("team", "at").alias("team"), F.max("at").alias("at"))
        start_upsert(stream, lake, "people", newest, ["id"], "at").awaitTermination()

    monkeypatch.setattr(versions, "commit", once)
    with pytest.raises(Exception, match="lost"):
        run()
    assert versions.current(spark, lake.silver("people")).batches == {"silver_people": 0}
    run()
    assert rows(read_table(spark, lake.silver("people")).select("id", "team", "at")) == NEWEST
    assert versions.current(spark, lake.silver("people")).batches == {"silver_people": 2}


def test_catalogue_by_folders_counts_in_footers(spark, lake):
    versions.publish(spark.range(12).repartition(3), lake.gold("own/one"))
    versions.publish(spark.range(5), lake.gold("own/two"))
    versions.publish(spark.range(2), lake.gold("own/two"), mode="append")
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(lake.gold("plain/three"))
    versions.publish(spark.range(1), lake.gold("gold_single"))
    got = {r["view_name"]: r for r in catalog.discovered_catalog(spark, lake).collect()}
    assert {n: (r["domain"], r["metric"], r["row_count"]) for n, r in got.items()} == {
        "own_one": ("own", "one", 12), "own_two": ("own", "two", 7), "plain_three": ("plain", "three", 4)}
    assert got["plain_three"]["signature"] == "plain_three(id bigint, p int)"
    assert catalog.discovered_catalog(spark, Lake(f"{lake.root}/none")).count() == 0
