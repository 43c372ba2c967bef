"""Next rows over range partitions: validity intervals and offset gaps against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from peoplelake.operators.latest import mark_current
from peoplelake.operators.sequences import offset_gaps, version_intervals, with_next


def plain(rows):
    out = []
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for i, r in enumerate(own):
            last = i + 1 == len(own)
            out.append((*r, r[1], None if last or key is None else own[i + 1][1], last and key is not None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_intervals_of_a_hot_key_ties_and_copies(spark, partitions):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(300), "v") for _ in range(900)] + [(f"k{rng.randrange(200)}", rng.randrange(9), rng.choice("ab"))
                                                                     for _ in range(1200)]
    rows += [("hot", 7, "v")] * 300 + [(None, 1, "x"), (None, 2, "x"), ("t", None, "n"), ("t", 3, "n"), ("t", 3, "m")]
    df = spark.createDataFrame(rows, "k string, ts int, v string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = version_intervals(df, "k", "ts").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows)
    flagged = mark_current(df, "k", "ts").filter("is_current")
    assert sorted(map(tuple, flagged.select("k", "ts", "v").collect())) == sorted(
        (r["k"], r["ts"], r["v"]) for r in got if r["is_current"])


def test_a_hot_key_is_cut_over_tasks(spark, tmp_path):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).alias("ts"))
    path = str(tmp_path / "sorted")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_next(df, ["k"], ["ts"], "ts", path=path)
        assert got.filter("k = 'hot' AND NOT next_there").count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert spark.read.parquet(path).filter("k = 'hot'").select("_part").distinct().count() > 1


def test_clashing_names_empty_tables_and_time_columns(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, True)], "k string, ts int, is_current boolean")
    assert sorted(map(tuple, version_intervals(df, "k", "ts").collect())) == [("a", 1, 1, 2, False), ("a", 2, 2, None, True)]
    assert version_intervals(df.limit(0), "k", "ts").count() == 0


def test_gaps(spark):
    rng = random.Random(5)
    rows = [(t, p, o) for t in "ab" for p in range(3) for o in range(500) if rng.random() < 0.7]
    rows += rows[:100] + [("a", 0, None), (None, 0, 9), ("single", 0, 4)]
    got = offset_gaps(spark.createDataFrame(rows, "topic string, partition int, offset bigint").repartition(6)).collect()
    want = []
    for key in {r[:2] for r in rows}:
        own = sorted({r[2] for r in rows if r[:2] == key and r[2] is not None and r[0]})
        want += [(*key, a + 1, b - 1, b - a - 1) for a, b in zip(own, own[1:]) if b > a + 1]
    assert sorted(map(tuple, got)) == sorted(want) and want
