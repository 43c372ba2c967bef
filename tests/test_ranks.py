"""Exact quantiles against sorted lists, at sizes where samples and sketches differ from run to run."""

import math
import random

import pytest
from pyspark.sql import functions as F

from peoplelake.operators import marts
from peoplelake.operators.ranks import exact_quantiles, value_counts

POINTS = (0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0)


def plain(values):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    n = len(values)
    return [values[max(1, n - math.floor(n - p * n)) - 1] for p in POINTS] if n else None


def test_groups_ties_nulls_and_a_null_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, float("nan"), 1.0, rng.randint(0, 40) / 4])) for _ in range(3000)]
    rows += [("one", 5.0), ("none", None), ("two", -0.5), ("two", 7.0)] + [("hot", 3.0)] * 2000
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r["g"]: r["q"] for r in exact_quantiles(df, "v", POINTS, ["g"]).collect()}
    want = {g: plain([v for k, v in rows if k == g]) for g in {k for k, _ in rows}}
    assert got == {g: q for g, q in want.items() if q}
    assert [r["q"] for r in exact_quantiles(df, "v", POINTS).collect()] == [plain([v for _, v in rows])]
    assert exact_quantiles(df.limit(0), "v", POINTS, ["g"]).count() == 0
    assert [r["q"] for r in exact_quantiles(df.limit(0), "v", POINTS).collect()] == [[None] * len(POINTS)]


def test_a_million_values_twice(spark, tmp_path):
    """Far more values than a sketch holds; a third of them equal, in one group that no task sees whole."""
    wide = spark.range(1_000_000).select(
        F.when(F.col("id") % 10 == 9, "small").otherwise("large").alias("g"),
        F.when(F.col("id") % 3 == 0, 500.25).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 100).alias("v"))
    counts = value_counts(wide, "v", ["g"], str(tmp_path / "counts"))
    assert counts.filter("g = 'large'").select("part").distinct().count() > 1
    assert counts.groupBy("g", "value").count().filter("count > 1").isEmpty()
    runs = [{r["g"]: r["q"] for r in exact_quantiles(df, "v", POINTS, ["g"]).collect()} for df in (wide, wide.repartition(5))]
    values = {}
    for r in wide.toLocalIterator():
        values.setdefault(r["g"], []).append(r["v"])
    assert runs[0] == runs[1] == {g: plain(v) for g, v in values.items()}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_distribution_carries_exact_points(spark, by):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 100_003).cast("double").alias("salary"))
    got = marts.distribution(df, "salary", by, points=tuple(marts.PERCENTILES)).collect()
    rows = df.collect()
    for r in got:
        values = sorted(x["salary"] for x in rows if not by or x["g"] == r["g"])
        for name, p in marts.PERCENTILES.items():
            assert r[f"{name}_salary"] == values[max(1, len(values) - math.floor(len(values) - p * len(values))) - 1]
