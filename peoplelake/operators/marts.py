"""Parameterised aggregate operators. The workforce marts in ``plans.gold`` are bindings of these.

Count-style operators read a weight column ``n`` instead of counting rows, so the same operator runs on raw rows
(``n = 1``) or on rows that were already rolled up to cells.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.functions.cleaning import as_of_date
from peoplelake.functions.metrics import exact_mean, exact_sum, ratio, total_where
from peoplelake.operators.ranks import exact_quantiles

WEIGHT = "n"
# Sample points of the salary distributions. Fixed values.
PERCENTILES = {"median": 0.5, "p25": 0.25, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}


def snapshot(df: DataFrame, as_of: dt.date | str | None) -> DataFrame:
    return df.withColumn("snapshot_date", as_of_date(as_of))


def flag_split(
    df: DataFrame, by: Sequence[str], rate: tuple[str, str], flag: str = "attrition", weight: str = WEIGHT
) -> DataFrame:
    """Headcount, leavers and stayers per group, with ``rate = (name, numerator)`` as a share of the headcount.

    Rows with an undecided flag count in the headcount only. Groups with a missing key are left out.
    """
    n = F.col(weight)
    present = df.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in by))
    counts = present.groupBy(*by).agg(
        F.sum(n).alias("headcount"),
        total_where(F.col(flag) == "Yes", n).alias("attrited"),
        total_where(F.col(flag) == "No", n).alias("active"),
    )
    name, numerator = rate
    return counts.withColumn(name, ratio(F.col(numerator), F.col("headcount")))


def share_of_total(df: DataFrame, by: str, weight: str = WEIGHT) -> DataFrame:
    """Headcount per bucket and its share; the total is a window over the aggregated buckets, not a second scan."""
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.sum(weight).alias("headcount"))
    total = F.sum("headcount").over(Window.partitionBy())
    return counts.withColumn("share_pct", ratio(F.col("headcount"), total))


def period_counts(df: DataFrame, parts: Sequence[str], name: str, weight: str = WEIGHT) -> DataFrame:
    return df.filter(F.col(parts[0]).isNotNull()).groupBy(*parts).agg(F.sum(weight).alias(name))


def distribution(
    df: DataFrame,
    measure: str,
    by: Sequence[str] = (),
    *,
    points: Sequence[str] = ("median", "p25", "p75", "p90"),
    spread: bool = True,
    total: str | None = "total_payroll",
    count_name: str = "employees_with_salary",
    counts_path: str | None = None,
) -> DataFrame:
    """Count, mean, percentiles, standard deviation, extremes and total of a measure, per group or overall.

    Percentiles are exact at any size: :func:`exact_quantiles`, whose counted values are written to ``counts_path``. The
    small aggregates are a second scan of the same two columns.
    """
    valid = df.filter(F.col(measure).isNotNull()).select(*by, measure)
    m = F.col(measure)
    aggs = [F.count(F.lit(1)).alias(count_name), exact_mean(m).alias(f"avg_{measure}")]
    if spread:
        aggs.append(F.round(F.stddev(m), 2).alias(f"stddev_{measure}"))
    aggs += [F.round(F.min(m), 2).alias(f"min_{measure}"), F.round(F.max(m), 2).alias(f"max_{measure}")]
    if total:
        aggs.append(exact_sum(m).alias(total))
    grouped = valid.groupBy(*by).agg(*aggs)
    ranked = exact_quantiles(valid, measure, [PERCENTILES[p] for p in points], by, path=counts_path)
    both = grouped.unionByName(ranked.withColumnRenamed("q", "_q"), allowMissingColumns=True)
    grouped = both.groupBy(*by).agg(*[F.max(c).alias(c) for c in both.columns if c not in by])
    quantiles = {f"{p}_{measure}": F.round(F.col("_q")[i], 2) for i, p in enumerate(points)}
    lead = [*by, count_name, f"avg_{measure}"]
    return grouped.withColumns(quantiles).select(
        *lead, *quantiles, *[c for c in grouped.columns if c not in (*lead, "_q")]
    )


def leaderboard(df: DataFrame, metric: str, top_n: int, *, eligible: Column | None = None) -> DataFrame:
    """Dense rank on the (rounded) metric, best first; ties share a rank, so more than ``top_n`` rows may remain.

    The unpartitioned window is only ever applied to an aggregate with one row per group.
    """
    rows = df if eligible is None else df.filter(eligible)
    return rows.withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc(metric)))).filter(
        F.col("rank") <= top_n
    )


def funnel(
    df: DataFrame, dims: Sequence[str], stage: str, stages: Sequence[str], unit: str, conversion: tuple[str, str]
) -> DataFrame:
    """Distinct units per stage as one column per stage, and the conversion between two of them (0 without a base).

    Distinct (group, stage, unit) rows first, then a plain conditional count: two evenly keyed shuffles, no row
    expansion per stage and no separate pivot pass.
    """
    units = df.select(*dims, stage, unit).distinct()
    counted = units.groupBy(*dims).agg(
        *[F.count_if((F.col(stage) == s) & F.col(unit).isNotNull()).alias(s) for s in stages]
    )
    base, reached = conversion
    return counted.withColumn(
        f"{base}_to_hire_rate", F.coalesce(ratio(F.col(reached), F.nullif(F.col(base), F.lit(0))), F.lit(0.0))
    )


def funnel_long(df: DataFrame, dims: Sequence[str], stage: str, unit: str, amount: str) -> DataFrame:
    """Distinct units and mean amount per (group, stage) in long form."""
    return df.groupBy(*dims, stage).agg(
        F.count_distinct(unit).alias("applications"), exact_mean(F.col(amount)).alias("avg_offer")
    )


def left_join_aggregated(
    fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Additive measures of a fact table grouped by dimension attributes, aggregated *before* the join.

    The fact side first collapses to one row per (key, own group columns) with map-side partial sums. A key that owns
    a third of the facts therefore joins as one row, and the dimension is joined at key grain by whichever strategy
    its size allows. Facts without a dimension row stay, under null attributes.
    """
    own = [c for c in by if c in fact.columns]
    partial = fact.groupBy(key, *own).agg(*[c.alias(name) for name, c in sums.items()])
    joined = partial.join(dim.select(key, *[c for c in by if c not in own]), key, "left")
    return joined.groupBy(*by).agg(*[F.sum(name).alias(name) for name in sums])
