"""Aggregate building blocks shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money and hours are summed as decimals so that the total does not depend on the order in which partial sums
# arrive from the shuffle; sum(decimal(20,4)) has 30 digits, enough for 10^12 rows at the salary ceiling.
EXACT = "decimal(20,4)"


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded quotient; null (not an error) when there is nothing to divide by."""
    return F.round(F.try_divide(part, whole), digits)


def exact_sum(c: Column, digits: int = 2) -> Column:
    return F.round(F.sum(c.cast(EXACT)), digits).cast("double")


def exact_mean(c: Column, digits: int = 2) -> Column:
    return F.round(F.avg(c.cast(EXACT)), digits).cast("double")


def total_where(condition: Column, weight: Column) -> Column:
    """Weighted conditional count; null conditions count as no."""
    return F.sum(F.when(condition, weight).otherwise(0))


def bucket(c: Column, upper_bounds: tuple[tuple[float, str], ...], rest: str) -> Column:
    """First label whose upper bound lies above the value; ``rest`` beyond the last bound."""
    out = None
    for bound, label in upper_bounds:
        out = F.when(c < bound, label) if out is None else out.when(c < bound, label)
    return out.otherwise(rest)


def position_of(c: Column, labels: tuple[str, ...]) -> Column:
    """1-based place of a label in its natural order, for sorting buckets."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), c)
