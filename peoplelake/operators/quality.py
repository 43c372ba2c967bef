"""Data-quality report and gates."""

from __future__ import annotations

from dataclasses import dataclass, fields

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class QualityGateError(RuntimeError):
    """A blocking check failed."""


@dataclass(frozen=True)
class Thresholds:
    """Largest acceptable value of each check, and which checks block. Fixed values."""

    null_employee_id_pct: float = 0.0
    duplicate_employee_id_ratio: float = 0.0
    invalid_salary_pct: float = 0.10
    invalid_joining_date_pct: float = 0.10
    unknown_department_pct: float = 0.05
    raw_null_employee_id_pct: float = 0.01
    raw_duplicate_employee_id_ratio: float = 0.25
    blocking: tuple[str, ...] = ("null_employee_id_pct", "duplicate_employee_id_ratio")


# Check name -> column that must be present for it to run.
_NEEDS = {
    "null_employee_id_pct": "employee_id",
    "duplicate_employee_id_ratio": "employee_id",
    "invalid_salary_pct": "salary_valid",
    "invalid_joining_date_pct": "joining_date_valid",
    "unknown_department_pct": "department_canonical",
}


def _share(condition: Column) -> Column:
    """Fraction of all rows where the condition is true; null conditions count as no, an empty table as 0."""
    return F.coalesce(F.try_divide(F.count_if(condition), F.count(F.lit(1))), F.lit(0.0))


def quality_report(silver: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """All checks from one pass over the table, one row per check.

    ``count(distinct id)`` next to plain counts plans as: partial counts per id in the map tasks, one shuffle by id,
    then a global merge -- the table itself is read once and never cached.
    """
    rows = F.count(F.lit(1))
    measures = {
        "null_employee_id_pct": lambda: _share(F.col("employee_id").isNull()),
        "duplicate_employee_id_ratio": lambda: F.coalesce(
            1 - F.try_divide(
                F.count_distinct("employee_id") + F.max(F.col("employee_id").isNull().cast("int")), rows), F.lit(0.0)),
        "invalid_salary_pct": lambda: _share(~F.col("salary_valid")),
        "invalid_joining_date_pct": lambda: _share(~F.col("joining_date_valid")),
        "unknown_department_pct": lambda: _share(~F.col("department_canonical")),
    }
    names = [n for n in measures if _NEEDS[n] in silver.columns]
    wide = silver.agg(rows.alias("total_rows"), *[measures[n]().alias(n) for n in names])
    return _judged(wide.unpivot("total_rows", names, "name", "value"), thresholds)


class RawCounts:
    """What a cleaning pass saw and kept, counted while it ran: no scan of its own.

    Wrap the raw rows with :meth:`raw` and the cleaned ones, one per id, with :meth:`cleaned`; after the pass has been written,
    :meth:`report` has the shares that cleaning removed. A task that runs again after its output was lost counts again.
    """

    def __init__(self, key: str = "employee_id"):
        self.key = key
        self._seen, self._kept = Observation(), Observation()

    def raw(self, rows: DataFrame) -> DataFrame:
        return rows.observe(
            self._seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(self.key).isNull()).alias("without_key"))

    def cleaned(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._kept, F.count(F.lit(1)).alias("rows"))

    def report(self, spark: SparkSession, thresholds: Thresholds = Thresholds()) -> DataFrame:
        """Two rows in the shape of :func:`quality_report`; ids that come once each, a missing one included, are no duplicates."""
        seen, kept = _counted(self._seen), _counted(self._kept).get("rows", 0)
        rows, without = seen.get("rows", 0), seen.get("without_key", 0)
        values = {
            "raw_null_employee_id_pct": without / rows if rows else 0.0,
            "raw_duplicate_employee_id_ratio": 1 - (kept + (without > 0)) / rows if rows else 0.0,
        }
        return _judged(spark.createDataFrame(
            [(name, value, rows) for name, value in values.items()], "name string, value double, total_rows bigint"), thresholds)


def _counted(observation: Observation) -> dict[str, int]:
    """What was observed; nothing where the optimizer found the input to be empty and dropped the observation with it."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error):
            raise
        return {}


def _judged(long: DataFrame, thresholds: Thresholds) -> DataFrame:
    names = known_checks()
    limit = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(float(getattr(thresholds, n))))])
    return long.select(
        "name",
        "value",
        F.element_at(limit, F.col("name")).alias("threshold"),
        (F.col("value") <= F.element_at(limit, F.col("name"))).alias("passed"),
        F.col("name").isin(*thresholds.blocking).alias("blocking"),
        "total_rows",
    )


def failures(report: DataFrame, blocking_only: bool = False) -> DataFrame:
    failed = report.filter(~F.col("passed"))
    return failed.filter("blocking") if blocking_only else failed


def enforce(report: DataFrame) -> None:
    """Raise when a blocking check failed. The report has one row per check, so collecting it is bounded."""
    bad = failures(report, blocking_only=True).collect()
    if bad:
        raise QualityGateError("; ".join(f"{r['name']}={r['value']:.4f}" for r in bad))


def known_checks() -> tuple[str, ...]:
    """All checks; those that begin with ``raw_`` are counted while cleaning runs, see :class:`RawCounts`."""
    return tuple(f.name for f in fields(Thresholds) if f.name != "blocking")
