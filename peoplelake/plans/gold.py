"""The registered workforce marts, the four detail marts on fact tables, and the build job over the registry."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.functions.cleaning import as_of_date
from peoplelake.functions.metrics import EXACT, bucket, position_of, ratio, total_where
from peoplelake.operators import marts as op
from peoplelake.plans.silver import STAGES
from peoplelake.session import discard, scratch_path
from peoplelake.sources import versions
from peoplelake.sources.lake import Lake, read_table, write_table

AsOf = dt.date | str | None
# Bucket bounds (exclusive, in years) and labels.
TENURE_BOUNDS = ((1, "0-1y"), (3, "1-3y"), (5, "3-5y"), (10, "5-10y"))
TENURE_BUCKETS = ("0-1y", "1-3y", "3-5y", "5-10y", "10y+")
EXPERIENCE_BOUNDS = ((2, "0-2y"), (5, "2-5y"), (10, "5-10y"), (20, "10-20y"))
EXPERIENCE_BUCKETS = ("0-2y", "2-5y", "5-10y", "10-20y", "20y+")
HIGH_RATING, LOW_RATING = 4, 2
TOP_N, MIN_TEAM_SIZE = 5, 5

# What the count marts group by. Each set is aggregated on its own, so the cells stay a few hundred rows however sparse
# the combinations of all dimensions are.
CELL_SETS = {
    "department": ("department", "performance_rating", "attrition"),
    "country": ("country", "attrition"),
    "month": ("hire_year", "hire_month", "attrition"),
    "tenure": ("tenure_bucket", "attrition"),
    "experience": ("experience_bucket",),
}
CELL_KEYS = tuple(dict.fromkeys(key for keys in CELL_SETS.values() for key in keys))


def dimension_frame(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Employees reduced to what the count marts group by, one row each (``n = 1``)."""
    joined, years = F.col("joining_date"), F.col("experience_years")
    tenure = F.months_between(as_of_date(as_of), joined) / 12
    return silver.select(
        "department",
        "country",
        F.year(joined).alias("hire_year"),
        F.month(joined).alias("hire_month"),
        F.when(joined.isNotNull(), bucket(tenure, TENURE_BOUNDS, TENURE_BUCKETS[-1])).alias("tenure_bucket"),
        F.when(years.isNotNull(), bucket(years, EXPERIENCE_BOUNDS, EXPERIENCE_BUCKETS[-1])).alias("experience_bucket"),
        "performance_rating",
        "attrition",
        F.lit(1).cast("bigint").alias(op.WEIGHT),
    )


def cells(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One pass over the employees down to counted cells, ``cell_set`` telling which dimensions a cell has.

    Grouping sets fold into the map-side hash aggregate, so what is shuffled is a few hundred rows per task.
    """
    counted = dimension_frame(silver, as_of).groupingSets(list(map(list, CELL_SETS.values())), *CELL_KEYS).agg(
        F.sum(op.WEIGHT).alias(op.WEIGHT), F.grouping_id().alias("_absent")
    )
    # grouping_id has a bit per key, set where the key is not part of the set.
    absent = {name: sum(1 << i for i, k in enumerate(reversed(CELL_KEYS)) if k not in keys) for name, keys in CELL_SETS.items()}
    label = F.coalesce(*[F.when(F.col("_absent") == bits, F.lit(name)) for name, bits in absent.items()])
    return counted.withColumn("cell_set", label).drop("_absent")


# -- count marts: functions of a dimension frame or of its cells ------------------------------------------------------
def _attrition(by: str, order: Callable[[], list]) -> Callable[[DataFrame, AsOf], DataFrame]:
    def mart(frame: DataFrame, as_of: AsOf) -> DataFrame:
        return op.snapshot(op.flag_split(frame, [by], ("attrition_rate", "attrited")), as_of).orderBy(*order())

    return mart


def _headcount(by: str) -> Callable[[DataFrame, AsOf], DataFrame]:
    def mart(frame: DataFrame, as_of: AsOf) -> DataFrame:
        split = op.flag_split(frame, [by], ("active_pct", "active"))
        ordered = split.select(by, "headcount", "active", "attrited", "active_pct")
        return op.snapshot(ordered, as_of).orderBy(F.desc("headcount"), by)

    return mart


def _experience(frame: DataFrame, as_of: AsOf) -> DataFrame:
    shares = op.snapshot(op.share_of_total(frame, "experience_bucket"), as_of)
    return shares.orderBy(position_of(F.col("experience_bucket"), EXPERIENCE_BUCKETS))


def _hiring(frame: DataFrame, as_of: AsOf) -> DataFrame:
    months = op.period_counts(frame, ["hire_year", "hire_month"], "hires")
    label = F.format_string("%04d-%02d", "hire_year", "hire_month")
    return op.snapshot(months.withColumn("year_month", label), as_of).orderBy("hire_year", "hire_month")


def _ratings(frame: DataFrame, as_of: AsOf) -> DataFrame:
    rating, n = F.col("performance_rating"), F.col(op.WEIGHT)
    counts = (
        frame.filter(rating.isNotNull())
        .groupBy("department")
        .agg(
            F.sum(n).alias("rated_employees"),
            F.round(F.try_divide(F.sum(rating * n), F.sum(n)), 2).alias("avg_rating"),
            total_where(rating >= HIGH_RATING, n).alias("high_performers"),
            total_where(rating <= LOW_RATING, n).alias("low_performers"),
        )
    )
    shares = counts.withColumns({
        "high_performer_pct": ratio(F.col("high_performers"), F.col("rated_employees")),
        "low_performer_pct": ratio(F.col("low_performers"), F.col("rated_employees")),
    })
    return op.snapshot(shares, as_of).orderBy(F.desc("avg_rating"), "department")


def _top_teams(frame: DataFrame, as_of: AsOf, *, min_team_size: int = MIN_TEAM_SIZE, top_n: int = TOP_N) -> DataFrame:
    board = op.leaderboard(
        _ratings(frame, as_of), "avg_rating", top_n, eligible=F.col("rated_employees") >= min_team_size
    )
    return board.select(
        "rank", "department", "avg_rating", "rated_employees", "high_performer_pct", "snapshot_date"
    ).orderBy("rank", "department")


# -- pay marts: functions of the employee rows -------------------------------------------------------------------------
def salary_by_department(silver: DataFrame, as_of: AsOf = None, counts_path: str | None = None) -> DataFrame:
    stats = op.distribution(silver, "salary", ["department"], counts_path=counts_path)
    return op.snapshot(stats, as_of).orderBy(F.desc("avg_salary"), "department")


def salary_top_paying(
    silver: DataFrame, as_of: AsOf = None, counts_path: str | None = None, top_n: int = TOP_N
) -> DataFrame:
    return top_paying_of(salary_by_department(silver, as_of, counts_path), top_n)


def top_paying_of(by_department: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """The leaderboard of an already built ``salary/by_department``."""
    return op.leaderboard(by_department, "avg_salary", top_n).select(
        "rank", "department", "avg_salary", "median_salary", "employees_with_salary", "total_payroll", "snapshot_date"
    ).orderBy("rank", "department")


def salary_distribution(silver: DataFrame, as_of: AsOf = None, counts_path: str | None = None) -> DataFrame:
    return op.snapshot(op.distribution(silver, "salary", points=tuple(op.PERCENTILES), counts_path=counts_path), as_of)


def pay_by_rating(silver: DataFrame, as_of: AsOf = None, counts_path: str | None = None) -> DataFrame:
    stats = op.distribution(
        silver.filter(F.col("performance_rating").isNotNull()),
        "salary",
        ["performance_rating"],
        points=("median",),
        spread=False,
        total=None,
        count_name="employees",
        counts_path=counts_path,
    )
    return op.snapshot(stats, as_of).orderBy("performance_rating")


# -- registry -----------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Mart:
    """A registered mart. Count marts name the cell set they roll up, the others read employee rows."""

    domain: str
    metric: str
    fn: Callable[..., DataFrame]
    required: tuple[str, ...]
    cell_set: str | None = None

    @property
    def name(self) -> str:
        return f"{self.domain}/{self.metric}"

    @property
    def view(self) -> str:
        return f"{self.domain}_{self.metric}"

    def build(self, silver: DataFrame, as_of: AsOf = None, **options) -> DataFrame:
        """The mart straight from the cleaned employees."""
        return self.fn(dimension_frame(silver, as_of) if self.cell_set else silver, as_of, **options)

    def build_from_cells(self, counted: DataFrame, as_of: AsOf = None) -> DataFrame:
        """The same mart rolled up from the shared cells."""
        return self.fn(counted.filter(F.col("cell_set") == self.cell_set), as_of)


def _worst_first(by: str):
    return lambda: [F.desc("attrition_rate"), F.col(by)]


# Names, columns and order of the registered marts.
_RATE = ("headcount", "attrition_rate")
_SPLIT = ("headcount", "attrited", "active")
MARTS: tuple[Mart, ...] = (
    Mart("attrition", "by_department", _attrition("department", _worst_first("department")),
         ("department", *_SPLIT, "attrition_rate"), "department"),
    Mart("attrition", "by_country", _attrition("country", _worst_first("country")),
         ("country", *_SPLIT, "attrition_rate"), "country"),
    Mart("attrition", "trend_by_cohort", _attrition("hire_year", lambda: [F.col("hire_year")]),
         ("hire_year", *_RATE), "month"),
    Mart("attrition", "by_tenure_bucket",
         _attrition("tenure_bucket", lambda: [position_of(F.col("tenure_bucket"), TENURE_BUCKETS)]),
         ("tenure_bucket", *_RATE), "tenure"),
    Mart("salary", "by_department", salary_by_department,
         ("department", "avg_salary", "median_salary", "p25_salary", "p75_salary", "stddev_salary", "total_payroll")),
    Mart("salary", "top_paying_depts", salary_top_paying, ("rank", "department", "avg_salary")),
    Mart("salary", "distribution", salary_distribution, ("avg_salary", "median_salary", "p95_salary", "p99_salary")),
    Mart("workforce", "by_country", _headcount("country"), ("country", *_SPLIT), "country"),
    Mart("workforce", "by_department", _headcount("department"), ("department", *_SPLIT), "department"),
    Mart("workforce", "experience_distribution", _experience, ("experience_bucket", "headcount", "share_pct"), "experience"),
    Mart("workforce", "hiring_trends", _hiring, ("hire_year", "hire_month", "hires"), "month"),
    Mart("performance", "by_department", _ratings,
         ("department", "rated_employees", "avg_rating", "high_performers", "high_performer_pct"), "department"),
    Mart("performance", "top_teams", _top_teams, ("rank", "department", "avg_rating"), "department"),
    Mart("performance", "vs_salary", pay_by_rating,
         ("performance_rating", "employees", "avg_salary", "median_salary")),
)
BY_NAME = {m.name: m for m in MARTS}


def select_marts(names: Sequence[str] | None = None, registry: Sequence[Mart] = MARTS) -> list[Mart]:
    """Registered marts, all or the named ones; an unknown name is an error."""
    if not names:
        return list(registry)
    unknown = sorted(set(names) - {m.name for m in registry})
    if unknown:
        raise ValueError(f"unknown marts: {unknown}")
    return [m for m in registry if m.name in set(names)]


# -- validation and build -----------------------------------------------------------------------------------------------
VALIDATION_DDL = "mart string, rows bigint, columns int, passed boolean, detail string"


def validation_row(name: str, df: DataFrame, required: Sequence[str], min_rows: int = 0) -> DataFrame:
    """Structural check of one mart as a one-row frame: row count, emptiness, missing columns."""
    missing = [c for c in required if c not in df.columns]
    rows = F.col("rows")
    issues = F.array_compact(F.array(
        F.when(rows < min_rows, F.concat(F.lit("too_few_rows="), rows.cast("string"), F.lit(f"<{min_rows}"))),
        F.when((rows == 0) & F.lit(min_rows == 0), "empty_mart"),
        F.lit(f"missing_columns={missing}" if missing else None).cast("string"),
    ))
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(
        F.lit(name).alias("mart"),
        rows,
        F.lit(len(df.columns)).alias("columns"),
        (F.size(issues) == 0).alias("passed"),
        F.when(F.size(issues) == 0, "ok").otherwise(F.array_join(issues, "; ")).alias("detail"),
    )


def write_cells(silver: DataFrame, path: str, as_of: AsOf = None) -> DataFrame:
    """Cells as a written table in the shared folder: read many times, survives lost executors, recomputed never."""
    cells(silver, as_of).write.mode("overwrite").parquet(path)
    return silver.sparkSession.read.parquet(path)


def build_all(
    silver: DataFrame,
    lake: Lake,
    as_of: AsOf = None,
    *,
    names: Sequence[str] | None = None,
    registry: Sequence[Mart] = MARTS,
    mode: str = "overwrite",
    files: int = 1,
    strict: bool = False,
    concurrent_marts: int = 8,
) -> DataFrame:
    """Build, write and validate the selected marts; returns one status row per mart.

    The employee table is scanned once for all count marts (through their cells) and once per pay mart, with only the
    pay columns read; the pay leaderboard is derived from the mart already written. A mart that fails is reported and
    does not stop the others. Marts are tiny, so each is written as ``files`` file(s) and validated from that file.
    """
    spark = silver.sparkSession
    chosen = select_marts(names, registry)
    scratch = scratch_path(spark, "gold-build")
    base: dict[str, DataFrame] = {}

    def shared_cells() -> DataFrame | Exception:
        try:
            return write_cells(silver, f"{scratch}/cells", as_of)
        except Exception as error:  # reported by each mart that needs the cells
            return error

    counted = shared_cells() if any(m.cell_set for m in chosen) else None
    with_base = PAY_BASE in {m.name for m in chosen}

    def frame_of(mart: Mart) -> DataFrame:
        if mart.cell_set:
            if isinstance(counted, Exception):
                raise counted
            return mart.build_from_cells(counted, as_of)
        if mart.name == LEADERBOARD and with_base:
            if PAY_BASE not in base:
                raise RuntimeError(f"{PAY_BASE} failed")
            return top_paying_of(base[PAY_BASE])
        return mart.fn(silver, as_of, counts_path=f"{scratch}/counts/{mart.name}") if mart.fn in _PAY else mart.fn(silver, as_of)

    def build_one(mart: Mart) -> DataFrame:
        # this run's rows are written once aside, then published: an appended table also holds earlier snapshots, which
        # are neither ranked nor validated again
        write_table(frame_of(mart).coalesce(max(1, files)), f"{scratch}/{mart.name}")
        own = read_table(spark, f"{scratch}/{mart.name}")
        versions.publish(own.coalesce(max(1, files)), lake.gold(mart.name), mode=mode)
        base[mart.name] = own
        row = validation_row(mart.name, own, mart.required).first()
        return spark.createDataFrame([tuple(row)], VALIDATION_DDL)

    def attempt(mart: Mart) -> DataFrame:
        try:
            return build_one(mart).withColumn("status", F.lit("written"))
        except Exception as error:  # isolation: a failing mart is a status row, not the end of the job
            row = (mart.name, None, None, False, f"{type(error).__name__}: {error}")
            return spark.createDataFrame([row], VALIDATION_DDL).withColumn("status", F.lit("failed"))

    # Marts are independent small jobs: submitting a few at a time keeps the cluster busy between their tiny stages.
    with ThreadPoolExecutor(concurrent_marts) as pool:
        first = list(pool.map(attempt, [m for m in chosen if m.name != LEADERBOARD]))
    rows = first + [attempt(m) for m in chosen if m.name == LEADERBOARD]
    status = reduce(DataFrame.unionByName, rows)
    discard(spark, scratch)
    if strict:
        bad = [r["mart"] for r in status.filter(~F.col("passed")).select("mart").collect()]
        if bad:
            raise RuntimeError(f"mart validation failed: {sorted(bad)}")
    return status


LEADERBOARD, PAY_BASE = "salary/top_paying_depts", "salary/by_department"
_PAY = (salary_by_department, salary_top_paying, salary_distribution, pay_by_rating)


def load_mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    """A written mart, or None when it is not there (consumers skip missing marts)."""
    try:
        return read_table(spark, lake.gold(name))
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


# -- detail marts on the HRIS employee table and the fact tables ---------------------------------------------------------
def headcount(current: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Current employees by department and location; expects ``is_active``, ``base_salary`` and ``tenure_days``."""
    counts = current.groupBy("department", "location").agg(
        F.count(F.lit(1)).alias("headcount"),
        F.count_if(F.col("is_active")).alias("active_headcount"),
        F.count_if(~F.col("is_active")).alias("attrition_count"),
        op.exact_mean(F.col("base_salary")).alias("avg_salary"),
        F.round(F.avg("tenure_days") / 365.0, 2).alias("avg_tenure_years"),
    )
    return op.snapshot(counts.withColumn("attrition_rate", ratio(F.col("attrition_count"), F.col("headcount"))), as_of)


def _mean_of(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.col(total), F.col(count)), 2).cast("double")


def attendance_compliance(attendance: DataFrame, current: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Attendance status counts, lateness and mean hours by department and location."""
    hours = F.col("hours_worked")
    sums = {"total_records": F.count(F.lit(1))}
    for status, name in (("present", "present_days"), ("absent", "absent_days"), ("leave", "leave_days"),
                         ("wfh", "wfh_days")):
        sums[name] = F.count_if(F.col("status") == status)
    sums |= {
        "late_count": F.count_if(F.col("is_late")),
        "_hours": F.sum(hours.cast(EXACT)),
        "_timed": F.count(hours),
    }
    totals = op.left_join_aggregated(attendance, current, "employee_id", ["department", "location"], sums)
    out = totals.withColumns({
        "avg_hours_worked": _mean_of("_hours", "_timed"),
        "attendance_rate": ratio(F.col("present_days"), F.col("total_records")),
    })
    return op.snapshot(out.drop("_hours", "_timed"), as_of)


def review_outcomes(reviews: DataFrame, current: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Review counts, mean rating, promotions, goals and bonus by department and cycle."""
    goals, bonus = F.col("goals_met_pct"), F.col("bonus_amount")
    sums = {
        "reviews": F.count(F.lit(1)),
        "_rating": F.sum("rating"),
        "high_performers": F.count_if(F.col("is_high_performer")),
        "promotions": F.count_if(F.col("promotion_flag")),
        "_goals": F.sum(goals.cast(EXACT)),
        "_with_goals": F.count(goals),
        "_bonus": F.sum(bonus.cast(EXACT)),
    }
    totals = op.left_join_aggregated(reviews, current, "employee_id", ["department", "cycle"], sums)
    out = totals.select(
        "department",
        "cycle",
        "reviews",
        _mean_of("_rating", "reviews").alias("avg_rating"),
        "high_performers",
        "promotions",
        _mean_of("_goals", "_with_goals").alias("avg_goals_met_pct"),
        F.round("_bonus", 2).cast("double").alias("total_bonus"),
        ratio(F.col("high_performers"), F.col("reviews")).alias("hp_share"),
    )
    return op.snapshot(out, as_of)


def recruitment_funnel(applications: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Distinct applications per stage by department and source, with the offer-to-hire rate."""
    stages = op.funnel(applications, ["department", "source"], "stage", STAGES, "application_id", ("offer", "hired"))
    return op.snapshot(stages, as_of)
