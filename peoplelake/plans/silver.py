"""Raw log to cleaned tables. Each plan is narrow apart from the one shuffle its deduplication needs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.functions import cleaning as fx
from peoplelake.functions.metrics import position_of
from peoplelake.operators.latest import latest_per_key

# Column order of the cleaned employee table, and the funnel stages in rank order.
EMPLOYEE_COLUMNS = (
    "employee_id", "name", "department", "department_raw", "department_canonical", "salary", "salary_raw",
    "salary_valid", "joining_date", "joining_date_raw", "joining_date_valid", "performance_rating", "manager",
    "attrition", "country", "skills", "skills_count", "experience_years", "ingest_ts", "ingest_date",
)
STAGES = ("applied", "screen", "interview", "offer", "hired", "rejected")
WEEKEND = (1, 7)


def trim_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fx.blank_to_null(F.col(c)) for c in columns})


def clean_department(df: DataFrame) -> DataFrame:
    """Canonical name, the text as it came, and whether the result is a known department (null for a missing one).

    An unknown name stays as it came, spacing included; blank text turns into null.
    """
    raw, key = F.col("department_raw"), F.col("_key")
    return (
        df.withColumns({"department_raw": F.col("department"), "_key": fx.folded(F.col("department"))})
        .withColumn("department", F.when(key != "", fx.department_of(key, raw)))
        .withColumn("department_canonical", F.col("department").isin(*fx.DEPARTMENTS))
        .drop("_key")
    )


def clean_salary(df: DataFrame) -> DataFrame:
    return (
        df.withColumns({"salary_raw": F.col("salary"), "_text": fx.folded(F.col("salary"))})
        .withColumn("salary", fx.salary_amount(F.col("_text")))
        .withColumn("salary", fx.null_outside(F.col("salary"), fx.SALARY_RANGE))
        .withColumn("salary_valid", F.col("salary").isNotNull())
        .drop("_text")
    )


def clean_joining_date(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    return (
        df.withColumns({"joining_date_raw": F.col("joining_date"), "joining_date": fx.iso_day(F.col("joining_date"))})
        .withColumn("joining_date", fx.plausible_day(F.col("joining_date"), as_of))
        .withColumn("joining_date_valid", F.col("joining_date").isNotNull())
    )


def clean_attrition(df: DataFrame) -> DataFrame:
    return df.withColumn("attrition", fx.folded(F.col("attrition"))).withColumn(
        "attrition", fx.yes_no_of(F.col("attrition"))
    )


def clean_country(df: DataFrame, preserve_acronyms: bool = False) -> DataFrame:
    """Country in title case. With ``preserve_acronyms``, names of two or three capitals (USA, UK) stay as they are."""
    titled, as_is = fx.title_case(F.col("country")), F.trim("country")
    if preserve_acronyms:
        titled = F.when(as_is.rlike(r"^\p{Lu}{2,3}$"), as_is).otherwise(titled)
    return df.withColumn("country", titled)


def clean_skills(df: DataFrame) -> DataFrame:
    return df.withColumn("skills", fx.distinct_sorted(F.col("skills"))).withColumn(
        "skills_count", fx.length_or_zero(F.col("skills"))
    )


def clean_ranges(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "performance_rating": fx.whole_number_within(F.col("performance_rating"), fx.RATING_RANGE),
        "experience_years": fx.whole_number_within(F.col("experience"), fx.EXPERIENCE_RANGE),
    })


def newest_employees(raw: DataFrame) -> DataFrame:
    """Latest delivery per employee by ingest time, then log offset; rows without an id are dropped."""
    return latest_per_key(raw.filter(F.col("employee_id").isNotNull()), ["employee_id"], ["ingest_ts", "offset"])


def keep_employee_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in EMPLOYEE_COLUMNS if c in df.columns])


def silver_employees(
    raw: DataFrame, as_of: dt.date | str | None = None, *, preserve_acronyms: bool = False
) -> DataFrame:
    """Cleaned employee snapshot.

    Deduplication runs first, on the untouched rows: cleaning is per-row and leaves key and order columns alone, so
    the result is the same and superseded deliveries never pay for regex work.
    """
    return keep_employee_columns(
        newest_employees(raw)
        .transform(trim_text, ["name", "manager", "country"])
        .transform(clean_department)
        .transform(clean_salary)
        .transform(clean_joining_date, as_of)
        .transform(clean_attrition)
        .transform(clean_country, preserve_acronyms)
        .transform(clean_skills)
        .transform(clean_ranges)
    )


def silver_attendance(raw: DataFrame) -> DataFrame:
    """One row per attendance id with plausible hours, weekday tags and a lower-case status."""
    usable = raw.filter(F.col("employee_id").isNotNull() & F.col("work_date").isNotNull())
    weekday = F.dayofweek("work_date")
    return latest_per_key(usable, ["attendance_id"], ["event_ts"]).withColumns({
        "hours_worked": fx.null_outside(F.col("hours_worked"), fx.HOURS_RANGE),
        "dow": weekday,
        "is_weekend": weekday.isin(*WEEKEND),
        "status": F.lower("status"),
    })


def silver_performance(raw: DataFrame) -> DataFrame:
    """One row per review with a 1..5 rating; negative goal percentages count as zero, missing ones stay missing."""
    usable = raw.filter(F.col("employee_id").isNotNull() & F.col("rating").between(*fx.RATING_RANGE))
    goals = F.col("goals_met_pct")
    return latest_per_key(usable, ["review_id"], ["event_ts"]).withColumns({
        "goals_met_pct": F.when(goals < 0, 0.0).otherwise(goals),
        "is_high_performer": F.col("rating") >= 4,
    })


def silver_recruitment(raw: DataFrame) -> DataFrame:
    """One row per application and stage, known stages only, ranked along the funnel.

    The stage is part of the key, so filtering it before the deduplication shrinks the shuffle without changing rows.
    """
    usable = raw.filter(F.col("application_id").isNotNull() & F.col("stage").isin(*STAGES))
    return latest_per_key(usable, ["application_id", "stage"], ["event_ts"]).withColumn(
        "stage_rank", position_of(F.col("stage"), STAGES).cast("int")
    )


def tenure_days(employees: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Days from hire to termination, or to the reporting day for people still employed."""
    until = F.coalesce(F.col("termination_date"), fx.as_of_date(as_of))
    return employees.withColumn("tenure_days", F.datediff(until, F.col("hire_date")))
