"""Dimension filters, KPI strips, profiles and small report shapes over marts and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.functions.text import plain


def filter_dimension(df: DataFrame, column: str, selection: Sequence[object] | None) -> DataFrame:
    """Rows whose dimension is selected; no selection, or a table without the column, means no filter."""
    return df.filter(F.col(column).isin(*selection)) if selection and column in df.columns else df


def dimension_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-blank values."""
    return df.select(column).filter(F.trim(column) != "").distinct().orderBy(column)


def best_by(label: str, metric: str, highest: bool = True) -> Column:
    """Label of the row with the highest (lowest) metric; equal metrics go to the first label, missing ones come last."""
    # min_by over (metric, label) in both directions keeps the tie-break ascending; in a struct, null would be the least.
    key = -F.col(metric) if highest else F.col(metric)
    return F.min_by(F.col(label), F.struct(key.isNull(), key, F.col(label).isNull(), F.col(label)))


def weighted_mean(value: str, weight: str, digits: int | None = None) -> Column:
    """Mean of group means, weighted by group size; 0 for an empty table.

    Means are taken to ten decimals and summed as decimals, so the result does not depend on the order of rows; of means with
    up to four decimals the quotient is one of whole numbers, so a mean that lies halfway is seen to do so.
    """
    total = F.sum(F.col(value).cast("decimal(22,10)") * F.col(weight).cast("decimal(12,0)"))
    whole = F.greatest(F.sum(F.col(weight)), F.lit(1)).cast("double") * 10000
    mean = F.coalesce((total * 10000).cast("double") / whole, F.lit(0.0))
    return mean if digits is None else F.round(mean, digits)


def percent_of(part: str, whole: str, digits: int = 2) -> Column:
    return F.coalesce(F.round(F.try_divide(F.sum(part) * 100, F.sum(whole)), digits), F.lit(0.0))


def attach(strip: DataFrame, **scalars: DataFrame) -> DataFrame:
    """Put one-row, one-column results next to a one-row strip as scalar subqueries."""
    return strip.select("*", *[frame.scalar().alias(name) for name, frame in scalars.items()])


def kpi_workforce(by_department: DataFrame, by_country: DataFrame, departments=None, countries=None) -> DataFrame:
    strip = filter_dimension(by_department, "department", departments).agg(
        F.sum("headcount").alias("headcount"),
        F.sum("active").alias("active"),
        F.count_distinct("department").alias("departments"),
    )
    shown = filter_dimension(by_country, "country", countries).agg(F.count_distinct("country"))
    return attach(strip, countries=shown)


def kpi_home(by_department: DataFrame, by_country: DataFrame, salary: DataFrame) -> DataFrame:
    strip = by_department.agg(
        F.sum("headcount").alias("total_employees"),
        F.count_distinct("department").alias("departments"),
        percent_of("attrited", "headcount").alias("attrition_pct"),
        F.sum("active").alias("active"),
        F.sum("attrited").alias("attrited"),
    )
    return attach(
        strip,
        countries=by_country.agg(F.count_distinct("country")),
        avg_salary=salary.select("avg_salary"),
        total_payroll=salary.select("total_payroll"),
    )


def kpi_salary(salary: DataFrame) -> DataFrame:
    return salary.select("avg_salary", "median_salary", "p90_salary", "total_payroll")


def kpi_attrition(by_department: DataFrame, departments=None) -> DataFrame:
    return filter_dimension(by_department, "department", departments).agg(
        F.sum("headcount").alias("headcount"),
        F.sum("attrited").alias("attrited"),
        percent_of("attrited", "headcount").alias("overall_rate_pct"),
        best_by("department", "attrition_rate").alias("highest_department"),
        F.max("attrition_rate").alias("highest_rate"),
        best_by("department", "attrition_rate", highest=False).alias("lowest_department"),
        F.min("attrition_rate").alias("lowest_rate"),
    )


def kpi_performance(by_department: DataFrame, departments=None) -> DataFrame:
    return filter_dimension(by_department, "department", departments).agg(
        F.sum("rated_employees").alias("rated_employees"),
        weighted_mean("avg_rating", "rated_employees", 2).alias("avg_rating"),
        F.sum("high_performers").alias("high_performers"),
        percent_of("high_performers", "rated_employees").alias("high_performer_pct"),
        best_by("department", "avg_rating").alias("top_department"),
        F.max("avg_rating").alias("top_rating"),
    )


def overview(by_department: DataFrame, salary: DataFrame, ratings: DataFrame) -> DataFrame:
    """One-row company snapshot across the workforce, pay and performance marts."""
    strip = by_department.agg(
        F.sum("headcount").alias("total_headcount"),
        F.sum("active").alias("total_active"),
        F.sum("attrited").alias("total_attrited"),
        F.count_distinct("department").alias("departments"),
        F.coalesce(F.try_divide(F.sum("attrited"), F.sum("headcount")), F.lit(0.0)).alias("attrition_rate"),
    )
    return attach(
        strip,
        avg_salary=salary.select("avg_salary"),
        median_salary=salary.select("median_salary"),
        total_payroll=salary.select("total_payroll"),
        avg_rating=ratings.agg(weighted_mean("avg_rating", "rated_employees")),
    )


def extremes(mart: DataFrame, label: str, metric: str, n: int = 3, ends: Mapping[str, bool] | None = None) -> DataFrame:
    """Top-``n`` and bottom-``n`` rows by a metric; each end is a bounded top-N, ties broken by label."""
    frames = []
    for end, highest in (ends or {"top": True, "bottom": False}).items():
        order = F.desc(metric) if highest else F.asc(metric)
        place = F.row_number().over(Window.orderBy(order, F.asc(label)))
        top = mart.select(label, metric).orderBy(order, F.asc(label)).limit(n)
        frames.append(top.select(F.lit(end).alias("end"), place.alias("place"), label, metric))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def yearly(hiring: DataFrame) -> DataFrame:
    return hiring.groupBy("hire_year").agg(F.sum("hires").alias("hires"))


def hiring_pulse(hiring: DataFrame) -> DataFrame:
    """Latest year against the one before, direction, peak year and total, from the yearly roll-up (a row per year)."""
    by_year = Window.orderBy("hire_year")
    years = yearly(hiring).withColumns({
        "prior_year": F.lag("hire_year").over(by_year), "prior_hires": F.lag("hires").over(by_year)
    })
    latest = lambda c: F.max_by(c, "hire_year")
    delta = latest("hires") - latest("prior_hires")
    return years.agg(
        F.count(F.lit(1)).alias("years"),
        F.max("hire_year").alias("latest_year"),
        latest("hires").alias("latest_hires"),
        latest("prior_year").alias("prior_year"),
        latest("prior_hires").alias("prior_hires"),
        F.when(delta > 0, "up").when(delta == 0, "flat").when(delta < 0, "down").alias("direction"),
        F.min_by("hire_year", F.struct(-F.col("hires"), F.col("hire_year"))).alias("peak_year"),
        F.max("hires").alias("peak_hires"),
        F.sum("hires").alias("total_hires"),
    )


def pay_gap(pay_by_rating: DataFrame) -> DataFrame:
    """Mean pay of the highest rating against the lowest: absolute and relative gap."""
    ends = pay_by_rating.agg(
        F.count(F.lit(1)).alias("ratings"),
        F.min("performance_rating").alias("low_rating"),
        F.max("performance_rating").alias("high_rating"),
        F.min_by("avg_salary", "performance_rating").alias("low_avg_salary"),
        F.max_by("avg_salary", "performance_rating").alias("high_avg_salary"),
    )
    gap = F.col("high_avg_salary") - F.col("low_avg_salary")
    return ends.withColumns({
        "gap": gap,
        "gap_pct": F.coalesce(F.try_divide(gap, F.col("low_avg_salary")) * 100, F.lit(0.0)),
        "direction": F.when(gap > 0, "more").otherwise("less"),
    })


def salary_spread(by_department: DataFrame) -> DataFrame:
    points = ["p25_salary", "median_salary", "p75_salary"]
    return by_department.select("department", *points).unpivot("department", points, "percentile", "salary")


def _column_class(name: str, kind: str) -> str:
    # Name parts that mark a date-like column.
    dated = any(k in name.lower() for k in ("date", "year", "month"))
    numeric = kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
    if kind in ("date", "timestamp", "timestamp_ntz") or dated:
        return "date"
    return "numeric" if numeric else "categorical"


def profile_columns(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: type, class, nulls, distinct values, smallest and largest value.

    By default one pass with mergeable distinct sketches. ``exact`` counts distinct values from (column, value) pairs:
    one evenly spread shuffle in which map-side aggregation has already folded every repeated value.
    """
    names = df.columns
    kinds = dict(df.dtypes)
    text = {n: plain(F.col(n), kinds[n]) if not kinds[n].startswith(("array", "struct", "map"))
            else F.to_json(n) for n in names}
    described = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(kinds[n]).alias("dtype"),
                                   F.lit(_column_class(n, kinds[n])).alias("class")) for n in names])
    if exact:
        cells = df.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("name"), text[n].alias("value")) for n in names])).alias("cell")).select("cell.*")
        values = cells.groupBy("name", "value").agg(F.count(F.lit(1)).alias("rows"))
        per_column = values.groupBy("name").agg(
            F.sum("rows").alias("rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("rows")).otherwise(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
    else:
        wide = df.select(*[text[n].alias(n) for n in names]).agg(F.array(*[
            F.struct(
                F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(n).isNull()).alias("nulls"),
                F.approx_count_distinct(n).alias("distinct_values"), F.min(n).alias("min_value"),
                F.max(n).alias("max_value"))
            for n in names]).alias("stats"))
        per_column = wide.select(F.explode("stats").alias("s")).select("s.*")
    kind_of = {key: F.create_map(*[x for n in names for x in (F.lit(n), F.lit(v(n)))]) for key, v in
               {"dtype": lambda n: kinds[n], "class": lambda n: _column_class(n, kinds[n])}.items()}
    return per_column.select(
        "name",
        F.element_at(kind_of["dtype"], F.col("name")).alias("dtype"),
        F.element_at(kind_of["class"], F.col("name")).alias("class"),
        "rows", "nulls", "distinct_values", "min_value", "max_value",
    )


def profile_dataset(df: DataFrame, key: str, group: str) -> DataFrame:
    """Raw-table summary in long form: rows, unique keys, repeated keys, distinct groups, nulls per column.

    Distinct keys come from per-key counts, so the table is shuffled once, already folded to one row per
    (task, key, group).
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *nulls)
    totals = per_key.agg(
        F.sum("_rows").alias("rows"),
        F.count(key).alias(f"unique_{key}"),
        (F.sum("_rows") - F.count(F.lit(1))).alias("duplicate_rows"),
        *[F.sum(f"nulls_{c}").alias(f"nulls_{c}") for c in df.columns],
    )
    strip = attach(totals, **{f"distinct_{group}": df.agg(F.count_distinct(group))})
    measures = strip.columns
    return strip.select([F.coalesce(F.col(c), F.lit(0)).alias(c) for c in measures]).unpivot(
        [], measures, "measure", "value"
    )


def result_summary(result: DataFrame, order: Sequence[Column], columns: int = 3, label: str = "SQL") -> DataFrame:
    """One line on a result: its first row's first fields and how many rows follow."""
    shown = result.columns[:columns]
    kinds = dict(result.dtypes)
    pairs = F.concat_ws(", ", *[
        F.concat(F.lit(c + "="), F.coalesce(plain(F.col(c), kinds[c]), F.lit("None"))) for c in shown])
    first = result.orderBy(*order).limit(1).select(pairs)
    counted = result.agg(F.count(F.lit(1)).alias("row_count"))
    lined = attach(counted, _first=first)
    more = F.when(F.col("row_count") > 1, F.concat(F.lit(" (+"), (F.col("row_count") - 1).cast("string"),
                                                   F.lit(" rows)"))).otherwise("")
    text = F.concat(F.lit(f"[{label}] "), F.col("_first"), more)
    return lined.select("row_count", F.when(F.col("row_count") > 0, text).otherwise("(no result)").alias("summary"))
