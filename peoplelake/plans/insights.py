"""Narrative insight rows: marts rendered into text chunks with stable ids and metadata."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from peoplelake.functions.text import quoted, render, render_sql, stable_id_sql
from peoplelake.operators import reports, retrieval
from peoplelake.plans.gold import EXPERIENCE_BUCKETS

LOG = logging.getLogger(__name__)
Marts = Mapping[str, DataFrame | None]
CHUNK_COLUMNS = ("chunk_id", "text", "domain", "metric", "source_mart", "kind", "snapshot_date", "metadata")


@dataclass(frozen=True)
class RowInsight:
    """One chunk per mart row. ``key`` names the id segments, ``extras`` the metadata taken from the row."""

    domain: str
    metric: str
    key: Mapping[str, str]
    extras: tuple[str, ...]
    text: str


@dataclass(frozen=True)
class Listing:
    """The first ``n`` rows in some order, one item each, joined. ``last_of`` takes them from the end of that order."""

    item: str
    by: tuple[tuple[str, bool], ...]  # (column, descending)
    sep: str
    n: int | None = None
    last_of: bool = False


@dataclass(frozen=True)
class Summary:
    """One chunk per mart from its totals and listings; ``shape`` may reshape the mart to one row first."""

    domain: str
    metric: str
    text: str
    totals: Mapping[str, str] = field(default_factory=dict)
    lists: Mapping[str, Listing] = field(default_factory=dict)
    shape: Callable[[DataFrame], DataFrame] | None = None
    present: str = "groups > 0"
    extras: tuple[str, ...] = ()
    source: str | None = None  # mart to read when it differs from domain/metric
    id_tail: tuple[str, ...] = ("summary",)


def _top(column: str, label: str) -> tuple[tuple[str, bool], ...]:
    return ((column, True), (label, False))


def _low(column: str, label: str) -> tuple[tuple[str, bool], ...]:
    return ((column, False), (label, False))


# The wording of every chunk, as templates over mart columns.
ROW_INSIGHTS = (
    RowInsight(
        "attrition", "by_department", {"dept": "department"}, ("department", "attrition_rate", "headcount"),
        "In the {department} department, total headcount is {headcount:int} employees, with {attrited:int} who have "
        "left and {active:int} still active. The attrition rate is {attrition_rate:pct}.",
    ),
    RowInsight(
        "attrition", "by_country", {"country": "country"}, ("country", "attrition_rate", "headcount"),
        "In {country}, headcount is {headcount:int} with {attrited:int} attritions, giving an attrition rate of "
        "{attrition_rate:pct}.",
    ),
    RowInsight(
        "attrition", "trend_by_cohort", {"year": "hire_year"}, ("hire_year", "attrition_rate"),
        "Employees who joined in {hire_year:int}: {headcount:int} hired, {attrited:int} have since left "
        "(attrition rate {attrition_rate:pct}).",
    ),
    RowInsight(
        "attrition", "by_tenure_bucket", {"bucket": "tenure_bucket"}, ("tenure_bucket", "attrition_rate"),
        "For employees with {tenure_bucket} of tenure, headcount is {headcount:int} and attrition rate is "
        "{attrition_rate:pct}.",
    ),
    RowInsight(
        "salary", "by_department", {"dept": "department"}, ("department", "avg_salary", "total_payroll"),
        "Salary in the {department} department: average {avg_salary:money}, median {median_salary:money}, "
        "P25 {p25_salary:money}, P75 {p75_salary:money}, P90 {p90_salary:money}, standard deviation "
        "{stddev_salary:money}. Total payroll is {total_payroll:money} across {employees_with_salary:int} employees "
        "with recorded salaries.",
    ),
    RowInsight(
        "salary", "top_paying_depts", {"rank": "rank", "dept": "department"}, ("rank", "department", "avg_salary"),
        "Rank #{rank:int}: {department} pays an average of {avg_salary:money} (median {median_salary:money}) across "
        "{employees_with_salary:int} employees, with total payroll of {total_payroll:money}.",
    ),
    RowInsight(
        "workforce", "by_country", {"country": "country"}, ("country", "headcount"),
        "Workforce in {country}: total {headcount:int} ({active:int} active, {attrited:int} attrited; "
        "{active_pct:pct} active).",
    ),
    RowInsight(
        "workforce", "by_department", {"dept": "department"}, ("department", "headcount"),
        "The {department} department has {headcount:int} employees: {active:int} active and {attrited:int} attrited "
        "({active_pct:pct} active rate).",
    ),
    RowInsight(
        "workforce", "experience_distribution", {"bucket": "experience_bucket"}, ("experience_bucket", "headcount"),
        "In the {experience_bucket} experience band, headcount is {headcount:int}, representing {share_pct:pct} of "
        "the workforce.",
    ),
    RowInsight(
        "workforce", "hiring_trends", {"year": "hire_year"}, ("hire_year", "hires"),
        "In {hire_year:int}, the company made {hires:int} hires.",
    ),
    RowInsight(
        "performance", "by_department", {"dept": "department"}, ("department", "avg_rating", "rated_employees"),
        "Performance ratings in {department}: average rating {avg_rating:f2}/5 across {rated_employees:int} rated "
        "employees. High performers (rating >= 4): {high_performers:int} ({high_performer_pct:pct}). Low performers "
        "(rating <= 2): {low_performers:int} ({low_performer_pct:pct}).",
    ),
    RowInsight(
        "performance", "top_teams", {"rank": "rank", "dept": "department"}, ("rank", "department", "avg_rating"),
        "Top-performing team #{rank:int}: {department} with average rating {avg_rating:f2}/5 across "
        "{rated_employees:int} employees, {high_performer_pct:pct} high-performer share.",
    ),
    RowInsight(
        "performance", "vs_salary", {"rating": "performance_rating"}, ("performance_rating", "avg_salary"),
        "Employees with performance rating {performance_rating:int}: {employees:int} people, average salary "
        "{avg_salary:money} (median {median_salary:money}, min {min_salary:money}, max {max_salary:money}).",
    ),
)

SUMMARIES = (
    Summary(
        "attrition", "by_department",
        "Across {groups} departments, the overall attrition rate is {overall:pct} ({attrited:grouped} employees left "
        "out of {headcount:grouped}). The departments with the highest attrition are {top}. The departments with the "
        "lowest attrition are {bottom}.",
        totals={
            "headcount": "sum(headcount)",
            "attrited": "sum(attrited)",
            "overall": "coalesce(try_divide(sum(attrited), sum(headcount)), 0.0D)",
        },
        lists={
            "top": Listing("{department} ({attrition_rate:pct})", _top("attrition_rate", "department"), ", ", 3),
            "bottom": Listing("{department} ({attrition_rate:pct})", _top("attrition_rate", "department"), ", ", 3,
                              last_of=True),
        },
    ),
    Summary(
        "attrition", "by_country",
        "Geographic attrition concentration: {top}. Workforce spans {groups} countries.",
        lists={"top": Listing("{country} {attrition_rate:pct}", _top("attrition_rate", "country"), "; ", 3)},
    ),
    Summary(
        "attrition", "trend_by_cohort",
        "Hire-cohort attrition trend: the cohorts with the highest churn are {top}. Coverage spans {first}-{last}.",
        totals={"first": "min(hire_year)", "last": "max(hire_year)"},
        lists={"top": Listing("{hire_year:int} ({attrition_rate:pct})", _top("attrition_rate", "hire_year"), ", ", 2)},
    ),
    Summary(
        "attrition", "by_tenure_bucket",
        "Attrition by tenure: the highest-churn tenure bucket is {top}. Tenure analysis can guide retention "
        "investments at specific career stages.",
        lists={"top": Listing("{tenure_bucket} ({attrition_rate:pct})", _top("attrition_rate", "tenure_bucket"), "", 1)},
    ),
    Summary(
        "salary", "by_department",
        "Across {groups} departments, top-paying are: {top}. Lowest-paying are: {bottom}. Total company payroll "
        "across departments: {payroll:money}.",
        totals={"payroll": "sum(total_payroll)"},
        lists={
            "top": Listing("{department} {avg_salary:money}", _top("avg_salary", "department"), "; ", 3),
            "bottom": Listing("{department} {avg_salary:money}", _low("avg_salary", "department"), "; ", 3),
        },
    ),
    Summary(
        "salary", "top_paying_depts", "Top-paying departments leaderboard: {board}.",
        lists={"board": Listing("#{rank:int} {department}", _low("rank", "department"), " > ")},
    ),
    Summary(
        "salary", "distribution",
        "Company-wide salary distribution: average {avg_salary:money}, median {median_salary:money}, "
        "P25 {p25_salary:money}, P75 {p75_salary:money}, P90 {p90_salary:money}, P95 {p95_salary:money}, "
        "P99 {p99_salary:money}, min {min_salary:money}, max {max_salary:money}, stddev {stddev_salary:money}. "
        "Total payroll {total_payroll:money} across {employees_with_salary:int} employees.",
        shape=lambda mart: mart,
        present="employees_with_salary > 0",
        extras=("avg_salary",),
    ),
    Summary(
        "workforce", "by_country",
        "Workforce spans {groups} countries with total headcount of {headcount:int}. Largest geographies: {top}.",
        totals={"headcount": "sum(headcount)"},
        lists={"top": Listing("{country} ({headcount:int})", _top("headcount", "country"), "; ", 3)},
    ),
    Summary(
        "workforce", "by_department",
        "Departments by headcount across {groups} departments. Largest: {top}. Total active workforce: {active:int}.",
        totals={"active": "sum(active)"},
        lists={"top": Listing("{department} ({headcount:int})", _top("headcount", "department"), "; ", 3)},
    ),
    Summary(
        "workforce", "experience_distribution", "Seniority pyramid: {board}",
        lists={"board": Listing("{experience_bucket} {headcount:int} ({share_pct:pct})",
                                ((f"array_position(array{EXPERIENCE_BUCKETS}, experience_bucket)", False),), " | ")},
    ),
    Summary(
        "workforce", "hiring_trends",
        "Hiring trend across {years} years. Peak year: {peak_year:int} with {peak_hires:int} hires. Latest year "
        "({latest_year:int}): {latest_hires:int} hires, {direction} from {prior_hires:int} the year before.",
        shape=reports.hiring_pulse,
        present="years >= 2",
    ),
    Summary(
        "performance", "by_department",
        "Performance leaderboard across {groups} departments. Top-rated: {top}. Lowest-rated: {bottom}.",
        lists={
            "top": Listing("{department} {avg_rating:f2}", _top("avg_rating", "department"), "; ", 3),
            "bottom": Listing("{department} {avg_rating:f2}", _low("avg_rating", "department"), "; ", 3),
        },
    ),
    Summary(
        "performance", "top_teams", "Top-performing teams: {board}.",
        lists={"board": Listing("#{rank:int} {department}", _low("rank", "department"), " > ")},
    ),
    Summary(
        "performance", "vs_salary",
        "Pay-for-performance signal: rating-{high_rating:int} employees earn an average of {high_avg_salary:money}, "
        "vs rating-{low_rating:int} at {low_avg_salary:money} -- top performers earn {abs_gap:money} {direction} on "
        "average ({gap_pct:signed1}%).",
        shape=lambda mart: reports.pay_gap(mart).withColumn("abs_gap", F.abs("gap")),
        present="ratings >= 2",
    ),
)

OVERVIEWS = (
    Summary(
        "overview", "attrition_hotspots",
        "Highest-attrition departments to watch: {top}. These are the priority areas for retention investment.",
        lists={"top": Listing("{department} ({attrition_rate:pct}, {attrited:int}/{headcount:int})",
                              _top("attrition_rate", "department"), "; ", 3)},
        source="attrition/by_department", id_tail=(),
    ),
    Summary(
        "overview", "compensation_leaders", "Highest-paying departments: {top}.",
        lists={"top": Listing("{department} (avg {avg_salary:money})", _top("avg_salary", "department"), "; ", 3)},
        source="salary/by_department", id_tail=(),
    ),
    Summary(
        "overview", "talent_density",
        "Highest concentration of high performers (rating >= 4): {top}. These departments have the strongest talent "
        "density.",
        lists={"top": Listing("{department} ({high_performer_pct:pct} of {rated_employees:int} rated)",
                              _top("high_performer_pct", "department"), "; ", 3)},
        source="performance/by_department", id_tail=(),
    ),
)
SNAPSHOT_TEXT = (
    "Company snapshot: total workforce of {total_headcount:int} employees ({total_active:int} active, "
    "{total_attrited:int} attrited) across {departments} departments. Overall attrition rate is "
    "{attrition_rate:pct}. Average salary is {avg_salary:money}, median {median_salary:money}, total payroll "
    "{total_payroll:money}. {rating_sentence}This snapshot can be used to answer high-level questions about size, "
    "attrition, compensation, and performance."
)
RATING_TEXT = "Average performance rating across all rated employees is {avg_rating:f2}/5. "
PULSE_TEXT = (
    "Hiring pulse: {latest_hires:int} hires in {latest_year:int}{versus}. Total cumulative hires recorded: "
    "{total_hires:int}."
)
VERSUS_TEXT = ", vs {prior_hires:int} in {prior_year:int}"


def _chunk(df: DataFrame, spec, text: str, kind: str | None, extras: Sequence[str], chunk_id: str) -> DataFrame:
    """Project to the chunk shape; metadata keeps primitives as text and the common fields are real columns."""
    pairs = ", ".join(f"'{e}', CAST({e} AS STRING)" for e in extras)
    return df.selectExpr(
        f"{chunk_id} AS chunk_id",
        f"{text} AS text",
        f"'{spec.domain}' AS domain",
        f"'{spec.metric}' AS metric",
        f"'gold/{spec.domain}/{spec.metric}' AS source_mart",
        f"CAST({quoted(kind) if kind else 'NULL'} AS STRING) AS kind",
        "CAST(snapshot_date AS STRING) AS snapshot_date",
        f"CAST(map({pairs}) AS map<string, string>) AS metadata",
    )


def row_chunks(mart: DataFrame, spec: RowInsight) -> DataFrame:
    if (spec.domain, spec.metric) == ("workforce", "hiring_trends"):
        # Narrated per year: months are rolled up first.
        mart = mart.groupBy("hire_year").agg(F.sum("hires").alias("hires"), F.max("snapshot_date").alias("snapshot_date"))
    chunk_id = stable_id_sql(spec.domain, spec.metric, **spec.key)
    return _chunk(mart, spec, render_sql(spec.text), None, spec.extras, chunk_id)


def _place(listing: Listing) -> str:
    """Position in the listing's order, counted from its end for ``last_of``. Runs over the rows of one small mart."""
    order = [f"{c} {'DESC' if down != listing.last_of else 'ASC'}" for c, down in listing.by]
    return f"row_number() OVER (ORDER BY {', '.join(order)})"


def _gathered(listing: Listing, place: str) -> str:
    """Aggregate that joins the listed items; rows beyond ``n`` are null to it and never gathered."""
    entry = f"struct({place} AS place, {render_sql(listing.item)} AS item)"
    if listing.n is not None:
        entry = f"CASE WHEN {place} <= {listing.n} THEN {entry} END"
    ascending = str(not listing.last_of).lower()
    return f"array_join(transform(sort_array(collect_list({entry}), {ascending}), x -> x.item), {quoted(listing.sep)})"


def summary_chunk(mart: DataFrame, spec: Summary) -> DataFrame:
    """Totals and listings of a mart in one aggregate over it."""
    if spec.shape is None:
        placed = mart.selectExpr("*", *[f"{_place(x)} AS _{name}" for name, x in spec.lists.items()])
        facts = placed.agg(
            F.expr("count(1) AS groups"),
            F.expr("max(snapshot_date) AS snapshot_date"),
            *[F.expr(f"{sql} AS {name}") for name, sql in spec.totals.items()],
            *[F.expr(f"{_gathered(x, '_' + name)} AS {name}") for name, x in spec.lists.items()],
        )
    else:
        facts = spec.shape(mart)
        if "snapshot_date" not in facts.columns:
            facts = reports.attach(facts, snapshot_date=mart.agg(F.max("snapshot_date")))
    chunk_id = stable_id_sql(spec.domain, spec.metric, *spec.id_tail)
    return _chunk(facts.filter(spec.present), spec, render_sql(spec.text), "summary", spec.extras, chunk_id)


def _snapshot_chunk(marts: Marts) -> DataFrame | None:
    workforce, salary, ratings = (
        marts.get(n) for n in ("workforce/by_department", "salary/distribution", "performance/by_department")
    )
    if workforce is None:
        return None
    spark = workforce.sparkSession
    if salary is None:
        salary = spark.sql("SELECT CAST(NULL AS DOUBLE) avg_salary, CAST(NULL AS DOUBLE) median_salary, "
                           "CAST(NULL AS DOUBLE) total_payroll")
    if ratings is None:
        ratings = spark.createDataFrame([], "avg_rating double, rated_employees bigint")
    facts = reports.attach(
        reports.overview(workforce, salary, ratings),
        rated=ratings.agg(F.coalesce(F.sum("rated_employees"), F.lit(0))),
        snapshot_date=workforce.agg(F.max("snapshot_date")),
    )
    sentence = F.when(F.col("rated") > 0, render(RATING_TEXT)).otherwise("")
    spec = Summary("overview", "company_snapshot", SNAPSHOT_TEXT)
    return _chunk(
        facts.filter("total_headcount IS NOT NULL").withColumn("rating_sentence", sentence), spec,
        render_sql(SNAPSHOT_TEXT), "summary", ("total_headcount", "attrition_rate"), stable_id_sql(spec.domain, spec.metric),
    )


def _pulse_chunk(marts: Marts) -> DataFrame | None:
    hiring = marts.get("workforce/hiring_trends")
    if hiring is None:
        return None
    facts = reports.attach(reports.hiring_pulse(hiring), snapshot_date=hiring.agg(F.max("snapshot_date")))
    versus = F.when(F.col("years") >= 2, render(VERSUS_TEXT)).otherwise("")
    spec = Summary("overview", "hiring_pulse", PULSE_TEXT)
    return _chunk(
        facts.filter("years > 0").withColumn("versus", versus), spec, render_sql(PULSE_TEXT), "summary", (),
        stable_id_sql(spec.domain, spec.metric),
    )


def row_insights(marts: Marts) -> list[DataFrame]:
    return [row_chunks(m, s) for s in ROW_INSIGHTS if (m := marts.get(f"{s.domain}/{s.metric}")) is not None]


def summary_insights(marts: Marts) -> list[DataFrame]:
    return [summary_chunk(m, s) for s in SUMMARIES if (m := marts.get(f"{s.domain}/{s.metric}")) is not None]


def overview_insights(marts: Marts) -> list[DataFrame]:
    listed = [summary_chunk(m, s) for s in OVERVIEWS if (m := marts.get(s.source)) is not None]
    return [c for c in (_snapshot_chunk(marts), _pulse_chunk(marts)) if c is not None] + listed


def union_chunks(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def insight_chunks(marts: Marts) -> DataFrame:
    """All chunks. Missing marts give none, and a group whose marts lack columns is logged and skipped."""
    frames: list[DataFrame] = []
    for build in (overview_insights, row_insights, summary_insights):
        try:
            frames += build(marts)
        except AnalysisException:
            LOG.exception("insight group skipped: %s", build.__name__)
    if not frames:
        raise ValueError("no marts to narrate")
    return union_chunks(frames)


def search_insights(
    collection: DataFrame,
    questions: DataFrame,
    *,
    question_id: str,
    text: str,
    encoder: retrieval.Encoder | None = None,
    where: Mapping[str, object] | None = None,
    k: int = retrieval.TOP_K,
    min_similarity: float = retrieval.MIN_SIMILARITY,
    max_chars: int = retrieval.CONTEXT_CHARS,
) -> DataFrame:
    """The packed context of every question: ``question_id, rank, chunk_id, similarity, line, used_chars``.

    The collection is filtered before anything is scored; on its partition fields (``domain``, ``kind``) that prunes files.
    Questions are embedded by the collection's encoder, scored exactly, and the lines of the best chunks packed in rank
    order within the character budget. A question without any term is as far from every chunk as can be: its lines are those
    of the smallest ids at similarity 0, unless ``min_similarity`` is above that. Null question ids are left out.
    """
    asked = retrieval.embed(questions.select(F.col(question_id).alias("query_id"), F.col(text).alias("_asked")), "_asked",
                            encoder, output="query_vector").filter(F.col("query_id").isNotNull())
    hits = retrieval.cosine_top_k(
        collection, asked.select("query_id", "query_vector"), id_col="chunk_id", vector_col="embedding", k=k, where=where,
        min_similarity=min_similarity)
    texts = retrieval.where_equal(collection, where).select("chunk_id", "text")
    packed = retrieval.pack_context(hits.join(texts, "chunk_id"), max_chars=max_chars)
    return packed.select(F.col("query_id").alias(question_id), "rank", "chunk_id", "similarity", "line", "used_chars")
