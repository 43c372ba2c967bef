"""The registered queries: every operator bound to the driver tables, each over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake import bindings as b
from peoplelake.bindings import AS_OF, Tables
from peoplelake.functions import text as tx
from peoplelake.operators import latest, marts as op, quality, reports, retrieval, routing, sequences
from peoplelake.operators.ranks import exact_quantiles
from peoplelake.plans import catalog, gold, insights, jobs, silver
from peoplelake.schemas import stream_schema
from peoplelake.session import scratch_path
from peoplelake.sources import lake as lk
from peoplelake.sources import log, versions
from peoplelake.sources.lake import Lake
from peoplelake.streaming.ingest import progress_report, start_ingest, watch
from peoplelake.streaming.upsert import batch_writer, start_upsert

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
    return fn


def mart(t: Tables, name: str) -> DataFrame:
    return gold.BY_NAME[name].build(b.employees(t), AS_OF)


_GOLD: dict[tuple, tuple[Lake, dict[str, DataFrame]]] = {}
_VIEWS: dict[str, catalog.GovernedViews] = {}


def written_employees(t: Tables) -> DataFrame:
    """The employees as a written table, as the marts' job gets them: joined once, not again for every mart and scan."""
    path = scratch_path(t.spark, "employees")
    b.employees(t).write.parquet(path)
    return t.spark.read.parquet(path)


def attempted_gold(t: Tables) -> tuple[Lake, dict[str, DataFrame], dict[str, str]]:
    """The Gold marts of a folder, written by the regular build job, and why any others are not there; built again when an
    input file has changed or a mart was not there."""
    states = tuple(lk.file_states(t.spark, t(name).inputFiles()) for name in ("orders", "customer", "nation"))
    key = (t.spark.sparkContext.applicationId, t.folder, states)
    if key in _GOLD:
        return *_GOLD[key], {}
    lake = Lake(scratch_path(t.spark, "gold"))
    rows = gold.build_all(written_employees(t), lake, AS_OF).collect()
    marts = catalog.load_marts(t.spark, lake)
    absent = {r["mart"]: f"{r['status']}, {r['detail']}" for r in rows if r["status"] == "failed" or r["mart"] not in marts}
    if not absent:
        _GOLD[key] = lake, marts
    return lake, marts, absent


def built_gold(t: Tables) -> tuple[Lake, dict[str, DataFrame]]:
    """All Gold marts of a folder; a mart that is not there is an error, as what reads them skips missing ones."""
    lake, marts, absent = attempted_gold(t)
    if absent:
        raise RuntimeError(f"marts are not there: {absent}")
    return lake, marts


def governed(t: Tables) -> catalog.GovernedViews:
    lake, marts, _ = attempted_gold(t)  # asking for a view that is not there is refused
    if lake.root not in _VIEWS:
        _VIEWS[lake.root] = catalog.GovernedViews(marts)
    return _VIEWS[lake.root]


def gold_marts(t: Tables) -> dict[str, DataFrame]:
    return built_gold(t)[1]


# -- sources and sinks ----------------------------------------------------------------------------------------------------
EVENTS_DDL = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
ATTENDANCE_FIELDS = (
    "attendance_id", "employee_id", "work_date", "punch_in", "hours_worked", "status", "is_late", "event_ts")


@query
def stream_bronze_ingest(t: Tables) -> DataFrame:
    lake = Lake(scratch_path(t.spark, "ingest"))
    events = log.file_stream(t.spark, f"{t.folder}/events*.parquet", EVENTS_DDL)
    run = start_ingest(b.attendance_messages(events), "attendance", lake, ingest_ts=F.col("timestamp"))
    batches = watch(run)
    landed = t.spark.read.parquet(lake.bronze("attendance"))
    seen = progress_report(t.spark, batches).agg(F.sum("input_rows"))
    per_day = landed.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("attendance_id").alias("parsed_rows"),
        F.sum("offset").alias("offset_sum"),
        F.sum(F.length("_raw")).alias("raw_chars"),
    )
    return reports.attach(per_day, input_rows=seen)


@query
def bronze_parse_payload(t: Tables) -> DataFrame:
    records = log.to_records(b.feed(t).drop("offset", "ingest_ts", "ingest_date"))
    framed = records.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit("employee_csv").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"))
    parsed = log.parse_messages(framed, "employee_csv")
    return parsed.select(
        "topic", "kafka_key", "employee_id", "name", "department", "salary", "joining_date", "performance_rating",
        "manager", "attrition", "country", F.array_join("skills", "|").alias("skills"), "experience")


@query
def bronze_parse_attendance(t: Tables) -> DataFrame:
    parsed = log.parse_messages(b.attendance_messages(t("events")), "attendance", F.col("timestamp"))
    return parsed.select(
        "topic", "partition", "offset", "kafka_ts", "kafka_key", "_raw", *ATTENDANCE_FIELDS, "ingest_date")


@query
def bronze_parse_performance(t: Tables) -> DataFrame:
    parsed = log.parse_messages(b.review_messages(t), "performance", F.col("timestamp"))
    return parsed.select(
        "topic", "offset", "review_id", "employee_id", "cycle", "rating", "promotion_flag", "bonus_amount",
        F.to_date("event_ts").alias("event_date"))


@query
def bronze_parse_recruitment(t: Tables) -> DataFrame:
    parsed = log.parse_messages(b.application_messages(t), "recruitment", F.col("timestamp"))
    return parsed.select(
        "offset", "application_id", "source", "stage", "department", "offer_amount", "event_ts", "ingest_date")


@query
def bronze_incremental_since(t: Tables) -> DataFrame:
    lake = Lake(scratch_path(t.spark, "bronze"))
    parsed = log.parse_messages(b.attendance_messages(t("events")), "attendance", F.col("timestamp"))
    lk.write_table(parsed, lake.bronze("attendance"), "ingest_date")
    recent = log.read_since(t.spark, lake.bronze("attendance"), "2024-01-16")
    return recent.select("offset", "attendance_id", "hours_worked", "ingest_date")


@query
def bronze_replay(t: Tables) -> DataFrame:
    landed = log.parse_messages(b.attendance_messages(t("events")), "attendance", F.col("timestamp"))
    again = log.replay(landed, "attendance", "attendance", from_offset=100)
    return again.select("partition", "offset", "kafka_key", "attendance_id", "hours_worked", "status", "ingest_date")


@query
def bronze_audit(t: Tables) -> DataFrame:
    landed = log.parse_messages(b.attendance_messages(t("events")), "attendance", F.col("timestamp"))
    return log.audit(landed, "attendance", partition=2)


@query
def publish_records(t: Tables) -> DataFrame:
    flat = b.feed(t).drop("offset", "ingest_ts", "ingest_date").withColumn("skills", F.array_join("skills", "||"))
    return log.to_records(flat)


@query
def scan_formats_roundtrip(t: Tables) -> DataFrame:
    rows = b.feed(t).drop("offset", "ingest_ts", "ingest_date")
    schema = stream_schema("employee_csv").struct
    root = scratch_path(t.spark, "formats")
    out = None
    for kind in ("csv", "json", "parquet"):
        lk.write_format(rows, f"{root}/{kind}", kind)
        back = lk.read_format(t.spark, f"{root}/{kind}", kind, schema)
        summary = back.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("department").alias("departments"),
            F.sum(F.length("salary")).alias("salary_chars"),
            F.sum(F.length("name")).alias("name_chars"),
            F.count("joining_date").alias("dates"),
            F.sum(F.coalesce(F.array_size("skills"), F.lit(0))).alias("skills"),
            F.sum(F.col("experience")).alias("experience"),
        ).withColumn("format", F.lit(kind))
        out = summary if out is None else out.unionByName(summary)
    return out


@query
def silver_write_roundtrip(t: Tables) -> DataFrame:
    lake = Lake(scratch_path(t.spark, "silver"))
    cleaned = silver.silver_employees(b.feed(t), AS_OF)
    path = lake.silver("dim_employee")
    lk.write_table(cleaned, path, lk.SILVER_PARTITIONS["dim_employee"])
    return lk.read_table(t.spark, path, like=cleaned).select(*_SILVER_SHOWN)


@query
def gold_build_all(t: Tables) -> DataFrame:
    lake = Lake(scratch_path(t.spark, "gold"))
    return gold.build_all(written_employees(t), lake, AS_OF)


@query
def gold_append_twice(t: Tables) -> DataFrame:
    """Two snapshots appended: rows per mart and day, and the leaders of each day."""
    lake = Lake(scratch_path(t.spark, "gold"))
    employees = written_employees(t)
    names = ["salary/by_department", "salary/top_paying_depts", "workforce/by_department"]
    for day in (AS_OF, "2002-01-02"):
        gold.build_all(employees, lake, day, names=names, mode="append").collect()
    parts = []
    for name in names:
        written = lk.read_table(t.spark, lake.gold(name))
        paid = F.struct("avg_salary", "department") if "avg_salary" in written.columns else F.struct("department")
        best = F.max(F.when(F.col("department").isNotNull(), paid))
        parts.append(written.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"), best["department"].alias("leader"))
                     .withColumn("mart", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def mart_catalog_discovered(t: Tables) -> DataFrame:
    """The catalogue by folders: two registered marts and one that a user has added."""
    lake = Lake(scratch_path(t.spark, "gold"))
    employees = written_employees(t)
    gold.build_all(employees, lake, AS_OF, names=["attrition/by_country", "workforce/by_department"]).collect()
    own = employees.groupBy("country", "department").agg(F.count(F.lit(1)).alias("people"))
    versions.publish(own, lake.gold("custom/people_by_place"), "country")
    return catalog.discovered_catalog(t.spark, lake)


@query
def mart_catalog(t: Tables) -> DataFrame:
    return catalog.mart_catalog(gold_marts(t))


@query
def mart_validation(t: Tables) -> DataFrame:
    """Two sound marts, one below its minimum size and one without a required column."""
    dept, country = mart(t, "attrition/by_department"), mart(t, "workforce/by_country")
    rows = [
        gold.validation_row("attrition/by_department", dept, gold.BY_NAME["attrition/by_department"].required),
        gold.validation_row("workforce/by_country", country, gold.BY_NAME["workforce/by_country"].required, 1000),
        gold.validation_row("workforce/no_rate", country.drop("active_pct"), ("country", "active_pct")),
        gold.validation_row("workforce/empty", country.filter("headcount < 0"), ("country",)),
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


@query
def lake_health(t: Tables) -> DataFrame:
    lake, marts, _ = attempted_gold(t)  # it reports which marts are there
    chunks = insights.union_chunks(insights.row_insights(marts))
    return catalog.lake_health(t.spark, lake, chunks)


# -- cleaning -------------------------------------------------------------------------------------------------------------
@query
def clean_trim(t: Tables) -> DataFrame:
    return silver.trim_text(b.feed(t), ["name", "manager", "country"]).select(
        "employee_id", "offset", "name", "manager", "country")


@query
def clean_department(t: Tables) -> DataFrame:
    return silver.clean_department(b.feed(t)).select(
        "employee_id", "offset", "department", "department_raw", "department_canonical")


@query
def clean_salary(t: Tables) -> DataFrame:
    return silver.clean_salary(b.feed(t)).select("employee_id", "offset", "salary", "salary_raw", "salary_valid")


@query
def clean_date(t: Tables) -> DataFrame:
    return silver.clean_joining_date(b.feed(t), AS_OF).select(
        "employee_id", "offset", "joining_date", "joining_date_raw", "joining_date_valid")


@query
def clean_flag(t: Tables) -> DataFrame:
    return silver.clean_attrition(b.feed(t)).select("employee_id", "offset", "attrition")


@query
def clean_country(t: Tables) -> DataFrame:
    return silver.clean_country(b.feed(t)).select("employee_id", "offset", "country")


@query
def clean_skills(t: Tables) -> DataFrame:
    return silver.clean_skills(b.feed(t)).select(
        "employee_id", "offset", F.array_join("skills", "|").alias("skills"), "skills_count")


@query
def clean_ranges(t: Tables) -> DataFrame:
    return silver.clean_ranges(b.feed(t)).select("employee_id", "offset", "performance_rating", "experience_years")


@query
def dedupe_latest(t: Tables) -> DataFrame:
    return silver.newest_employees(b.feed(t)).select("employee_id", "offset", "ingest_ts", "salary")


_SILVER_SHOWN = [c for c in silver.EMPLOYEE_COLUMNS if c != "skills"]


@query
def silver_employees(t: Tables) -> DataFrame:
    return silver.silver_employees(b.feed(t), AS_OF).select(
        *_SILVER_SHOWN, F.array_join("skills", "|").alias("skills"))


@query
def silver_incremental(t: Tables) -> DataFrame:
    """First deliveries as a full load, then the corrections merged in: the table that one load of all rows gives."""
    lake = Lake(scratch_path(t.spark, "incremental"))
    feed = b.feed(t)
    jobs.clean_employees(feed.filter(F.col("offset") % 2 == 1), lake, AS_OF)
    table, _ = jobs.clean_employees(feed.filter(F.col("offset") % 2 == 0), lake, AS_OF, mode="merge")
    return table.select(*_SILVER_SHOWN, F.array_join("skills", "|").alias("skills"))


@query
def stream_silver_upsert(t: Tables) -> DataFrame:
    """The feed as a stream of micro-batches upserted into the cleaned table, the last batch delivered twice."""
    lake, landed = Lake(scratch_path(t.spark, "upsert")), scratch_path(t.spark, "landed")
    feed = b.feed(t)
    feed.write.parquet(landed)
    stream = t.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 4).parquet(landed)
    table = lake.silver("dim_employee")

    def clean(rows: DataFrame) -> DataFrame:
        return silver.silver_employees(rows, AS_OF)

    start_upsert(stream, lake, "dim_employee", clean, ["employee_id"], "ingest_ts", "department").awaitTermination()
    last = versions.current(t.spark, table).batches["silver_dim_employee"]
    batch_writer(table, "silver_dim_employee", clean, ["employee_id"], "ingest_ts", "department")(feed, last)
    return lk.read_table(t.spark, table, like=clean(feed)).select(*_SILVER_SHOWN, F.array_join("skills", "|").alias("skills"))


@query
def bronze_offset_gaps(t: Tables) -> DataFrame:
    """Where the attendance log has holes if the error events never came."""
    landed = log.parse_messages(b.attendance_messages(t("events").filter("event_type <> 'error'")), "attendance", F.col("timestamp"))
    return sequences.offset_gaps(landed)


@query
def vector_topk_blocks(t: Tables) -> DataFrame:
    """Every fiftieth vector against all, the queries in blocks that meet the corpus in a grid."""
    asked = t("embeddings").filter("vec_id % 50 = 0").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("query_vector"))
    hits = retrieval.cosine_top_k(t("embeddings"), asked, id_col="vec_id", vector_col="embedding", slice_rows=8)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query
def quality_report_raw(t: Tables) -> DataFrame:
    """The report of the cleaning job, with what it saw of the raw rows."""
    report = jobs.clean_employees(b.feed(t), Lake(scratch_path(t.spark, "audited")), AS_OF)[1]
    return report.filter(F.col("name").startswith("raw_")).withColumn("value", F.round("value", 9))


@query
def silver_attendance(t: Tables) -> DataFrame:
    return silver.silver_attendance(b.attendance(t("events")))


@query
def silver_performance(t: Tables) -> DataFrame:
    return silver.silver_performance(b.reviews(t))


@query
def silver_recruitment(t: Tables) -> DataFrame:
    return silver.silver_recruitment(b.applications(t))


@query
def scd_current_flag(t: Tables) -> DataFrame:
    return sequences.version_intervals(b.hris_versions(t), "employee_id").select(
        "employee_id", "grade", "base_salary", "event_ts", "valid_from", "valid_to", "is_current")


@query
def silver_hris_history(t: Tables) -> DataFrame:
    lake, feed = Lake(scratch_path(t.spark, "hris")), b.hris_versions(t)
    jobs.clean_versions(feed.filter("event_ts >= '1995-01-01'"), lake)
    history = jobs.clean_versions(feed.filter("event_ts < '1996-01-01'"), lake, mode="merge")
    return history.select("employee_id", "grade", "base_salary", "event_ts", "valid_from", "valid_to", "is_current")


@query
def dim_filter(t: Tables) -> DataFrame:
    picked = reports.filter_dimension(b.employees(t), "department", ["BUILDING", "MACHINERY"])
    return reports.filter_dimension(picked, "no_such_column", ["x"]).select("employee_id", "department", "salary")


@query
def dim_options(t: Tables) -> DataFrame:
    return reports.dimension_options(b.feed(t), "department")


@query
def dq_report(t: Tables) -> DataFrame:
    return quality.quality_report(silver.silver_employees(b.feed(t), AS_OF))


# -- marts ----------------------------------------------------------------------------------------------------------------
for _m in gold.MARTS:
    REGISTRY[_m.view] = (lambda name: lambda spark, folder: mart(Tables(spark, folder), name))(_m.name)


@query
def gold_headcount(t: Tables) -> DataFrame:
    current = latest.mark_current(b.hris_versions(t), "employee_id").filter("is_current")
    return gold.headcount(silver.tenure_days(current, AS_OF), AS_OF)


@query
def gold_attendance(t: Tables) -> DataFrame:
    return gold.attendance_compliance(silver.silver_attendance(b.attendance(t("events"))), b.staff_of_events(t), AS_OF)


@query
def gold_reviews(t: Tables) -> DataFrame:
    return gold.review_outcomes(silver.silver_performance(b.reviews(t)), b.staff_of_reviews(t), AS_OF)


@query
def gold_recruitment_funnel(t: Tables) -> DataFrame:
    return gold.recruitment_funnel(silver.silver_recruitment(b.applications(t)), AS_OF)


@query
def recruitment_funnel_long(t: Tables) -> DataFrame:
    return op.funnel_long(
        silver.silver_recruitment(b.applications(t)), ["department", "source"], "stage", "application_id",
        "offer_amount")


# -- reports --------------------------------------------------------------------------------------------------------------
@query
def overview_snapshot(t: Tables) -> DataFrame:
    return reports.overview(
        mart(t, "workforce/by_department"), mart(t, "salary/distribution"), mart(t, "performance/by_department")
    ).withColumns({"attrition_rate": F.round("attrition_rate", 6), "avg_rating": F.round("avg_rating", 6)})


@query
def kpi_home(t: Tables) -> DataFrame:
    return reports.kpi_home(
        mart(t, "workforce/by_department"), mart(t, "workforce/by_country"), mart(t, "salary/distribution"))


@query
def kpi_workforce(t: Tables) -> DataFrame:
    return reports.kpi_workforce(
        mart(t, "workforce/by_department"), mart(t, "workforce/by_country"), ["BUILDING", "MACHINERY", "HOUSEHOLD"])


@query
def kpi_salary(t: Tables) -> DataFrame:
    return reports.kpi_salary(mart(t, "salary/distribution"))


@query
def kpi_attrition(t: Tables) -> DataFrame:
    return reports.kpi_attrition(mart(t, "attrition/by_department"))


@query
def kpi_performance(t: Tables) -> DataFrame:
    return reports.kpi_performance(mart(t, "performance/by_department"))


@query
def hires_by_year(t: Tables) -> DataFrame:
    return reports.yearly(mart(t, "workforce/hiring_trends"))


@query
def hiring_pulse(t: Tables) -> DataFrame:
    return reports.hiring_pulse(mart(t, "workforce/hiring_trends"))


@query
def pay_for_performance_gap(t: Tables) -> DataFrame:
    return reports.pay_gap(mart(t, "performance/vs_salary")).withColumns(
        {"gap": F.round("gap", 2), "gap_pct": F.round("gap_pct", 4)})


@query
def salary_spread_long(t: Tables) -> DataFrame:
    return reports.salary_spread(mart(t, "salary/by_department"))


@query
def hotspots_attrition(t: Tables) -> DataFrame:
    return reports.extremes(mart(t, "attrition/by_country"), "country", "attrition_rate")


@query
def hotspots_salary(t: Tables) -> DataFrame:
    return reports.extremes(mart(t, "salary/by_department"), "department", "avg_salary")


@query
def hotspots_talent(t: Tables) -> DataFrame:
    return reports.extremes(mart(t, "performance/by_department"), "department", "high_performer_pct", ends={"top": True})


@query
def profile_columns(t: Tables) -> DataFrame:
    rows = b.feed(t).select("employee_id", "department", "salary", "joining_date", "performance_rating", "country",
                            "attrition", "ingest_date")
    return reports.profile_columns(rows, exact=True)


@query
def profile_columns_approx(t: Tables) -> DataFrame:
    """The sketch is held against the exact count: three times its stated error of 5 % is allowed."""
    feed = b.feed(t)
    exact = reports.profile_columns(feed, exact=True).select("name", F.col("distinct_values").alias("exact"))
    both = reports.profile_columns(feed).join(exact, "name")
    close = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.15 * F.col("exact")
    return both.withColumn("distinct_is_close", close).drop("distinct_values", "exact")


@query
def profile_dataset(t: Tables) -> DataFrame:
    rows = b.feed(t).drop("offset", "ingest_ts", "ingest_date")
    return reports.profile_dataset(rows, "employee_id", "department")


@query
def fmt_money(t: Tables) -> DataFrame:
    people = b.employees(t)
    return people.select(
        "employee_id",
        tx.money("salary").alias("salary_text"),
        tx.money("salary * 100").alias("hundredfold_text"),
        tx.money("salary / 100").alias("hundredth_text"),
        tx.whole("performance_rating").alias("rating"),
    )


@query
def fmt_pct(t: Tables) -> DataFrame:
    rates = mart(t, "attrition/by_country")
    return rates.select("country", tx.percent("attrition_rate").alias("rate_text"),
                        tx.percent("attrition_rate", 2).alias("rate_text_2"))


# -- governance -----------------------------------------------------------------------------------------------------------
@query
def governed_query(t: Tables) -> DataFrame:
    return governed(t).query(
        "attrition_by_country",
        lambda df: df.filter("attrited > 0").select("country", "headcount", "attrited", "attrition_rate"))


@query
def governed_sql(t: Tables) -> DataFrame:
    return governed(t).sql("SELECT hire_year, SUM(hires) AS hires FROM workforce_hiring_trends GROUP BY hire_year;")


@query
def audit_query_log(t: Tables) -> DataFrame:
    return catalog.audit_query_log(b.order_texts(t, b.STATEMENTS, "sql"))


@query
def result_summary(t: Tables) -> DataFrame:
    return reports.result_summary(
        mart(t, "attrition/by_department"), [F.desc("attrition_rate"), F.asc("department")])


# -- insights -------------------------------------------------------------------------------------------------------------
def _shown(frames: list[DataFrame]) -> DataFrame:
    return insights.union_chunks(frames).select(
        "chunk_id", "text", "domain", "metric", "source_mart", "kind", "snapshot_date")


@query
def insight_rows(t: Tables) -> DataFrame:
    return _shown(insights.row_insights(gold_marts(t)))


@query
def insight_summaries(t: Tables) -> DataFrame:
    return _shown(insights.summary_insights(gold_marts(t)))


@query
def insight_overview(t: Tables) -> DataFrame:
    return _shown(insights.overview_insights(gold_marts(t)))


@query
def insight_chunks(t: Tables) -> DataFrame:
    chunks = insights.insight_chunks(gold_marts(t))
    return chunks.groupBy("domain", "metric").agg(
        F.count(F.lit(1)).alias("chunks"), F.count("kind").alias("summaries"),
        F.count_distinct("chunk_id").alias("ids"))


@query
def insight_metadata(t: Tables) -> DataFrame:
    entries = insights.insight_chunks(gold_marts(t)).select("chunk_id", F.explode("metadata").alias("field", "entry"))
    number = F.expr("try_cast(entry AS double)")
    return entries.select("chunk_id", "field", F.when(number.isNull(), F.col("entry")).alias("entry"), F.round(number, 6).alias("number"))


@query
def insight_search(t: Tables) -> DataFrame:
    lake, _ = built_gold(t)
    collection = jobs.refresh_chunks(t.spark, lake, reset=True)
    asked = t("conversations").select(F.concat_ws(".", "conv_id", "turn").alias("question_id"), "text")
    found = [
        insights.search_insights(collection, asked, question_id="question_id", text="text", where=where, max_chars=600).select(
            F.lit(name).alias("scope"), "*")
        for name, where in (("attrition", {"domain": "attrition"}), ("pay_summary", {"domain": "salary", "kind": "summary"}))]
    return found[0].unionByName(found[1])


# -- retrieval ------------------------------------------------------------------------------------------------------------
def _hits(t: Tables, **options) -> DataFrame:
    return retrieval.cosine_top_k(
        t("embeddings"), b.centroids(t), id_col="vec_id", vector_col="embedding", **options)


@query
def vector_topk(t: Tables) -> DataFrame:
    return _hits(t).withColumn("similarity", F.round("similarity", 6))


@query
def vector_topk_filtered(t: Tables) -> DataFrame:
    return _hits(t, k=10, where={"label": 3}, min_similarity=0.1).withColumn("similarity", F.round("similarity", 6))


@query
def pack_context(t: Tables) -> DataFrame:
    hits = _hits(t, k=10)
    texts = t("documents").select(F.col("doc_id").alias("vec_id"), "text")
    packed = retrieval.pack_context(hits.join(texts, "vec_id", "left"), id_col="vec_id", max_chars=6000)
    return packed.select("query_id", "vec_id", "rank", "line", "used_chars")


@query
def embed_text(t: Tables) -> DataFrame:
    vectors = retrieval.embed(t("documents"), "text")
    places = vectors.select("doc_id", F.size("embedding").alias("dimensions"), F.posexplode("embedding").alias("place", "value"))
    return places.filter("value <> 0").select("doc_id", "dimensions", "place", F.round(F.col("value").cast("double"), 6).alias("value"))


@query
def document_search(t: Tables) -> DataFrame:
    corpus = retrieval.embed(t("documents"), "text")
    asked = retrieval.embed(t("benchmark"), "text", output="query_vector").select(
        F.col("item_id").alias("query_id"), "query_vector")
    return retrieval.cosine_top_k(corpus, asked, id_col="doc_id", vector_col="embedding")


@query
def chunk_upsert(t: Tables) -> DataFrame:
    docs = t("documents").select("doc_id", "source", "lang", "n_chars")
    changed = docs.join(t("labels").select("doc_id", "quality"), "doc_id").select(
        "doc_id", F.concat("source", F.lit("-"), "quality").alias("source"), "lang", (F.col("n_chars") + 1).alias("n_chars"))
    return latest.upsert(docs, changed, "doc_id")


@query
def chunk_delete_where(t: Tables) -> DataFrame:
    docs = t("documents").select("doc_id", "source", "lang", "n_chars")
    return retrieval.delete_where(docs, {"lang": "en", "source": "src1"})


@query
def line_item_quantiles(t: Tables) -> DataFrame:
    """Exact discrete quantiles of prices and of a heavily tied quantity, by return flag and line status."""
    items, by = t("lineitem"), ["l_returnflag", "l_linestatus"]
    points = tuple(op.PERCENTILES.values())
    parts = [
        exact_quantiles(items, measure, points, by).select(
            F.lit(measure).alias("measure"), *by,
            *[F.get("q", F.lit(i)).cast("double").alias(name) for i, name in enumerate(op.PERCENTILES)])
        for measure in ("l_extendedprice", "l_quantity")]
    return parts[0].unionByName(parts[1])


# -- routing --------------------------------------------------------------------------------------------------------------
@query
def classify_intents(t: Tables) -> DataFrame:
    return routing.classify_intents(b.question_log(t)).drop("question").withColumn(
        "confidence", F.round("confidence", 6))


@query
def extract_sql_blocks(t: Tables) -> DataFrame:
    return routing.extract_sql(b.order_texts(t, b.ANSWERS, "answer"))


@query
def resolve_table_refs(t: Tables) -> DataFrame:
    return routing.resolve_tables(b.table_questions(t), [m.view for m in gold.MARTS])


@query
def conversation_last_n(t: Tables) -> DataFrame:
    return routing.last_turns(b.turns(t), "conv_id", "turn")


@query
def conversation_context(t: Tables) -> DataFrame:
    return routing.render_context(b.turns(t), "conv_id", "turn")


def flagship(t: Tables) -> DataFrame:
    """Attrition by department from a dirty feed, behind the data-quality gate."""
    table, _ = jobs.clean_employees(b.feed(t), Lake(scratch_path(t.spark, "flagship")), AS_OF, fail_on_quality=True)
    return gold.BY_NAME["attrition/by_department"].build(table, AS_OF)


@query
def attrition_from_dirty_feed(t: Tables) -> DataFrame:
    return flagship(t)
