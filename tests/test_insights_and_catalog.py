import datetime as dt

import pytest
from pyspark.sql import functions as F

from peoplelake.functions import text as tx
from peoplelake.operators import reports, retrieval
from peoplelake.plans import catalog, gold, insights, jobs

AS_OF = "2024-06-30"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from peoplelake.sources.lake import Lake

    rows = [(f"E{i}", ["IT", "Sales", "HR", "Ops"][i % 4], ["India", "Uk"][i % 2], 50_000.0 * (1 + i % 300),
             dt.date(2022 + i % 3, 1 + i % 12, 1), "Yes" if i % 10 < i % 4 else "No", 1 + i % 5, i % 25) for i in range(400)]
    people = spark.createDataFrame(rows, "employee_id string, department string, country string, salary double, "
                                         "joining_date date, attrition string, performance_rating int, experience_years int")
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    gold.build_all(people, lake, AS_OF).collect()
    return lake


@pytest.fixture(scope="module")
def marts(spark, built):
    return catalog.load_marts(spark, built)


def test_number_formats(spark):
    df = spark.createDataFrame([(1, 12_345_678.0), (2, 123_456.0), (3, 99_999.4), (4, None), (5, 0.125)], "i int, v double")
    rows = df.orderBy("i").select(tx.money("v"), tx.percent("v"), tx.whole("v"), tx.plain(F.col("v"), "double")).collect()
    assert [r[0] for r in rows] == ["INR 1.23 Cr", "INR 1.23 L", "INR 99,999", "n/a", "INR 0"]
    assert rows[4][1] == "12.5%" and rows[3][1] == "n/a" and [r[2] for r in rows][3:] == [0, 0]
    assert rows[0][3] == "12345678.0"


def test_stable_ids(spark):
    row = spark.range(1).select(
        tx.stable_id("attrition", "by_department", dept="'Human Resources'").alias("a"),
        tx.stable_id("salary", "x", rank="1", dept="'IT'").alias("b"),
        F.length(tx.stable_id(k="repeat('x', 900)")).alias("n")).first()
    assert (row["a"], row["b"], row["n"]) == ("attrition.by_department.dept=Human_Resources", "salary.x.dept=IT.rank=1", 512)


def test_chunks_are_complete_and_unique(marts):
    chunks = insights.insight_chunks(marts).cache()
    assert set(chunks.columns) == set(insights.CHUNK_COLUMNS)
    assert chunks.count() == chunks.select("chunk_id").distinct().count()
    assert chunks.filter("text IS NULL OR text LIKE '%{%'").count() == 0
    summaries = {(r["domain"], r["metric"]) for r in chunks.filter("kind = 'summary'").collect()}
    assert len(summaries) == 14 + 5
    one = chunks.filter("chunk_id = 'attrition.by_department.dept=IT'").first()
    mart = marts["attrition/by_department"].filter("department = 'IT'").first()
    assert one["text"].startswith(f"In the IT department, total headcount is {mart['headcount']} employees, with ")
    assert one["metadata"] == {"department": "IT", "attrition_rate": str(mart["attrition_rate"]), "headcount": str(mart["headcount"])}
    assert one["source_mart"] == "gold/attrition/by_department" and one["snapshot_date"] == AS_OF


def test_top_and_bottom_lists(marts):
    text = insights.summary_chunk(marts["attrition/by_department"], insights.SUMMARIES[0]).first()["text"]
    rows = sorted(marts["attrition/by_department"].collect(), key=lambda r: (-r["attrition_rate"], r["department"]))
    item = lambda r: f"{r['department']} ({r['attrition_rate'] * 100:.1f}%)"
    assert f"highest attrition are {', '.join(map(item, rows[:3]))}." in text
    assert f"lowest attrition are {', '.join(map(item, rows[-3:]))}." in text


def test_missing_marts_are_skipped(marts):
    some = {"salary/distribution": marts["salary/distribution"], "workforce/by_department": marts["workforce/by_department"]}
    chunks = insights.insight_chunks(some).collect()
    assert {r["domain"] for r in chunks} == {"salary", "workforce", "overview"}
    snapshot = next(r["text"] for r in chunks if r["metric"] == "company_snapshot")
    assert "Average performance" not in snapshot and "Average salary is INR" in snapshot
    only = insights.insight_chunks({"workforce/by_department": marts["workforce/by_department"]}).collect()
    assert "Average salary is n/a, median n/a, total payroll n/a." in next(
        r["text"] for r in only if r["metric"] == "company_snapshot")


def test_single_year_variants(spark):
    hiring = spark.createDataFrame([(2024, 1, 5, dt.date(2024, 6, 30)), (2024, 2, 7, dt.date(2024, 6, 30))],
                                   "hire_year int, hire_month int, hires bigint, snapshot_date date")
    chunks = insights.insight_chunks({"workforce/hiring_trends": hiring}).collect()
    texts = {r["chunk_id"]: r["text"] for r in chunks}
    assert texts == {
        "workforce.hiring_trends.year=2024": "In 2024, the company made 12 hires.",
        "overview.hiring_pulse": "Hiring pulse: 12 hires in 2024. Total cumulative hires recorded: 12.",
    }
    assert insights.insight_chunks({"workforce/hiring_trends": hiring.limit(0)}).count() == 0


def test_chunk_collection_refresh_is_idempotent(spark, built):
    first = jobs.refresh_chunks(spark, built)
    n = first.count()
    assert jobs.refresh_chunks(spark, built).count() == n
    assert jobs.refresh_chunks(spark, built, reset=True).count() == n


def test_catalog_views_and_document(spark, marts):
    names = catalog.register_views(marts)
    assert len(names) == 14 and "attrition_by_country" in names
    rows = {r["view_name"]: r for r in catalog.mart_catalog(marts).collect()}
    assert rows["attrition_by_country"]["row_count"] == 2
    assert rows["attrition_by_country"]["signature"].startswith("attrition_by_country(country string, headcount bigint")
    assert spark.sql("SELECT department, avg_salary FROM salary_by_department ORDER BY avg_salary DESC LIMIT 1").count() == 1
    doc = catalog.catalog_document(marts)
    assert doc.index("### Domain: attrition") < doc.index("### Domain: workforce")
    assert catalog.catalog_document({}) == "(no tables available)"


def test_governed_access(marts):
    views = catalog.GovernedViews(marts, default_limit=3, hard_cap=5)
    assert views.query("workforce_hiring_trends").count() == 3
    assert views.query("workforce_hiring_trends", limit=100).count() == 5
    assert views.query("attrition_by_country", lambda df: df.filter("country = 'Uk'")).count() == 1
    with pytest.raises(PermissionError):
        views.query("secret_table")


def test_query_log_audit(spark):
    statements = [
        ("SELECT a FROM t;", True, ""), ("with x as (select 1) select * from x", True, ""), ("DROP TABLE t", False, "DROP"),
        ("select dataset, uploaded, set_id from t", True, ""), ("select 1 from t where x = 'set'", False, "SET"),
        ("select * from READ_TEXT('f')", False, "READ_TEXT"), ("", False, ""), (None, False, ""),
        ("select 1; select 2", False, ""), ("select '" + "x" * 4000 + "'", False, ""), ("explain select 1", False, ""),
        ("insert into t select 1", False, "INSERT"),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _, _) in enumerate(statements)], "i int, sql string")
    rows = catalog.audit_query_log(df).orderBy("i").collect()
    assert [(r["sql"], r["allowed"], r["blocked_words"]) for r in rows] == statements


def test_reports(spark, marts):
    dept = marts["attrition/by_department"]
    assert reports.filter_dimension(dept, "department", []).count() == dept.count()
    assert reports.filter_dimension(dept, "absent", ["x"]).count() == dept.count()
    assert [r[0] for r in reports.dimension_options(dept, "department").collect()] == ["HR", "IT", "Ops", "Sales"]
    tie = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.0)], "department string, m double")
    row = tie.agg(reports.best_by("department", "m").alias("hi"), reports.best_by("department", "m", False).alias("lo")).first()
    assert (row["hi"], row["lo"]) == ("a", "c")
    home = reports.kpi_home(marts["workforce/by_department"], marts["workforce/by_country"], marts["salary/distribution"]).first()
    assert home["total_employees"] == 400 and home["countries"] == 2 and home["avg_salary"] > 0
    filtered = reports.kpi_workforce(marts["workforce/by_department"], marts["workforce/by_country"], ["IT"], ["Uk"]).first()
    assert (filtered["headcount"], filtered["departments"], filtered["countries"]) == (100, 1, 1)
    nothing = reports.kpi_attrition(dept.limit(0)).first()
    assert nothing["overall_rate_pct"] == 0.0 and nothing["highest_department"] is None
    summary = reports.result_summary(dept, [F.asc("department")]).first()["summary"]
    assert summary.startswith("[SQL] department=HR, headcount=100, attrited=") and summary.endswith(" (+3 rows)")
    assert reports.result_summary(dept.limit(0), [F.asc("department")]).first()["summary"] == "(no result)"


def test_profiles_agree(spark, marts):
    df = marts["salary/by_department"]
    exact = {r["name"]: r for r in reports.profile_columns(df, exact=True).collect()}
    approx = {r["name"]: r for r in reports.profile_columns(df).collect()}
    assert set(exact) == set(df.columns)
    for name, row in exact.items():
        assert row.asDict() | {"distinct_values": 0} == approx[name].asDict() | {"distinct_values": 0}
    assert exact["department"]["distinct_values"] == 4 and exact["snapshot_date"]["class"] == "date"
    raw = spark.createDataFrame([("a", "x", None), ("a", "x", 1), ("b", None, 2), (None, "y", 3)], "k string, g string, v int")
    got = {r["measure"]: r["value"] for r in reports.profile_dataset(raw, "k", "g").collect()}
    assert got == {"rows": 4, "unique_k": 2, "duplicate_rows": 1, "nulls_k": 1, "nulls_g": 1, "nulls_v": 1, "distinct_g": 2}


def test_search_reads_only_the_wanted_partitions_and_packs(spark, built):
    collection = jobs.refresh_chunks(spark, built, reset=True)
    asked = spark.createDataFrame(
        [("a", "Which department has the highest attrition rate?"), ("b", "attrition in India"), ("c", None), (None, "x")],
        "qid string, question string")
    found = insights.search_insights(
        collection, asked, question_id="qid", text="question", where={"domain": "attrition", "kind": "summary"}, k=3)
    scans = found._jdf.queryExecution().executedPlan().toString()
    assert scans.count("PartitionFilters: [isnotnull(domain") == scans.count("FileScan parquet") > 0
    rows = found.orderBy("qid", "rank").collect()
    assert {r["qid"] for r in rows} == {"a", "b", "c"}
    assert all(r["chunk_id"].startswith("attrition.") and r["chunk_id"].endswith("summary") for r in rows)
    texts = {r["chunk_id"]: r["text"] for r in collection.collect()}
    vectors = {r["chunk_id"]: r["embedding"] for r in collection.collect()}
    for qid, question in (("a", "Which department has the highest attrition rate?"), ("b", "attrition in India"), ("c", "")):
        one = spark.createDataFrame([(question,)], "text string")
        v = [float(x) for x in retrieval.embed(one, "text").first()["embedding"]]
        scored = []
        for c, u in vectors.items():
            if c.startswith("attrition.") and c.endswith("summary"):
                norm = sum(x * x for x in v) ** 0.5 * sum(x * x for x in u) ** 0.5
                scored.append((-round(sum(x * y for x, y in zip(u, v)) / norm, 9) if norm else 0.0, c))
        mine = [r for r in rows if r["qid"] == qid]
        assert [r["chunk_id"] for r in mine] == [c for _, c in sorted(scored)[:3]][: len(mine)]
        assert all(r["line"].endswith(texts[r["chunk_id"]]) for r in mine)
        assert mine[-1]["used_chars"] <= retrieval.CONTEXT_CHARS
    tight = insights.search_insights(collection, asked, question_id="qid", text="question", max_chars=10)
    assert tight.count() == 0


def test_best_label_and_mean_of_means_at_ties(spark):
    """A missing label or metric never beats a named one, and a mean of means that lies halfway is rounded up."""
    tie = spark.createDataFrame([(None, 3.0), ("b", 3.0), ("a", 3.0), ("d", None), (None, 1.0), ("c", 1.0)], "department string, m double")
    row = tie.agg(reports.best_by("department", "m").alias("hi"), reports.best_by("department", "m", False).alias("lo")).first()
    assert (row["hi"], row["lo"]) == ("a", "c")
    rated = spark.createDataFrame(
        [(None, 10, 3.17, 1, 1), ("x", 4, 4.39, 1, 1), ("y", 10, 1.35, 1, 1)],
        "department string, rated_employees bigint, avg_rating double, high_performers bigint, low_performers bigint")
    strip = reports.kpi_performance(rated).first()
    assert (strip["avg_rating"], strip["top_department"]) == (2.62, "x")  # 62.76 / 24 = 2.615
    assert reports.kpi_performance(rated.limit(0)).first()["avg_rating"] == 0.0
