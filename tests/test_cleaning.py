import datetime as dt

import pytest
from pyspark.sql import functions as F

from peoplelake.functions import cleaning as fx
from peoplelake.plans import silver

AS_OF = "2024-06-30"


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def applied(spark, values, fn, kind="string"):
    return [r[0] for r in column(spark, values, kind).select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


@pytest.mark.parametrize("text, amount", [
    ("4675038.58", 4675038.58), ("$5,358,375", 5358375.0), ("4144k", 4144000.0), ("75K", 75000.0), ("75 k ", 75000.0),
    ("5,358,375.00", 5358375.0), ("€42,000", 42000.0), ("  4250000.00 INR  ", 4250000.0), ("0", 0.0), ("100000000", 1e8),
])
def test_salary_styles(spark, text, amount):
    assert applied(spark, [text], fx.parse_salary) == [amount]


def test_salary_rejects_without_raising(spark):
    words = ["N/A", "unknown", "TBD", "-", "??", "null", "", None, "-5", "100000001", "pending", "1-2", "1.2.3", "k", ".k"]
    assert applied(spark, words, fx.parse_salary) == [None] * len(words)


def test_dates(spark):
    bad = ["2025-13-45", "31/02/2024", "not-a-date", "0000-00-00", "2099-01-01", "32-13-2024", "1900-00-15", "", None,
           "1949-12-31", "2024-07-01"]
    good = ["1950-01-01", "2024-06-30", "2020-02-29"]
    out = applied(spark, bad + good, lambda c: fx.parse_iso_date(c, AS_OF))
    assert out == [None] * len(bad) + [dt.date.fromisoformat(g) for g in good]


@pytest.mark.parametrize("name, spellings", [
    ("Engineering", ["Engineering", "engineering", "ENGINEERING", "Engg", "Engg.", "Eng", "Eng."]),
    ("Sales", ["Sales", "sales", "SALES", "Sales Dept", "Sales-Team", " sales "]),
    ("Marketing", ["Marketing", "marketing", "MKTG", "Mktg.", "Marketing Dept"]),
    ("Finance", ["Finance", "finance", "FIN", "Fin.", "Finance & Accounts"]),
    ("Human Resources", ["Human Resources", "HR", "hr", "H.R.", "Human-Resources", "human resources"]),
    ("Operations", ["Operations", "Ops", "OPS", "ops", "Op."]),
    ("Support", ["Support", "support", "Cust Support", "Customer Support", "CS"]),
    ("IT", ["IT", "I.T.", "Information Technology", "Info Tech", "it"]),
])
def test_department_spellings(spark, name, spellings):
    df = spark.createDataFrame([(s,) for s in spellings], "department string")
    rows = silver.clean_department(df).collect()
    assert {r["department"] for r in rows} == {name}
    assert all(r["department_canonical"] for r in rows)
    assert [r["department_raw"] for r in rows] == spellings


def test_department_unknown_blank_and_missing(spark):
    df = spark.createDataFrame([(" Legal ",), ("  ",), (None,)], "department string")
    rows = silver.clean_department(df).collect()
    assert [r["department"] for r in rows] == [" Legal ", None, None]
    assert [r["department_canonical"] for r in rows] == [False, None, None]


def test_flags_countries_trim(spark):
    assert applied(spark, ["yes", "y", "TRUE", "1", " No ", "n", "False", "0", "maybe", None], fx.yes_no) == (
        ["Yes"] * 4 + ["No"] * 4 + [None, None])
    assert applied(spark, ["  south  korea ", "USA", None], fx.title_case) == ["South  Korea", "Usa", None]
    assert applied(spark, ["  a b ", "   ", "", None], fx.blank_to_null) == ["a b", None, None, None]


def test_skills(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (None,), ([],)], "skills array<string>")
    rows = silver.clean_skills(df).collect()
    assert [(r["skills"], r["skills_count"]) for r in rows] == [(["a", "b"], 2), (None, 0), ([], 0)]


def test_ranges(spark):
    df = spark.createDataFrame(
        [(0.0, -1.0), (1.0, 0.0), (4.7, 60.0), (5.0, 61.0), (5.4, 3.9), (None, None), (float("nan"), 2.0)],
        "performance_rating double, experience double")
    rows = silver.clean_ranges(df).collect()
    assert [r["performance_rating"] for r in rows] == [None, 1, 4, 5, None, None, None]
    assert [r["experience_years"] for r in rows] == [None, 0, 60, None, 3, None, 2]


FEED = ("employee_id string, name string, department string, salary string, joining_date string, performance_rating double, "
        "manager string, attrition string, country string, skills array<string>, experience double, offset bigint, "
        "ingest_ts timestamp, ingest_date date")


def feed_row(key, offset, salary="75k", day=1, department="Engg."):
    ts = dt.datetime(2024, 1, day)
    return (key, "  Ann  ", department, salary, "2020-01-31", 4.7, " ", "y", " india ", ["b", "a", "b"], 3.0, offset, ts,
            ts.date())


def test_employee_pipeline(spark):
    rows = [feed_row("E1", 1), feed_row("E1", 2, "$90,000"), feed_row("E2", 3, "N/A", 2, "Legal"), feed_row(None, 4)]
    out = silver.silver_employees(spark.createDataFrame(rows, FEED), AS_OF)
    assert out.columns == list(silver.EMPLOYEE_COLUMNS)
    got = {r["employee_id"]: r for r in out.collect()}
    assert set(got) == {"E1", "E2"}
    e1 = got["E1"]
    assert (e1["salary"], e1["department"], e1["name"], e1["manager"], e1["attrition"], e1["country"]) == (
        90000.0, "Engineering", "Ann", None, "Yes", "India")
    assert (e1["performance_rating"], e1["skills"], e1["skills_count"], e1["experience_years"]) == (4, ["a", "b"], 2, 3)
    assert got["E2"]["salary_valid"] is False and got["E2"]["department_canonical"] is False


def test_employee_pipeline_order_of_dedupe_does_not_matter(spark):
    """Cleaning every delivery and deduplicating last gives the same table."""
    rows = [feed_row(f"E{i % 7}", i, f"{i}k", 1 + i % 3) for i in range(40)]
    raw = spark.createDataFrame(rows, FEED)
    late = raw.transform(silver.clean_salary).transform(silver.clean_department)
    late = silver.newest_employees(late).select("employee_id", "salary", "department", "salary_raw")
    early = silver.silver_employees(raw, AS_OF).select("employee_id", "salary", "department", "salary_raw")
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, early.collect()))


def test_attendance_hours_out_of_range_become_null(spark):
    ts = dt.datetime(2026, 5, 1)
    df = spark.createDataFrame(
        [("a1", "E1", dt.date(2026, 5, 1), 27.5, "Present", False, ts), ("a2", "E2", dt.date(2026, 5, 2), 8.0, "WFH", True, ts),
         ("a2", "E2", dt.date(2026, 5, 2), 8.0, "WFH", True, ts), ("a3", None, dt.date(2026, 5, 2), 1.0, "x", None, ts),
         ("a4", "E4", None, 1.0, "x", None, ts), ("a5", "E5", dt.date(2026, 5, 3), -1.0, None, None, ts)],
        "attendance_id string, employee_id string, work_date date, hours_worked double, status string, is_late boolean, "
        "event_ts timestamp")
    got = {r["attendance_id"]: r for r in silver.silver_attendance(df).collect()}
    assert set(got) == {"a1", "a2", "a5"}
    assert got["a1"]["hours_worked"] is None and got["a2"]["hours_worked"] == 8.0 and got["a5"]["hours_worked"] is None
    assert [got[k]["is_weekend"] for k in ("a1", "a2", "a5")] == [False, True, True]
    assert got["a1"]["status"] == "present" and got["a1"]["dow"] == 6


def test_performance_keeps_valid_ratings(spark):
    ts = dt.datetime(2026, 5, 1)
    df = spark.createDataFrame(
        [("r1", "E1", 4, 90.0, ts), ("r2", "E2", 9, 90.0, ts), ("r3", "E3", 2, -3.0, ts), ("r4", "E4", 1, None, ts),
         ("r5", None, 3, 1.0, ts), ("r6", "E6", None, 1.0, ts)],
        "review_id string, employee_id string, rating int, goals_met_pct double, event_ts timestamp")
    got = {r["review_id"]: r for r in silver.silver_performance(df).collect()}
    assert set(got) == {"r1", "r3", "r4"}
    assert got["r1"]["is_high_performer"] is True and got["r3"]["is_high_performer"] is False
    assert got["r3"]["goals_met_pct"] == 0.0 and got["r4"]["goals_met_pct"] is None


def test_recruitment_stages(spark):
    ts = dt.datetime(2026, 5, 1)
    df = spark.createDataFrame(
        [("a", "applied", ts), ("a", "applied", ts), ("a", "hired", ts), ("b", "ghosted", ts), (None, "offer", ts),
         ("c", "rejected", ts)], "application_id string, stage string, event_ts timestamp")
    rows = sorted((r["application_id"], r["stage"], r["stage_rank"]) for r in silver.silver_recruitment(df).collect())
    assert rows == [("a", "applied", 1), ("a", "hired", 5), ("c", "rejected", 6)]


def test_countries_keep_acronyms_on_request(spark):
    df = spark.createDataFrame([("USA",), (" UK ",), ("india",), ("INDIA",), ("Us",), ("",), (None,)], "country string")
    plain, kept = ([r["country"] for r in silver.clean_country(df, flag).collect()] for flag in (False, True))
    assert plain == ["Usa", "Uk", "India", "India", "Us", "", None]
    assert kept == ["USA", "UK", "India", "India", "Us", "", None]
    staff = spark.createDataFrame([feed_row("E1", 1)], FEED).withColumn("country", F.lit("UAE"))
    assert silver.silver_employees(staff, AS_OF, preserve_acronyms=True).first()["country"] == "UAE"
    assert silver.silver_employees(staff, AS_OF).first()["country"] == "Uae"
