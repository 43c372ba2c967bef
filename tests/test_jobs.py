import datetime as dt

import pytest
from pyspark.sql import functions as F

from peoplelake.operators.quality import QualityGateError, Thresholds
from peoplelake.plans import jobs
from peoplelake.sources.lake import Lake, read_table, write_table
from peoplelake.sources.log import parse_messages
from tests.test_cleaning import FEED, feed_row
from tests.test_log_and_lake import messages

AS_OF = "2024-06-30"


def test_write_audit_publish(spark, lake):
    good = spark.createDataFrame([feed_row(f"E{i}", i) for i in range(20)], FEED)
    table, report = jobs.clean_employees(good, lake, AS_OF, fail_on_quality=True)
    assert table.count() == 20 and report.count() == 7
    bad = spark.createDataFrame([feed_row(f"E{i}", i, salary="TBD") for i in range(5)], FEED)
    strict = Thresholds(blocking=("invalid_salary_pct",))
    with pytest.raises(QualityGateError):
        jobs.clean_employees(bad, lake, AS_OF, thresholds=strict, fail_on_quality=True)
    assert read_table(spark, lake.silver("dim_employee")).count() == 20


def test_the_gate_sees_raw_rows(spark, lake):
    rows = [feed_row(f"E{i}", i) for i in range(10)] + [feed_row("E3", 50 + i) for i in range(4)] + [feed_row(None, 90), feed_row(None, 91)]
    feed = spark.createDataFrame(rows, FEED)
    for mode in jobs.MODES:
        table, report = jobs.clean_employees(feed, lake, AS_OF, mode=mode)
        got = {r["name"]: r for r in report.collect()}
        assert table.count() == 10 and got["null_employee_id_pct"]["value"] == got["duplicate_employee_id_ratio"]["value"] == 0.0
        assert got["raw_null_employee_id_pct"]["value"] == 2 / 16 and not got["raw_null_employee_id_pct"]["passed"]
        assert got["raw_duplicate_employee_id_ratio"]["value"] == 1 - 11 / 16 and got["raw_null_employee_id_pct"]["total_rows"] == 16
    with pytest.raises(QualityGateError, match="raw_duplicate_employee_id_ratio=0.3125"):
        jobs.clean_employees(feed, lake, AS_OF, thresholds=Thresholds(blocking=("raw_duplicate_employee_id_ratio",)), fail_on_quality=True)
    _, empty = jobs.clean_employees(feed.limit(0), lake, AS_OF)
    assert {r["value"] for r in empty.collect()} == {0.0}


def test_command_line_from_raw_to_insights(spark, lake):
    payloads = ['{"employee_id":"E%d","department":"%s","salary":"%dk","joining_date":"2020-01-%02d","attrition":"%s",'
                '"performance_rating":%d,"country":"india","experience":%d}'
                % (i, ["Engg", "HR", "Ops"][i % 3], 50 + i, 1 + i % 28, ["y", "n"][i % 2], 1 + i % 5, i % 30) for i in range(60)]
    write_table(parse_messages(messages(spark, payloads), "employee_csv"), lake.bronze("employee_csv"), "ingest_date")

    def run(*args):
        return jobs.main(["--lake", lake.root, "--as-of", AS_OF, *args], spark)

    assert run("gold") == jobs.EXIT_READ
    assert run("silver", "--stream", "attendance") == jobs.EXIT_READ
    assert run("silver", "--since", "2999-01-01") == jobs.EXIT_OK
    assert run("silver", "--fail-on-dq") == jobs.EXIT_OK
    assert read_table(spark, lake.silver("dim_employee")).count() == 60
    assert run("gold", "--marts", "no/mart") == jobs.EXIT_UNKNOWN_MART
    assert run("gold", "--fail-on-validation") == jobs.EXIT_OK
    assert read_table(spark, lake.gold("attrition/by_department")).count() == 3
    assert run("insights") == jobs.EXIT_OK
    assert read_table(spark, f"{lake.root}/vectors/insights").count() > 30


def test_fact_jobs_and_detail_marts(spark, lake):
    ts = dt.datetime(2024, 5, 1)
    versions = spark.createDataFrame(
        [("E1", "IT", "BLR", 100.0, True, dt.date(2020, 1, 1), None, ts), ("E1", "IT", "BLR", 120.0, False, dt.date(2020, 1, 1),
          dt.date(2022, 1, 1), dt.datetime(2024, 6, 1))],
        "employee_id string, department string, location string, base_salary double, is_active boolean, hire_date date, "
        "termination_date date, event_ts timestamp")
    attendance = spark.createDataFrame([("a1", "E1", dt.date(2024, 5, 1), 8.0, "Present", True, ts)],
        "attendance_id string, employee_id string, work_date date, hours_worked double, status string, is_late boolean, event_ts timestamp")
    reviews = spark.createDataFrame([("r1", "E1", "2024-H1", 5, 90.0, True, 10.0, ts)],
        "review_id string, employee_id string, cycle string, rating int, goals_met_pct double, promotion_flag boolean, "
        "bonus_amount double, event_ts timestamp")
    applications = spark.createDataFrame([("p1", "web", "offer", "IT", 5.0, ts)],
        "application_id string, source string, stage string, department string, offer_amount double, event_ts timestamp")
    for stream, raw in (("attendance", attendance), ("performance", reviews), ("recruitment", applications)):
        assert jobs.clean_fact(raw, lake, stream).count() == 1
    assert len(jobs.build_detail_marts(spark, lake, versions, AS_OF)) == 4
    row = read_table(spark, lake.gold("gold_headcount")).first()
    assert (row["headcount"], row["attrition_count"], row["avg_salary"], row["avg_tenure_years"]) == (1, 1, 120.0, 2.0)
    assert read_table(spark, lake.gold("gold_attendance_compliance")).first()["present_days"] == 1
    assert read_table(spark, lake.gold("gold_performance")).first()["total_bonus"] == 10.0
    assert read_table(spark, lake.gold("gold_recruitment_funnel")).first()["offer"] == 1
    # the same from the command line, once the versions have landed
    assert jobs.main(["--lake", lake.root, "--as-of", AS_OF, "gold", "--detail"], spark) == jobs.EXIT_READ
    write_table(versions.withColumn("ingest_date", F.lit(dt.date(2024, 6, 1))), lake.bronze(jobs.HRIS), "ingest_date")
    assert jobs.main(["--lake", lake.root, "--as-of", AS_OF, "gold", "--detail"], spark) == jobs.EXIT_OK
    assert read_table(spark, lake.gold("gold_headcount")).first()["avg_salary"] == 120.0


def test_history_in_parts_equals_history_at_once(spark, lake, tmp_path):
    def version(employee, day, pay):
        return (employee, "IT", pay, pay > 100, dt.datetime(2024, 1, day))

    ddl = "employee_id string, department string, base_salary double, is_active boolean, event_ts timestamp"
    rows = [version("E1", 1, 100.0), version("E1", 5, 120.0), version("E1", 9, 130.0), version("E2", 3, 90.0), version(None, 4, 1.0)]
    frames = [spark.createDataFrame(part, ddl) for part in ([rows[2], rows[3], rows[3]], [rows[0], rows[1], rows[2], rows[4]], [])]
    whole = Lake(str(tmp_path / "whole"))
    once = jobs.clean_versions(spark.createDataFrame(rows + rows, ddl).withColumn("offset", F.monotonically_increasing_id()), whole)
    for frame in frames:  # late versions, overlaps, and nothing at all
        parts = jobs.clean_versions(frame, lake, "merge")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, once.collect()))
    got = [(r["event_ts"].day, r["valid_to"] and r["valid_to"].day, r["is_current"])
           for r in parts.filter("employee_id = 'E1'").orderBy("event_ts").collect()]
    assert got == [(1, 5, False), (5, 9, False), (9, None, True)] and parts.count() == 4
    # the command: raw rows to the history, which the detail marts then read
    raw = spark.createDataFrame(rows, ddl).withColumn("ingest_date", F.lit(dt.date(2024, 6, 1)))
    write_table(raw, whole.bronze(jobs.HRIS), "ingest_date")
    assert jobs.main(["--lake", whole.root, "silver", "--stream", jobs.HRIS], spark) == jobs.EXIT_OK
    again = read_table(spark, whole.silver(jobs.HISTORY))
    assert again.count() == 4 and jobs.current_staff(again.withColumn("hire_date", F.col("event_ts").cast("date")).withColumn(
        "termination_date", F.lit(None).cast("date")), AS_OF).count() == 2
