"""Incremental loads, repeated builds and long streams lose and repeat nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from peoplelake import bindings
from peoplelake.functions.text import stable_id
from peoplelake.plans import gold, jobs
from peoplelake.sources.lake import read_table, write_table
from peoplelake.sources.log import file_stream, parse_messages
from peoplelake.streaming.ingest import batch_log, progress_report, start_ingest, watch
from tests.test_log_and_lake import messages

AS_OF = "2024-06-30"


def payload(i, dept, day):
    return '{"employee_id":"E%d","department":"%s","salary":"50k","joining_date":"2020-01-01","attrition":"n"}' % (i, dept), day


def land(spark, lake, deliveries):
    for day in sorted({d for _, d in deliveries}):
        texts = [p for p, d in deliveries if d == day]
        stamp = F.lit(day).cast("timestamp")
        write_table(parse_messages(messages(spark, texts), "employee_csv", stamp), lake.bronze("employee_csv"), "ingest_date",
                    mode="append")


def test_since_merges_and_moves_between_partitions(spark, lake):
    land(spark, lake, [payload(1, "HR", "2024-05-01"), payload(2, "HR", "2024-05-01"), payload(3, "Ops", "2024-05-01"),
                       payload(2, "Ops", "2024-05-02"), payload(4, "HR", "2024-05-02")])

    def run(*args):
        return jobs.main(["--lake", lake.root, "--as-of", AS_OF, "silver", *args], spark)

    def table():
        rows = read_table(spark, lake.silver("dim_employee")).select("employee_id", "department").collect()
        return sorted(tuple(r) for r in rows)

    assert run() == jobs.EXIT_OK
    full = table()
    assert len(full) == 4 and len({i for i, _ in full}) == 4
    for _ in range(2):
        assert run("--since", "2024-05-02") == jobs.EXIT_OK and table() == full
    assert run("--since", "2024-05-02", "--mode", "overwrite") == jobs.EXIT_BUILD and table() == full
    land(spark, lake, [payload(1, "Ops", "2024-05-03")])
    assert run("--since", "2024-05-03") == jobs.EXIT_OK
    assert [d for i, d in table() if i == "E1"] == [d for i, d in full if i == "E2"] and len(table()) == 4
    with pytest.raises(ValueError):
        jobs.clean_employees(spark.read.parquet(lake.bronze("employee_csv")), lake, AS_OF, mode="append")


def test_facts_merge(spark, lake):
    ddl = "review_id string, employee_id string, cycle string, rating int, goals_met_pct double, promotion_flag boolean, " \
          "bonus_amount double, event_ts timestamp"

    def reviews(*rows):
        return spark.createDataFrame(
            [(i, "E1", cycle, rating, 1.0, False, 1.0, dt.datetime(2024, 1, day)) for i, cycle, rating, day in rows], ddl)

    jobs.clean_fact(reviews(("a", "H1", 3, 1), ("b", "H1", 4, 1)), lake, "performance")
    out = jobs.clean_fact(reviews(("a", "H2", 5, 2), ("c", "H1", 2, 2), ("b", "H1", 1, 1)), lake, "performance", "merge")
    assert sorted((r["review_id"], r["cycle"], r["rating"]) for r in out.collect()) == [("a", "H2", 5), ("b", "H1", 1), ("c", "H1", 2)]


@pytest.fixture
def staff(spark):
    return spark.createDataFrame(
        [(f"E{i}", f"N{i}", ["HR", "IT", "Ops"][i % 3], "India", 100.0 * (i % 3) + i, "No", dt.date(2020, 1, 1), 3, 4) for i in range(30)],
        "employee_id string, name string, department string, country string, salary double, attrition string, joining_date date, "
        "performance_rating int, experience_years int")


def test_append_ranks_each_snapshot_alone(spark, lake, staff):
    for day in ("2024-01-01", "2024-02-01"):
        status = {r["mart"]: r for r in gold.build_all(staff, lake, day, mode="append").collect()}
        assert all(r["passed"] and r["status"] == "written" for r in status.values())
        assert status["salary/top_paying_depts"]["rows"] == 3
    board = read_table(spark, lake.gold("salary/top_paying_depts"))
    assert board.groupBy("snapshot_date", "department").count().filter("count > 1").count() == 0 and board.count() == 6


def test_failing_base_fails_its_leaderboard(spark, lake, staff):
    gold.build_all(staff, lake, "2024-01-01").collect()
    status = {r["mart"]: r for r in gold.build_all(staff.drop("salary"), lake, "2024-02-01").collect()}
    assert status["salary/top_paying_depts"]["status"] == "failed" == status["salary/by_department"]["status"]
    assert status["workforce/by_country"]["status"] == "written"
    board = read_table(spark, lake.gold("salary/top_paying_depts"))
    assert board.select("snapshot_date").distinct().collect() == [(dt.date(2024, 1, 1),)]


def test_failing_cells_are_status_rows(lake, staff):
    status = {r["mart"]: r["status"] for r in gold.build_all(staff.drop("country"), lake, "2024-01-01").collect()}
    assert status["workforce/by_country"] == "failed" and status["salary/by_department"] == "written" and len(status) == 14


def test_empty_snapshot_is_seen_in_append(spark, lake, staff):
    gold.build_all(staff, lake, "2024-01-01", names=["workforce/by_country"]).collect()
    row = gold.build_all(staff.limit(0), lake, "2024-02-01", names=["workforce/by_country"], mode="append").first()
    assert not row["passed"] and row["detail"] == "empty_mart"


def test_long_ids_stay_different(spark):
    df = spark.createDataFrame([("x" * 600 + "1",), ("x" * 600 + "2",), ("short",)], "v string")
    ids = [r[0] for r in df.select(stable_id("a", k="v")).collect()]
    assert len(set(ids)) == 3 and max(map(len, ids)) == 512 and ids[2] == "a.k=short"


def test_progress_covers_more_batches_than_the_query_remembers(spark, lake, tmp_path):
    source, n = tmp_path / "in", 25
    for i in range(n):
        messages(spark, [f'{{"attendance_id":"{i}-{k}"}}' for k in range(i + 1)]).coalesce(1).write.mode("append").parquet(str(source))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 4)
    try:
        stream = file_stream(spark, f"{source}/*.parquet", messages(spark, ["x"]).schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "),
                             max_files_per_trigger=1)
        query = start_ingest(stream, "attendance", lake)
        batches = watch(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    report = progress_report(spark, batches)
    assert len(query.recentProgress) <= 4 < report.count()
    total = n * (n + 1) // 2
    assert report.agg(F.sum("input_rows")).first()[0] == total == spark.read.parquet(lake.bronze("attendance")).count()


def test_quick_batches_are_all_reported(spark, tmp_path):
    """More batches than a query remembers, by far, each of a few milliseconds; two queries at once."""
    def start(name, n):
        spark.range(n).repartitionByRange(n, "id").write.parquet(str(tmp_path / name))
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
        return stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / f"{name}-log")).trigger(availableNow=True).start()

    batch_log(spark)
    queries = {n: start(f"q{n}", n) for n in (150, 5)}
    for n, query in queries.items():
        batches = watch(query)
        assert sorted(batches) == list(range(n)) and sum(p.numInputRows for p in batches.values()) == n


def test_missing_values_are_json_nulls(spark):
    text = bindings.json_text(("a", F.lit(None).cast("string"), True), ("b", F.lit(1), False))
    assert spark.range(1).select(text).first()[0] == '{"a":null,"b":1}'
