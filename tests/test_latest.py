import datetime as dt

from peoplelake.operators.latest import latest_per_key, mark_current, upsert
from peoplelake.plans import jobs
from peoplelake.sources import versions

DDL = "k string, ts int, offset int, v string"


def test_newest_wins_nulls_last_and_ties_are_repeatable(spark):
    rows = [("a", 1, 1, "old"), ("a", 2, 1, "low"), ("a", 2, 9, "new"), ("b", None, 5, "x"), ("b", 1, 1, "dated"),
            ("c", 1, 1, "tie-a"), ("c", 1, 1, "tie-b")]
    expected = [("a", "new"), ("b", "dated"), ("c", "tie-b")]
    for order in (rows, rows[::-1]):
        got = latest_per_key(spark.createDataFrame(order, DDL).repartition(3), ["k"], ["ts", "offset"])
        assert sorted((r["k"], r["v"]) for r in got.collect()) == expected


def test_dedupe_without_metadata_keeps_one_row_per_key(spark):
    got = latest_per_key(spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, n int"), ["k"]).collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("b", 2)]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END k", "id ts")
    plan = latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:], plan


def test_merged_tables_are_shuffled_and_sorted_once(spark, tmp_path):
    old = spark.createDataFrame(
        [("a", 1, "old"), ("b", 5, "late"), ("c", None, "undated"), ("d", None, "undated"), ("e", 2, "dated"), ("f", 1, "alone"),
         (None, 1, "old")], "k string, ts int, v string")
    new = spark.createDataFrame(
        [("a", 1, "tie"), ("b", 4, "early"), ("c", 0, "dated"), ("d", None, "tie"), ("e", None, "undated"), ("g", None, "alone"),
         (None, 2, "new")], "k string, ts int, v string")
    path = str(tmp_path / "table")
    for batch in (old, new):
        versions.upsert_version(batch, path, ["k"], "ts")
    for both in (jobs.merged(old, new, ["k"], "ts"), versions.read_current(spark, path)):
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(k") == 1 and "Sort" not in plan[plan.index("Exchange"):], plan
        assert {r["k"]: r["v"] for r in both.collect()} == {
            "a": "tie", "b": "late", "c": "dated", "d": "tie", "e": "dated", "f": "alone", "g": "alone", None: "new"}
        assert both.count() == 8


def test_current_version_contract(spark):
    df = spark.createDataFrame(
        [("E1", "SDE", dt.datetime(2026, 1, 1)), ("E1", "SDE-2", dt.datetime(2026, 4, 1)), ("E2", "QA", dt.datetime(2026, 1, 1))],
        "employee_id string, job_title string, event_ts timestamp")
    got = {(r["employee_id"], r["job_title"]): r["is_current"] for r in mark_current(df, "employee_id").collect()}
    assert got == {("E1", "SDE"): False, ("E1", "SDE-2"): True, ("E2", "QA"): True}


def test_current_version_keeps_every_row_and_flags_one(spark):
    rows = [("hot", i % 50, "v") for i in range(600)] + [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), (None, 3, "n")]
    df = spark.createDataFrame(rows, "k string, ts int, v string").repartition(5)
    got = mark_current(df, "k", "ts").collect()
    assert len(got) == len(rows)
    assert sum(r["is_current"] for r in got if r["k"] == "hot") == 1
    assert [(r["ts"], r["v"]) for r in got if r["k"] == "a" and r["is_current"]] == [(1, "y")]
    assert not any(r["is_current"] for r in got if r["k"] is None)


def test_upsert_replaces_inserts_and_is_idempotent(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "chunk_id string, text string")
    new = spark.createDataFrame([("b", "0"), ("c", "3")], "chunk_id string, text string")
    once = upsert(old, new, "chunk_id")
    expected = [("a", "1"), ("b", "0"), ("c", "3")]
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, upsert(once, new, "chunk_id").collect())) == expected
