import datetime as dt
import math
import statistics

import pytest

from peoplelake.sources.lake import read_table
from peoplelake.operators import marts as op
from peoplelake.plans import gold
from peoplelake.plans.catalog import lake_health

AS_OF = "2024-06-30"
DDL = ("employee_id string, department string, country string, salary double, joining_date date, attrition string, "
       "performance_rating int, experience_years int")


@pytest.fixture(scope="module")
def people(spark):
    rows = []
    for i in range(120):
        rows.append((
            f"E{i}", [None, "IT", "Sales", "HR"][i % 4], ["India", "Uk", None][i % 3],
            None if i % 7 == 0 else 100_000.0 + i * 1000.25, None if i % 11 == 0 else dt.date(2010 + i % 15, 1 + i % 6, 1 + i % 28),
            ["Yes", "No", None][i % 3] if i % 5 else "No", None if i % 6 == 0 else 1 + i % 5, None if i % 9 == 0 else i % 30))
    return spark.createDataFrame(rows, DDL).repartition(3)


def by(rows, key):
    return {r[key]: r for r in rows}


def test_attrition_counts(people):
    local = people.collect()
    got = by(gold.BY_NAME["attrition/by_department"].build(people, AS_OF).collect(), "department")
    assert set(got) == {"IT", "Sales", "HR"}
    for dept, row in got.items():
        mine = [r for r in local if r["department"] == dept]
        left = sum(r["attrition"] == "Yes" for r in mine)
        assert (row["headcount"], row["attrited"], row["active"]) == (
            len(mine), left, sum(r["attrition"] == "No" for r in mine))
        assert row["attrition_rate"] == round(left / len(mine), 4) and row["snapshot_date"] == dt.date(2024, 6, 30)


def test_buckets_at_their_bounds(spark):
    rows = [(f"E{i}", "IT", "India", 1.0, d, "Yes", 3, x) for i, (d, x) in enumerate([
        (dt.date(2023, 7, 1), 0), (dt.date(2023, 6, 30), 2), (dt.date(2021, 6, 30), 5), (dt.date(2019, 6, 30), 10),
        (dt.date(2014, 6, 30), 20), (None, None)])]
    df = spark.createDataFrame(rows, DDL)
    tenure = by(gold.BY_NAME["attrition/by_tenure_bucket"].build(df, AS_OF).collect(), "tenure_bucket")
    assert list(tenure) == list(gold.TENURE_BUCKETS) and all(r["headcount"] == 1 for r in tenure.values())
    seniority = gold.BY_NAME["workforce/experience_distribution"].build(df, AS_OF).collect()
    assert [(r["experience_bucket"], r["share_pct"]) for r in seniority] == [(b, 0.2) for b in gold.EXPERIENCE_BUCKETS]


def test_salary_statistics(people):
    local = people.collect()
    rows = gold.BY_NAME["salary/by_department"].build(people, AS_OF).collect()
    assert [r["avg_salary"] for r in rows] == sorted((r["avg_salary"] for r in rows), reverse=True)
    assert {r["department"] for r in rows} == {None, "IT", "Sales", "HR"}
    for r in rows:
        pay = sorted(x["salary"] for x in local if x["department"] == r["department"] and x["salary"] is not None)
        n = len(pay)
        assert r["employees_with_salary"] == n and r["total_payroll"] == round(sum(pay), 2)
        assert r["avg_salary"] == pytest.approx(sum(pay) / n, abs=0.006)
        assert r["stddev_salary"] == pytest.approx(statistics.stdev(pay), abs=0.006)
        for name, p in (("p25", .25), ("median", .5), ("p75", .75), ("p90", .9)):
            assert r[f"{name}_salary"] == pay[math.ceil(p * n) - 1]
        assert (r["min_salary"], r["max_salary"]) == (pay[0], pay[-1])
    whole = gold.BY_NAME["salary/distribution"].build(people, AS_OF).first()
    pay = sorted(x["salary"] for x in local if x["salary"] is not None)
    assert whole["p99_salary"] == pay[math.ceil(.99 * len(pay)) - 1] and whole["total_payroll"] == round(sum(pay), 2)


def test_leaderboards_keep_ties_and_team_size(spark):
    scores = spark.createDataFrame([("a", 5.0, 9), ("b", 5.0, 9), ("c", 4.0, 9), ("d", 3.0, 9), ("e", 9.0, 1)],
                                   "department string, m double, n int")
    got = op.leaderboard(scores, "m", 2, eligible=scores["n"] >= 5).collect()
    assert sorted((r["rank"], r["department"]) for r in got) == [(1, "a"), (1, "b"), (2, "c")]


def test_count_marts_from_cells_equal_marts_from_rows(people):
    """The build job's shared pass gives the same marts as each mart on its own."""
    cells = gold.cells(people, AS_OF)
    assert {r["cell_set"] for r in cells.collect()} == set(gold.CELL_SETS)
    for mart in gold.MARTS:
        if mart.cell_set:
            assert [tuple(r) for r in mart.build_from_cells(cells, AS_OF).collect()] == [tuple(r) for r in mart.build(people, AS_OF).collect()]


def test_mart_has_one_exchange_besides_its_sort(people):
    plan = gold.BY_NAME["workforce/by_country"].build(people, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_build_all_writes_validates_and_isolates(spark, people, lake):
    broken = gold.Mart("broken", "mart", lambda df, as_of: df.select("no_such_column"), ("x",))
    partial = gold.Mart("partial", "mart", lambda df, as_of: df.select("department"), ("department", "absent"))
    status = by(gold.build_all(people, lake, AS_OF, registry=(*gold.MARTS, broken, partial)).collect(), "mart")
    assert len(status) == 16
    assert status["broken/mart"]["status"] == "failed" and not status["broken/mart"]["passed"]
    assert status["partial/mart"]["detail"] == "missing_columns=['absent']"
    good = [r for n, r in status.items() if n not in ("broken/mart", "partial/mart")]
    assert all(r["passed"] and r["status"] == "written" and r["rows"] > 0 for r in good)
    board = read_table(spark, lake.gold("salary/top_paying_depts"))
    direct = gold.BY_NAME["salary/top_paying_depts"].build(people, AS_OF)
    assert sorted(map(tuple, board.collect())) == sorted(map(tuple, direct.select(board.columns).collect()))
    health = by(lake_health(spark, lake).collect(), "artefact")
    assert len(health) == 14 and all(r["ready"] for r in health.values())


def test_subset_unknown_and_strict(people, lake):
    only = gold.build_all(people, lake, AS_OF, names=["attrition/by_country"]).collect()
    assert [r["mart"] for r in only] == ["attrition/by_country"]
    with pytest.raises(ValueError, match="nope"):
        gold.build_all(people, lake, AS_OF, names=["nope/mart"])
    with pytest.raises(RuntimeError, match="attrition/by_country"):
        gold.build_all(people.filter("country = 'Atlantis'"), lake, AS_OF, names=["attrition/by_country"], strict=True)


def test_validation_messages(people):
    empty = gold.validation_row("m", people.limit(0), ["department"]).first()
    assert (empty["passed"], empty["detail"], empty["columns"]) == (False, "empty_mart", 8)
    few = gold.validation_row("m", people.limit(2), ["zz"], min_rows=3).first()
    assert few["detail"] == "too_few_rows=2<3; missing_columns=['zz']"


def test_detail_marts(spark):
    staff = spark.createDataFrame([("E1", "IT", "BLR"), ("E2", "HR", "DEL")], "employee_id string, department string, location string")
    att = spark.createDataFrame(
        [("E1", "present", True, 8.0)] * 3 + [("E1", "wfh", False, None), ("E2", "absent", None, 0.0), ("E9", "leave", False, 1.0)],
        "employee_id string, status string, is_late boolean, hours_worked double")
    got = by(gold.attendance_compliance(att, staff, AS_OF).collect(), "department")
    assert (got["IT"]["total_records"], got["IT"]["present_days"], got["IT"]["wfh_days"], got["IT"]["late_count"]) == (4, 3, 1, 3)
    assert (got["IT"]["avg_hours_worked"], got["IT"]["attendance_rate"]) == (8.0, 0.75)
    assert got[None]["leave_days"] == 1 and got[None]["location"] is None

    reviews = spark.createDataFrame(
        [("E1", "H1", 5, True, True, 80.0, 10.5), ("E1", "H1", 2, False, False, None, None), ("E2", "H1", 4, True, None, 50.0, 1.0)],
        "employee_id string, cycle string, rating int, is_high_performer boolean, promotion_flag boolean, "
        "goals_met_pct double, bonus_amount double")
    got = by(gold.review_outcomes(reviews, staff, AS_OF).collect(), "department")
    it = got["IT"]
    assert (it["reviews"], it["avg_rating"], it["high_performers"], it["promotions"], it["hp_share"]) == (2, 3.5, 1, 1, 0.5)
    assert (it["avg_goals_met_pct"], it["total_bonus"]) == (80.0, 10.5)

    apps = spark.createDataFrame(
        [("a", "offer"), ("a", "offer"), ("b", "offer"), ("a", "hired"), ("c", "applied")], "application_id string, stage string"
    ).selectExpr("application_id", "stage", "'IT' department", "'web' source")
    row = gold.recruitment_funnel(apps, AS_OF).first()
    assert (row["applied"], row["offer"], row["hired"], row["rejected"], row["offer_to_hire_rate"]) == (1, 2, 1, 0, 0.5)
    none = gold.recruitment_funnel(apps.filter("stage = 'applied'"), AS_OF).first()
    assert none["offer_to_hire_rate"] == 0.0

    current = spark.createDataFrame(
        [("IT", "BLR", True, 100.0, 365), ("IT", "BLR", False, 50.0, 730), ("IT", "BLR", None, None, None)],
        "department string, location string, is_active boolean, base_salary double, tenure_days int")
    row = gold.headcount(current, AS_OF).first()
    assert (row["headcount"], row["active_headcount"], row["attrition_count"], row["avg_salary"]) == (3, 1, 1, 75.0)
    assert (row["avg_tenure_years"], row["attrition_rate"]) == (1.5, 0.3333)


def test_hot_fact_key_joins_as_one_row(spark):
    """Facts are folded to one row per key before the join, so the join input does not grow with a hot key."""
    facts = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END employee_id",
                                         "'present' status", "true is_late", "8.0D hours_worked")
    staff = spark.createDataFrame([("hot", "IT", "BLR")], "employee_id string, department string, location string")
    out = gold.attendance_compliance(facts, staff, AS_OF)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftOuter")
    assert "Aggregate [employee_id" in plan[join:]
    assert by(out.collect(), "department")["IT"]["total_records"] == 3000
