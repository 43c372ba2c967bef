import pytest

from peoplelake.operators.quality import QualityGateError, Thresholds, enforce, failures, known_checks, quality_report

DDL = "employee_id string, salary_valid boolean, joining_date_valid boolean, department_canonical boolean"


def report(df, *args):
    return {r["name"]: r for r in quality_report(df, *args).collect()}


def test_clean_table_passes(spark):
    got = report(spark.createDataFrame([(f"E{i}", True, True, True) for i in range(10)], DDL))
    assert list(got) and set(got) == {n for n in known_checks() if not n.startswith("raw_")}
    assert all(r["passed"] and r["value"] == 0.0 and r["total_rows"] == 10 for r in got.values())
    assert {n for n, r in got.items() if r["blocking"]} == {"null_employee_id_pct", "duplicate_employee_id_ratio"}


def test_ratios_thresholds_and_gate(spark):
    rows = [("E1", False, True, None), ("E1", True, True, False), (None, True, True, True), ("E2", True, False, True)]
    full = quality_report(spark.createDataFrame(rows, DDL))
    got = {r["name"]: r for r in full.collect()}
    assert got["null_employee_id_pct"]["value"] == 0.25
    # Ids E1, E2 and the missing one are three distinct values of four rows.
    assert got["duplicate_employee_id_ratio"]["value"] == 0.25
    assert got["invalid_salary_pct"]["value"] == 0.25 and not got["invalid_salary_pct"]["passed"]
    assert got["unknown_department_pct"]["value"] == 0.25
    assert failures(full).count() == 5 and failures(full, blocking_only=True).count() == 2
    with pytest.raises(QualityGateError, match="null_employee_id_pct=0.2500"):
        enforce(full)
    lax = Thresholds(blocking=("invalid_salary_pct",), invalid_salary_pct=0.5)
    enforce(quality_report(spark.createDataFrame(rows, DDL), lax))


def test_empty_table_and_missing_columns(spark):
    got = report(spark.createDataFrame([], DDL))
    assert all(r["value"] == 0.0 and r["passed"] for r in got.values())
    assert set(report(spark.createDataFrame([("E1",)], "employee_id string"))) == {
        "null_employee_id_pct", "duplicate_employee_id_ratio"}
