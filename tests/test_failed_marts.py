"""A mart that fails in the build is an error of the queries that read all marts, never a shorter result."""

import datetime as dt

import pytest

from peoplelake import queries
from peoplelake.bindings import Tables, employees
from peoplelake.plans import catalog


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"C{i}", i % 2, ["BUILDING", "MACHINERY"][i % 2]) for i in range(1, 9)],
                          "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string").write.parquet(
        str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(0, "KENYA"), (1, "PERU")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame(
        [(i, 1 + i % 8, "FO"[i % 2], 60_000.0 + i, dt.datetime(1996 + i % 3, 1, 1), f"{1 + i % 5}-X") for i in range(40)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(queries, "_GOLD", {})
    return Tables(spark, str(tmp_path))


def narrated(t, name):
    return queries.REGISTRY[name](t.spark, t.folder).select("source_mart").distinct().count()


def test_rows_of_a_failed_mart_are_not_left_out(tables, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(queries, "written_employees", lambda t: employees(t).drop("salary"))
        with pytest.raises(RuntimeError, match="salary/by_department.*failed"):
            narrated(tables, "insight_rows")
    assert narrated(tables, "insight_rows") == 13  # the failed build is not kept


@pytest.mark.parametrize("lost", ["performance/vs_salary", "workforce/by_country"])
def test_summaries_of_absent_marts_are_not_left_out(tables, monkeypatch, lost):
    with monkeypatch.context() as broken:
        if lost.startswith("performance"):  # fails in the build
            broken.setattr(queries, "written_employees", lambda t: employees(t).drop("salary"))
        else:  # is written and can't be found again
            load = catalog.load_marts
            broken.setattr(catalog, "load_marts", lambda *found: {n: m for n, m in load(*found).items() if n != lost})
        with pytest.raises(RuntimeError, match=lost):
            narrated(tables, "insight_summaries")
    assert narrated(tables, "insight_summaries") == 14


def test_health_and_views_of_a_failed_build(tables, monkeypatch):
    monkeypatch.setattr(queries, "written_employees", lambda t: employees(t).drop("salary"))
    health = {r["artefact"]: r["present"] for r in queries.lake_health(tables).collect()}
    assert not health["salary/by_department"] and health["workforce/by_country"] and len(health) == 15
    assert queries.governed_sql(tables).count() == 3
