"""The marts of a build read one written employee table, however many of them scan it."""

import os

import pytest

from peoplelake import bindings, queries
from peoplelake.plans import gold

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_employees_are_joined_once_for_all_marts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(gold, "build_all", lambda employees, *rest, **options: seen.append(employees) or employees.limit(0))
    tables = bindings.Tables(spark, FOLDER)
    monkeypatch.setattr(queries, "_GOLD", {})
    monkeypatch.setattr(queries.catalog, "load_marts", lambda *rest: {})
    queries.built_gold(tables)
    queries.gold_build_all(tables)
    assert len(seen) == 2
    for employees in seen:
        plan = employees._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
        assert sorted(map(tuple, employees.collect()), key=repr) == sorted(map(tuple, bindings.employees(tables).collect()), key=repr)
