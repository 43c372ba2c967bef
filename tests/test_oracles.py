"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, rows_of, same

FOLDER = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
WITHOUT_ORACLE = {"embed_text", "document_search"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_registry_and_oracles_agree():
    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own - set(entry.oracle_sql()) == WITHOUT_ORACLE
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_ORACLES)))
def test_oracle(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    assert [(g, w) for g, w in zip(got, want) if not all(same(a, b) for a, b in zip(g, w))] == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["department", "headcount", "attrited", "active", "attrition_rate", "snapshot_date"]
    assert df.count() > 0


def test_document_search_matches_brute_force(spark):
    import numpy as np

    from peoplelake.operators.retrieval import embed

    docs = embed(spark.read.parquet(f"{FOLDER}/documents.parquet"), "text").select("doc_id", "embedding").collect()
    asked = embed(spark.read.parquet(f"{FOLDER}/benchmark.parquet"), "text").select("item_id", "embedding").collect()
    matrix = np.array([r["embedding"] for r in docs], dtype=float)
    norms = np.linalg.norm(matrix, axis=1)
    expected = {}
    for q in asked:
        v = np.array(q["embedding"], dtype=float)
        sims = np.round(np.divide(matrix @ v, norms * np.linalg.norm(v), out=np.zeros(len(docs)), where=norms > 0), 9)
        ranked = sorted(zip(-sims, [r["doc_id"] for r in docs]))[:5]
        expected[q["item_id"]] = [d for _, d in ranked]
    got = {}
    for r in entry.queries()["document_search"](spark, FOLDER).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    assert got == expected


NO_PAIRS = sorted(set(entry.queries()) - set(entry.LLM_QUERIES) - {"stream_bronze_ingest", "scan_formats_roundtrip", "gold_build_all",
                                         "silver_write_roundtrip", "attrition_from_dirty_feed"})


@pytest.mark.parametrize("name", NO_PAIRS)
def test_plans_have_no_cross_or_nested_loop_join(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
