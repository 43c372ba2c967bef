import numpy as np
import pytest
from pyspark.sql import functions as F

from peoplelake.operators import retrieval as rt


def brute(corpus, queries, k, keep=lambda i: True):
    out = {}
    for q, qv in queries:
        scored = []
        for i, v in corpus:
            if keep(i):
                norm = np.linalg.norm(v) * np.linalg.norm(qv)
                scored.append((-round(float(np.dot(v, qv) / norm), 9) if norm else 0.0, i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    corpus = [(i, rng.normal(size=8).astype(np.float32)) for i in range(300)]
    # A third of the corpus are copies of one vector, plus a zero vector.
    corpus += [(1000 + i, corpus[7][1]) for i in range(150)] + [(5000, np.zeros(8, np.float32))]
    queries = [(q, rng.normal(size=8)) for q in range(6)] + [(99, corpus[7][1].astype(float))]
    c = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in corpus], "id bigint, v array<float>, g int").repartition(5)
    q = spark.createDataFrame([(i, list(map(float, v))) for i, v in queries], "query_id int, query_vector array<double>")
    return corpus, queries, c, q


def ids(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.mark.parametrize("slice_rows", [4096, 2])
def test_top_k_matches_brute_force(spark, vectors, slice_rows):
    corpus, queries, c, q = vectors
    hits = rt.cosine_top_k(c, q, id_col="id", vector_col="v", k=7, min_similarity=-1.0, slice_rows=slice_rows)
    assert ids(hits) == brute(corpus, queries, 7)


def test_filter_runs_before_and_floor_after(spark, vectors):
    corpus, queries, c, q = vectors
    hits = rt.cosine_top_k(c, q, id_col="id", vector_col="v", k=5, where={"g": 1}, min_similarity=0.3)
    full = brute(corpus, queries, 5, lambda i: i % 3 == 1)
    for query_id, found in ids(hits).items():
        assert found == full[query_id][: len(found)]
    assert hits.filter("similarity < 0.3").count() == 0
    assert set(ids(hits)) <= set(full)


def test_small_chunks_of_scores_give_the_same_answer(spark, vectors, monkeypatch):
    corpus, queries, _, _ = vectors
    monkeypatch.setattr(rt, "SCORE_CELLS", 3)
    got = rt._best_of_batch(np.array([i for i, _ in corpus]), rt._unit_rows([v for _, v in corpus]),
                            np.array([i for i, _ in queries]), rt._unit_rows([v for _, v in queries]), 4)
    best = {q: g.sort_values(["similarity", "i"], ascending=[False, True])["i"].tolist() for q, g in got.groupby("q")}
    assert best == brute(corpus, queries, 4)


def test_no_queries_gives_an_empty_result(spark, vectors):
    _, _, c, q = vectors
    assert rt.cosine_top_k(c, q.filter("query_id < 0"), id_col="id", vector_col="v").count() == 0


def test_pack_context_keeps_a_prefix(spark):
    hits = spark.createDataFrame(
        [(1, "a", 0.9, 1, "x" * 10), (1, "b", 0.8, 2, "y" * 500), (1, "c", 0.7, 3, "z"), (2, "d", 0.5, 1, None)],
        "query_id int, chunk_id string, similarity double, rank int, text string")
    rows = rt.pack_context(hits, max_chars=100).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["line"]) for r in rows] == [(1, "- [a | sim=0.90] " + "x" * 10), (2, "- [d | sim=0.50] ")]


def test_hashed_vectors_are_unit_length_and_count_terms(spark):
    df = spark.createDataFrame([("the cat the",), ("Cat, THE the!",), ("",), (None,)], "text string")
    rows = [np.array(r["embedding"]) for r in rt.embed(df, "text").collect()]
    assert np.allclose(np.linalg.norm(rows[0]), 1.0, atol=1e-6) and np.allclose(rows[0], rows[1])
    assert sorted(np.round(rows[0][rows[0] > 0] ** 2, 3)) == [0.2, 0.8]
    assert len(rows[2]) == rt.DIMENSIONS and not rows[2].any() and not rows[3].any()


def test_hashed_vectors_match_term_counts_on_documents(spark):
    """Cosine of hashed vectors equals the cosine of the hashed count vectors computed by hand."""
    import re

    docs = ["alpha beta beta", "beta gamma", "delta"]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, text string")
    got = {r["i"]: np.array(r["embedding"]) for r in rt.embed(df, "text").collect()}
    words = {w: np.flatnonzero(np.array(rt.embed(spark.createDataFrame([(w,)], "text string"), "text").first()["embedding"]))[0]
             for w in {w for d in docs for w in re.findall(r"\w+", d)}}
    for i, d in enumerate(docs):
        counts = np.zeros(rt.DIMENSIONS)
        for w in re.findall(r"\w+", d):
            counts[words[w]] += 1
        assert np.allclose(got[i], counts / np.linalg.norm(counts), atol=1e-6)


def test_hashed_places_are_those_of_md5(spark):
    import hashlib

    got = rt.embed(spark.createDataFrame([("Ünder_the 42nd,\ttree the",)], "text string"), "text").first()["embedding"]
    want = np.zeros(rt.DIMENSIONS)
    for w in ["ünder", "the", "42nd", "tree", "the"]:
        want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % rt.DIMENSIONS] += 1
    assert np.allclose(got, want / np.linalg.norm(want), atol=1e-7)


def test_own_encoder_runs_in_batches(spark):
    def encoder(texts):
        assert len(texts) <= 4
        return np.array([[len(t), 1.0, 0.0] for t in texts])

    df = spark.range(30).select(F.repeat(F.lit("a"), F.col("id").cast("int")).alias("text")).repartition(2)
    rows = rt.embed(df, "text", encoder, batch_size=4).collect()
    assert len(rows) == 30
    for r in rows:
        v = np.array([len(r["text"]), 1.0, 0.0])
        assert np.allclose(r["embedding"], v / np.linalg.norm(v), atol=1e-6)


def test_delete_where_and_reset(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("c", None, 1)], "id string, domain string, n int")
    assert sorted(r["id"] for r in rt.delete_where(df, {"domain": "x"}).collect()) == ["c"]
    assert sorted(r["id"] for r in rt.delete_where(df, {"domain": "x", "n": 1}).collect()) == ["b", "c"]
    assert rt.delete_where(df, {}).count() == 3 and rt.reset(df).count() == 0


def test_scoring_travels_with_the_task():
    """Workers that cannot import this package can still run the scoring helpers."""
    from pyspark import cloudpickle

    shipped = cloudpickle.dumps(rt._best_of_batch)
    code = ("import sys, pickle; sys.modules['peoplelake'] = None; "
            "fn = pickle.loads(sys.stdin.buffer.read()); print(fn.__name__)")
    import subprocess
    import sys

    done = subprocess.run([sys.executable, "-c", code], input=shipped, capture_output=True, timeout=60, cwd="/")
    assert done.stdout.decode().strip() == "_best_of_batch", done.stderr.decode()[-500:]


def test_twenty_thousand_queries_are_one_lazy_plan(spark):
    rng = np.random.default_rng(8)
    corpus, asked = np.round(rng.normal(size=(700, 6)), 1), np.round(rng.normal(size=(20_000, 6)), 1)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id bigint, v array<double>").repartition(5)
    q = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(asked)], "query_id string, query_vector array<double>")
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (asked, corpus)]
    scores = np.round(unit[0] @ unit[1].T, rt.SIMILARITY_DIGITS)
    want = np.argsort(-scores, axis=1, kind="stable")[:, :3]
    for slice_rows in (900, 7000):
        hits = rt.cosine_top_k(c, q, id_col="id", vector_col="v", k=3, min_similarity=-1.0, slice_rows=slice_rows)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "parquet" not in plan.lower()
        got = {}
        for r in hits.collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = r["id"]
        assert len(got) == 20_000
        assert all([got[f"q{i}"][rank] for rank in (1, 2, 3)] == row.tolist() for i, row in enumerate(want))


@pytest.mark.parametrize("tile_rows", [16_384, 100])
def test_grid_sends_the_corpus_to_a_few_cells_and_keeps_long_ids(spark, monkeypatch, tile_rows):
    """What meets in the grid is a corpus row per part and a query per tile, however few queries are scored at once."""
    monkeypatch.setattr(rt, "TILE_ROWS", tile_rows)
    rng = np.random.default_rng(9)
    base = (1 << 62) + 1  # beyond what a double can tell apart
    corpus = [(base + i, v) for i, v in enumerate(np.round(rng.normal(size=(600, 6)), 2))]
    asked = [(base + i, corpus[3 * i][1]) for i in range(200)]
    c = spark.createDataFrame([(i, v.tolist()) for i, v in corpus], "id bigint, v array<double>").repartition(3)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in asked], "query_id bigint, query_vector array<double>")
    hits = rt.cosine_top_k(c, q, id_col="id", vector_col="v", k=3, min_similarity=-1.0, slice_rows=2)
    assert ids(hits) == brute(corpus, asked, 3)
    # no hit is listed more than once per tile, whatever the number of blocks of two queries
    grid = rt._grid_top_k(c, q, "id", "v", "query_id", "query_vector", 3, 2, "query_id bigint, id bigint, similarity double")
    assert grid.count() <= 200 * 3 * -(-600 // tile_rows)
    cells = grid._jdf.queryExecution().executedPlan().toString()
    assert cells.count("Generate explode") == 2 and cells.count("Exchange hashpartitioning") == 1


def test_a_small_corpus_travels_and_many_questions_stream(spark, vectors):
    """Many questions of a small collection are not shuffled: one exchange, of results, is in the plan."""
    corpus, _, c, _ = vectors
    rng = np.random.default_rng(10)
    asked = [(i, v) for i, v in enumerate(rng.normal(size=(600, 8)))]
    q = spark.createDataFrame([(i, v.tolist()) for i, v in asked], "query_id int, query_vector array<double>")
    hits = rt.cosine_top_k(c, q, id_col="id", vector_col="v", k=4, min_similarity=-1.0, slice_rows=500)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "MapInPandas" in plan
    assert ids(hits) == brute(corpus, asked, 4)
    assert rt.cosine_top_k(c.limit(0), q, id_col="id", vector_col="v", slice_rows=500).count() == 0
