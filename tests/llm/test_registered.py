"""The registered queries on the smallest driver tables: oracles, contracts in plain Python, plans; and the pipeline."""

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from peoplelake.llm import mixing, sharding
from peoplelake.llm.oracles import ORACLES
from peoplelake.llm.queries import REGISTRY
from tools.check_oracles import TABLES, rows_of, same

FOLDER = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_all_operators_and_the_pipeline_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY} == set(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} == set(entry.LLM_QUERIES) and set(ORACLES) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    df = REGISTRY[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    got, want = rows_of(df.columns, df.collect()), rows_of(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert [(g, w) for g, w in zip(got, want) if not all(same(a, b) for a, b in zip(g, w))] == []


@pytest.mark.parametrize(("name", "of", "is_held_out"), [("op2_toxicity", 3, 1), ("op9_language", 4, 2)])
def test_scores(spark, documents, name, of, is_held_out):
    got = REGISTRY[name](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % of == is_held_out) and 0 <= r["score"] <= 1 for r in got)
    if name == "op9_language":
        assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in got if r["held_out"]) >= 0.97 * sum(r["held_out"] for r in got)
    else:
        assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_quality_keeps_good_texts(spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = [r for r in REGISTRY["op5_quality"](spark, FOLDER).collect() if r["doc_id"] in labels]
    good = [r for r in got if labels[r["doc_id"]]["quality"] == 1 and not labels[r["doc_id"]]["toxic"]]
    assert sum(r["selected"] for r in good) >= 0.97 * len(good)
    assert all(r["p_fair"] >= r["p_good"] for r in got)


def test_shards(spark, documents):
    got = REGISTRY["op8_sharding"](spark, FOLDER).collect()
    assert {r["law"] for r in got} == {"rows"} and len(got) == len(documents)
    assert max(Counter(r["shard"] for r in got).values()) - min(Counter(r["shard"] for r in got).values()) <= 1
    assert all(sharding.row_at(r["shard"], r["slot"], len(got))[0] == r["row"] for r in got)


def test_mix_is_near_its_targets(spark, documents):
    got = REGISTRY["op10_mixing"](spark, FOLDER).collect()
    taken, target = Counter(), {}
    for r in got:
        doc = documents[r["doc_id"]]
        assert r["size"] == len(re.findall(mixing.WORD, doc["text"] or "")) and r["taken"] <= 2 * r["size"]
        taken[doc["source"]] += r["taken"]
        target[doc["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= mixing.BLOCK for s, t in target.items())


PLANNED = sorted({"op1_exact_dedup", "op4_byte_bpe", "op5_quality", "op8_sharding", "op9_language", "op10_mixing"})


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_cross_or_nested_loop_join(spark, name):
    plan = REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name == "op1_exact_dedup":
        assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_stage_by_stage(spark, documents):
    """Each stage against a plain version of its decisions on what the stage before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), stage(spark, docs, FOLDER).schema)
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert len(kept["language"]) >= 0.99 * len(documents)
    best = {}
    for r in kept["language"]:
        best[r["text"] or ""] = max(best.get(r["text"] or "", -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in kept["exact_dedup"]) == sorted(best.values())

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}

    before = {r["doc_id"]: shingles(r["text"]) for r in kept["exact_dedup"]}
    stay = {r["doc_id"] for r in kept["near_dedup"]}
    near = [(a, b) for a in before for b in before if a < b and len(before[a] & before[b]) >= 0.8 * len(before[a] | before[b])]
    linked = {x for pair in near for x in pair}
    assert set(before) - stay <= linked and len(set(before) - stay) >= 0.9 * len({b for _, b in near})
    for r in kept["mixing"]:
        whole = documents[r["doc_id"]]["text"]
        assert r["doc_id"] in stay and r["n_chars"] == len(r["text"])
        assert r["text"] == whole or all(part in whole for part in r["text"].split("\n"))
    assert len(kept["byte_bpe"]) == len(kept["mixing"]) and all(r["n_tokens"] > 0 for r in kept["byte_bpe"])


def test_pieces_agree_with_the_library_on_every_document(spark, documents):
    got = REGISTRY["op11_sentencepiece"](spark, FOLDER).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(r["doc_id"] for r in got) == sorted(documents) and all(r["library_agrees"] for r in got)
    for r in got:
        ids = library.encode(documents[r["doc_id"]]["text"] or "", add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_whitened_rows_of_the_table(spark):
    got = REGISTRY["op13_whitening"](spark, FOLDER).collect()
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    x = {i: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for i, v in vectors.items()}
    fitted = np.unique(np.array(list(x.values())), axis=0)
    values, axes = np.linalg.eigh(np.cov(fitted.T, bias=True))
    assert len(got) == 4 * len(x) and got[0]["identity_error"] <= 1e-4
    for k in range(1, 5):
        of_k = {r["vec_id"]: r for r in got if r["component"] == k}
        want = {i: (v - fitted.mean(axis=0)) @ axes[:, -k] / values[-k] ** 0.5 for i, v in x.items()}
        sign = np.sign(sum(want[i] * of_k[i]["whitened"] for i in x))
        assert all(abs(want[i] * sign - of_k[i]["whitened"]) < 1e-7 for i in x)
        assert all(abs(r["explained"] * values.sum() / values[-k] - 1) < 1e-9 for r in of_k.values())
        assert all(r["deviation"] == int(((len(fitted) * x[i] - fitted.sum(axis=0)) ** 2).sum()) for i, r in of_k.items())
