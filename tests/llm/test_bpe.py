"""Byte-level BPE against the public library, and an exact round trip."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from peoplelake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD = [
    None, "", " ", "   x", "a" * 3000, "ab" * 2000, "abcabd" * 900, "=-" * 700, "\n" * 300, "it's we'll I'VE", "\x1c\x1f\x85\xa0 \t x",
    "漢字 é😀 ñ²½Ⅷ", "<|endoftext|>", "the " * 40_000, "x" * 65 + " y", " a　b", "12 345,678", "á ﻿b",
]


@pytest.fixture(scope="module")
def public():
    with open(PATH, "rb") as file:
        ranks = bpe.read_ranks(file.read())
    return ranks, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_matches_the_library(public):
    ranks, library = public
    encoder = bpe.Encoder(ranks, PATTERN)
    rng = random.Random(5)
    letters = list("ab cd'stre\n\t 12 é漢字😀\x1c\x1f\x85!?.-  ñ²½Ⅷ​")
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for text in [t or "" for t in ODD] + made:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text), repr(text[:50])


def test_long_pieces_merge_in_rank_order(public):
    ranks, library = public
    rng = random.Random(6)
    for size in (2, 17, 400, 20_000):
        piece = "".join(rng.choice("abcdetnro") for _ in range(size))
        assert bpe.merge(piece.encode(), ranks) == library.encode_ordinary(piece)


def test_ties_go_left_and_lower_ranks_come_back():
    ranks = {bytes([c]): c for c in range(256)}
    assert bpe.merge(b"aaa", {**ranks, b"aa": 300}) == [300, 97]
    # joining a and b makes a pair whose rank is below what is still waiting
    made = {**ranks, b"ab": 300, b"abc": 256, b"cd": 400}
    assert bpe.merge(b"abcd", made) == [256, 100]
    assert bpe.merge(b"", ranks) == []


def test_a_full_cache_changes_nothing(public, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 2)
    encoder = bpe.Encoder(public[0], PATTERN)
    text = "one two three four one two three four"
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == public[1].encode_ordinary(text)
    assert len(encoder.chunks) <= 2


def test_a_batch_is_encoded_in_parts(public, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 2000, raising=False)
    monkeypatch.setitem(bpe._ENCODERS, ("parts", PATTERN), bpe.Encoder(public[0], PATTERN))
    texts = ODD + ["é" * 700, None, "", "one two " * 100]
    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, kind)], names=["doc_id", "text"])
        parts = list(bpe._encoded([batch.slice(0, 0), batch, batch.slice(3, 2)], "parts", PATTERN, "ids"))
        sizes = [sum(len((texts[i] or "").encode()) for i in p.column(0).to_pylist()) for p in parts]
        assert len(parts) > 3 and all(size <= 2000 or p.num_rows == 1 for size, p in zip(sizes, parts))
        assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(len(texts)), 3, 4]
        assert [x for p in parts for x in p.column(1).to_pylist()] == [
            public[1].encode_ordinary(t or "") for t in [*texts, *texts[3:5]]]


def test_frames_round_trip(spark, public):
    rows = [(i, t, "n", "kept") for i, t in enumerate(ODD)] + [(1, "", "n", "kept")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, ids string")
    encoded = bpe.encode(docs, PATH, PATTERN)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    got = encoded.collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["ids"] for r in got} == {i: public[1].encode_ordinary(t or "") for i, t in enumerate(ODD)}
    texts = {r["doc_id"]: bytes(r["text"]) for r in bpe.decode(encoded, PATH).collect()}
    assert texts == {i: (t or "").encode() for i, t in enumerate(ODD)}
    digests = bpe.digests(encoded, PATH)
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in digests.collect():
        ids = public[1].encode_ordinary(ODD[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((ODD[r["doc_id"]] or "").encode()).hexdigest()
    assert sorted(bpe.encode_digests(docs.drop("ids"), PATH, PATTERN).collect()) == sorted(digests.collect())
    assert bpe.digests(bpe.encode(docs.limit(0), PATH, PATTERN), PATH).count() == 0


def test_pipeline_writes_the_ids(spark, public):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id bigint, text string, IDS string")
    out = corpus_pipeline.encoding_stage(spark, docs, "")
    assert out.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in out.collect():
        assert r["ids"] == public[1].encode_ordinary(ODD[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    assert "ids" not in bpe.encode_digests(docs.drop("IDS"), PATH, PATTERN).columns
