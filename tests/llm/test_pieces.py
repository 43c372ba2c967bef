"""Piece encoding against the public library, and an exact round trip."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from peoplelake.llm import merging, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   x", "x   ", "a" * 3000, "ab" * 2000, "=-" * 700, "\n" * 300, "a\n b", "it's we'll I'VE", "\x00\x1c\x85\xa0 \t x",
    "漢字 é😀 ñ²½Ⅷ", "</s> <s> <0x0A> <unk>", "the " * 40_000, "x" * 65 + " y", "▁a ▁▁ b▁", "12 345,678", "\U0010ffff�",
]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return pieces.read_model(file.read())


@pytest.fixture(scope="module")
def codec(model):
    return pieces.Codec(model)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def made_texts(count: int) -> list[str]:
    rng, letters = random.Random(5), list("ab cd'stre\n\t 12 é漢字😀\x1c\x85!?.-▁ 　ñ²½\x00​")
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(count)]


def test_codec_matches_the_library(codec, library):
    texts = [t or "" for t in ODD] + made_texts(3000)
    for text, raw in zip(texts, codec.encode_all(texts)):
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == library.encode(text, add_eos=True), repr(text[:50])
        assert codec.decode(ids).decode() == library.decode(ids.tolist()), repr(text[:50])


def test_any_ids_decode_as_in_the_library(codec, library):
    rng = random.Random(6)
    kinds = [lambda: rng.choice([0, 1, 2, 259]), lambda: rng.randrange(3, 259), lambda: rng.randrange(259, 32_000)]
    for _ in range(3000):
        ids = [rng.choice(kinds)() for _ in range(rng.randint(0, 12))]
        assert codec.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_one_agenda_for_all_is_an_agenda_for_each(model, codec):
    rng = random.Random(7)
    chunks = ["".join(rng.choice("abcdetnro▁") for _ in range(rng.choice((1, 2, 9, 30, 4000)))) for _ in range(300)]
    for chunk, raw in zip(chunks, codec._merged(chunks)):
        assert np.frombuffer(raw, "<u4").tolist() == [model.ids[p] for p in pieces.merge(chunk, model.rank)]


@pytest.mark.parametrize("queue", [merging.HeapOfRanks, merging.BitmapOfRanks])
def test_ties_go_left_and_sequences_that_turn_back_are_named(queue):
    ids = {"a": 0, "b": 1, "c": 2, "aa": 3, "ab": 4, "abc": 5, "cc": 6}
    table = merging.pair_table(ids, ids.get)
    rank = np.array([9, 9, 9, 3, 4, 2, 5], np.int32)  # abc is better than ab, which it needs first

    def run(*texts):
        sizes = np.array([len(t) for t in texts])
        symbols, starts, doubtful = merging.merge_all(
            np.array([ids[c] for t in texts for c in t], np.int32), np.cumsum(sizes) - sizes, table, rank, queue)
        return [list(struct.unpack(f"<{len(p) // 4}I", p)) for p in merging.packed(symbols, starts)], doubtful.tolist()

    assert run("aaa", "", "aaaaa", "b") == ([[3, 0], [], [3, 3, 0], [1]], [])
    found, doubtful = run("cc", "abcabc", "ab")
    assert (found[0], found[2], doubtful) == ([6], [4], [1])


def test_a_full_cache_changes_nothing(model, codec):
    small = pieces.Codec(model)
    small._chunks = merging.Remembered(small._merged, 2)
    texts = made_texts(200)
    assert [list(small.encode_all([t])) for t in texts] == [[x] for x in codec.encode_all(texts)]
    assert len(small._chunks) < 2


def test_the_library_is_asked_about_every_chunk(model, library):
    codec = pieces.Codec(model, library)
    texts = [t or "" for t in ODD] + made_texts(300)
    for text, (ids, decoded, agrees) in zip(texts, codec.encode_checked(texts)):
        assert agrees and ids.tolist() == library.encode(text, add_eos=True) and decoded.decode() == library.decode(ids.tolist())
    assert len(codec._chunks.young) > 300 and not codec.doubted

    class Other:
        def encode(self, texts, num_threads):
            return [[0] if t == "such" else ids for t, ids in zip(texts, library.encode(texts, num_threads=num_threads))]

        def decode(self, lists, num_threads):
            return ["?" if t == "word" else t for t in library.decode(lists, num_threads=num_threads)]

    wrong = pieces.Codec(model, Other())
    for _ in range(2):
        assert [a for _, _, a in wrong.encode_checked(["no such thing", "nothing", "a word", ""])] == [False, True, False, True]


def field(number: int, value) -> bytes:
    if isinstance(value, int):
        return bytes([number << 3, value])
    return bytes([number << 3 | 2, len(value)]) + value


def test_other_models_are_refused():
    with open(PATH, "rb") as file:
        raw = file.read()
    for changed in (
        field(2, field(3, 1)),  # not of the merge type
        field(1, field(1, b"xyz") + field(3, 4)),  # a user-defined piece
        field(3, field(4, 1)),  # blanks are folded
        field(1, field(1, "a▁b".encode())),
    ):
        with pytest.raises(ValueError):
            pieces.read_model(raw + changed)


def test_frames_round_trip(spark, library):
    rows = [(i, t, "n", "kept") for i, t in enumerate(ODD)] + [(1, "", "n", "kept")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, N_TOKENS string, ids string")
    encoded = pieces.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "N_TOKENS", "ids"]
    got = encoded.collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["ids"] for r in got} == {i: library.encode(t or "", add_eos=True) for i, t in enumerate(ODD)}
    texts = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, PATH).collect()}
    assert texts == {i: library.decode(library.encode(t or "")) for i, t in enumerate(ODD)}
    digests = pieces.encode_digests(docs, PATH, agrees_col="agrees")
    assert digests.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
    for r in digests.collect():
        ids = library.encode(ODD[r["doc_id"]] or "", add_eos=True)
        assert r["agrees"] and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.encode_digests(docs.limit(0), PATH).count() == 0
    empty = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["text"] for r in pieces.decode(empty, PATH).collect()] == ["", ""]
