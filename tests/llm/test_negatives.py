"""Hard negatives against a plain version, and the multiplication and the heaps they come from."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peoplelake.llm import negatives

DDL = "vec_id bigint, embedding array<float>, label int, anchor_id string, first string, row string"


def plain(rows, is_anchor):
    usable = [
        (i, [math.floor(256 * float(np.float32(v))) for v in x], label) for i, x, label in rows
        if i is not None and x is not None and label is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for a, x, label in usable:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, own == label) for i, y, own in usable if i != a)
        for minus, positive, _ in [s for s in scored if s[2]][:5]:
            near = [(i, -s) for s, i, alike in scored if not alike and -50 * minus <= -100 * s <= -95 * minus]
            out += [(a, positive, r, i, -minus, s) for r, (i, s) in enumerate(near[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 65, 9), (70, 33, 131), (0, 4, 3), (3, 0, 5)])
def test_strassen_is_the_product(shape, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 3)
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-2**24, 2**24, shape[:2]), rng.integers(-2**24, 2**24, shape[1:])
    assert (negatives.strassen(a, b) == a @ b).all()


def test_scores_pad_and_refuse_what_leaves_64_bits():
    assert negatives.scores(np.array([[2, 3]]), np.array([[5], [7]])).tolist() == [[10, 14]]
    with pytest.raises(OverflowError):
        negatives.scores(np.array([[2**31]]), np.array([[2**31]]))


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(3)
    score, ids = rng.integers(0, 6, (4, 60)), rng.permutation(60)
    wanted = rng.random((4, 60)) < 0.5
    wanted[2] = False
    for parts in ([60], [1, 7, 30, 22], [59, 1]):
        heap, at = negatives.Best(4, 5), 0
        for size in parts:
            heap.add(score[:, at:at + size], ids[at:at + size], wanted[:, at:at + size])
            at += size
        got = [[] for _ in range(4)]
        for row, s, i in zip(*heap.rows()):
            got[row].append((int(-s), int(i)))
        assert got == [sorted((int(-s), int(i)) for s, i, w in zip(score[r], ids, wanted[r]) if w)[:5] for r in range(4)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DDL).repartition(3)


def mined(spark, rows, is_anchor="vec_id % 10 = 0"):
    got = negatives.mine(frame(spark, rows), F.expr(is_anchor))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_against_the_plain_version(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 8)
    monkeypatch.setattr(negatives, "BLOCK_TILES", 2)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0.1, 0.3) for _ in range(5)], 1 if rng.random() < 0.4 else rng.randrange(4)) for i in range(150)]
    rows += [(i + 200, rows[i][1], rows[i][2]) for i in range(0, 60)]  # ties, some of them of anchors
    rows += [(20, rows[3][1], 2), (20, rows[3][1], 2), (33, rows[5][1], 0)]  # repeated ids and rows
    rows += [(400, None, 1), (410, [1.0, None], 1), (420, [float("nan"), 1.0], 1), (430, [float("inf")], 2), (440, [0.1], None),
             (None, [0.5] * 5, 1), (450, [], 1), (460, [0.4, 0.4], 1), (470, [0.0] * 5, 2), (480, [0.3] * 5, 77)]
    got = mined(spark, rows)
    assert got == plain(rows, lambda i: i % 10 == 0) and len(got) > 100


def test_no_rows_no_anchors_and_no_partners(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [0.9], 1), (3, [0.7], 2)]) == []
    assert mined(spark, [(10, [1.0], 1), (3, [0.7], 2)]) == []
    assert mined(spark, [(10, [1.0], 1), (2, [1.0], 1), (3, [0.7], 2)]) == [(10, 2, 1, 3, 65536, 256 * 179)]
