"""Operator 12, hard-negative mining: integer scores by Strassen multiplication of anchor and candidate tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import positions, ship, staged

POSITIVES = 5
NEGATIVES = 3
#: A negative's score times WINDOW[2] lies between the positive's times WINDOW[0] and times WINDOW[1].
WINDOW = (50, 95, 100)
SCALE = 256
#: Rows of a tile; tiles that a block holds at most, so at most this many by this many tiles are multiplied in one task.
TILE = 256
BLOCK_TILES = 16
#: Bytes of a block at most, whatever the number of components; a block has one tile at least.
BLOCK_BYTES = 32 << 20
#: Below this many rows, columns or components a product is taken directly.
LEAF = 32


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices by seven products of halves, odd sides padded with zeros; exact while entries fit."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= LEAF:
        return a @ b
    a, b = (np.pad(m, ((0, m.shape[0] % 2), (0, m.shape[1] % 2))) if m.shape[0] % 2 or m.shape[1] % 2 else m for m in (a, b))
    r, i, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    nw, ne, sw, se = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b_nw, b_ne, b_sw, b_se = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    both = strassen(nw + se, b_nw + b_se)
    low = strassen(sw + se, b_nw)
    right = strassen(nw, b_ne - b_se)
    under = strassen(se, b_sw - b_nw)
    top = strassen(nw + ne, b_se)
    out = np.empty((2 * r, 2 * c), np.int64)
    out[:r, :c] = both + under - top + strassen(ne - se, b_sw + b_se)
    out[:r, c:] = right + top
    out[r:, :c] = low + under
    out[r:, c:] = both - low + right + strassen(sw - nw, b_nw + b_ne)
    return out[:rows, :columns]


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of two lists of integer vectors; the shorter vectors are padded with zeros. What could leave 64 bits,
    also when compared with the window, is refused."""
    width = max(anchors.shape[1], candidates.shape[1])
    a, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, candidates))
    largest = [int(np.abs(m).max(initial=0)) for m in (a, c)]
    if largest[0] * largest[1] * max(1, width) * max(WINDOW) >= 1 << 62:
        raise OverflowError("components are too large for exact 64-bit scores")
    return strassen(a, c.T)


class Best:
    """The ``k`` best (score, id) of each row, high scores first and small ids on a tie: heaps of fixed size that merge."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.score = np.zeros((rows, 0), np.int64)
        self.id = np.zeros((rows, 0), np.int64)
        self.held = np.zeros((rows, 0), bool)

    def add(self, score: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        """Offer each row the candidates ``ids`` for which it has ``wanted``."""
        k = min(self.k, score.shape[1])
        if k and k < score.shape[1]:  # those not below the k-th score; of the ties the order below decides
            level = np.partition(np.where(wanted, score, np.iinfo(np.int64).min), -k, axis=1)[:, -k]
            near = wanted & (score >= level[:, None])
            columns = np.flatnonzero(near.any(axis=0))
            score, ids, wanted = score[:, columns], ids[columns], near[:, columns]
        both_score = np.concatenate([self.score, score], axis=1)
        both_id = np.concatenate([self.id, np.broadcast_to(ids, score.shape)], axis=1)
        both_held = np.concatenate([self.held, wanted], axis=1)
        order = np.lexsort((both_id, -both_score, ~both_held), axis=1)[:, :self.k]
        self.score, self.id, self.held = (np.take_along_axis(m, order, axis=1) for m in (both_score, both_id, both_held))

    def rows(self):
        """(row, score, id) of all that is held."""
        row, place = np.nonzero(self.held)
        return row, self.score[row, place], self.id[row, place]


def _unpacked(tiles: pd.DataFrame):
    """(tile, ids, vectors) of each tile."""
    for tile in tiles.itertuples(index=False):
        ids = np.frombuffer(tile.ids, np.int64)
        yield tile, ids, np.frombuffer(tile.vectors, np.int64).reshape(len(ids), -1)


def _packed(label: object, ids: list, vectors: list, first: int) -> dict:
    width = max((len(v) for v in vectors), default=0)
    matrix = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        matrix[i, :len(v)] = v
    return {"label": label, "first": first, "ids": np.array(ids, np.int64).tobytes(), "vectors": matrix.tobytes(), "size": matrix.nbytes}


def tiles_of(rows: DataFrame, name: str) -> DataFrame:
    """(label, first, ids, vectors, size) from (id, label, x): up to TILE rows of one label. ``first`` numbers the first
    of its rows; all rows have numbers of their own.

    Rows are sorted by label and id over range partitions and packed where they lie, so a label of any size is cut.
    """
    kind = rows.schema["label"].dataType.simpleString()

    def pack(ranged: DataFrame) -> DataFrame:
        def run(frames):
            held_label, ids, vectors, first = None, [], [], 0
            for frame in frames:
                for row_id, label, x, part, nth in zip(frame["id"], frame["label"], frame["x"], frame["part"], frame["nth"]):
                    if ids and (label != held_label or len(ids) == TILE):
                        yield pd.DataFrame([_packed(held_label, ids, vectors, first)])
                        ids, vectors = [], []
                    if not ids:
                        held_label, first = label, (int(part) << 33) + int(nth)
                    ids.append(row_id)
                    vectors.append(x)
            if ids:
                yield pd.DataFrame([_packed(held_label, ids, vectors, first)])

        return ranged.mapInPandas(run, f"label {kind}, first bigint, ids binary, vectors binary, size bigint")

    return positions(rows, ["label", "id"], name, pack)


def _blocked(tiles: DataFrame, by: list[str], name: str) -> DataFrame:
    """Tiles with their ``block``, dense numbers from 0 (per value of ``by``), and ``blocks``, how many there are.

    Tiles are counted and numbered without their contents: windows see one small row per TILE rows of the table, those of
    a label or of all. A hash would do without, but fills blocks unevenly.
    """
    largest = tiles.agg(F.max("size").alias("size")).first()["size"] or 1
    held = max(1, min(BLOCK_TILES, BLOCK_BYTES // largest))
    part = F.shiftright("first", 33)
    counted = tiles.groupBy(*by, part.alias("part")).agg(F.count(F.lit(1)).alias("tiles"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumns({
        "before": F.coalesce(F.sum("tiles").over(before), F.lit(0)), "all": F.sum("tiles").over(Window.partitionBy(*by))})
    within = Window.partitionBy(*by, "part").orderBy("first")
    numbered = tiles.withColumn("part", part).select(*by, "part", "first").withColumn("nth", F.row_number().over(within) - 1)
    placed = numbered.join(offsets, [*by, "part"]).select(
        "first", F.floor((F.col("before") + F.col("nth")) / held).cast("int").alias("block"),
        F.ceil(F.col("all") / held).cast("int").alias("blocks"))
    return staged(tiles.join(placed, "first"), name)


def _grid(anchors: DataFrame, candidates: DataFrame, by: list[str], work, schema: str) -> DataFrame:
    """``work`` on every pair of a block of anchor tiles and a block of candidate tiles (of equal ``by``): each side is sent
    once to every block of the other, and a pair of blocks is a group of bounded size."""
    def sent(tiles: DataFrame, other: DataFrame, own: str, its: str) -> DataFrame:
        across = other.groupBy(*by).agg(F.max("blocks").alias("others"))
        if by:
            met = tiles.join(across, by)
        else:
            met = tiles.withColumn("others", F.lit(across.first()["others"] or 0))
        met = met.filter("others > 0").withColumn(its, F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
        return met.withColumnRenamed("block", own).drop("blocks", "others", "size")

    keys = [*by, "a_block", "c_block"]
    left = sent(anchors, candidates, "a_block", "c_block").groupBy(*keys)
    right = sent(candidates, anchors, "c_block", "a_block").groupBy(*keys)
    return left.cogroup(right).applyInPandas(work, schema)


def mine(
    vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Hard negatives: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(256 * x) and a score is the integer inner product with the anchor; the best come first, ties
    by smaller id. The positives of an anchor, a row where the predicate ``anchor`` holds, are its first ``positives`` other
    rows of the same label; of each, the first ``negatives`` rows of other labels are returned whose score lies between
    50 % and 95 % of the positive's. An anchor without positives and a positive without such rows give nothing.

    Rows with a null id, label or vector or with a null or non-finite component take no part; nor is a row a candidate for
    an anchor of the same id, so of rows that repeat an id each counts, but not for the others. Vectors of different
    lengths are padded with zeros, so an empty one scores 0. Other columns are not looked at; no rows give no rows.
    Components so large that a score could leave 64 bits fail the job instead of giving a wrong score.

    Tiles of anchors and candidates of one label are multiplied for the positives, then all tiles for the negatives; each
    task keeps bounded heaps per anchor, which Spark merges with a row limit before the shuffle.
    """
    ship(vectors.sparkSession)
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(finite, F.lit(False))
    rows = vectors.filter(usable).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"),
        F.transform(x, lambda v: F.floor(v * SCALE)).alias("x"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = staged(rows, "negatives-rows")
    candidates = tiles_of(rows.drop("anchor"), "negatives-candidates")
    anchors = tiles_of(rows.filter("anchor").drop("anchor"), "negatives-anchors")

    def positive(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        found = []
        for tile, ids, matrix in _unpacked(one):
            best = Best(len(ids), positives)
            for _, their, vectors in _unpacked(other):
                best.add(scores(matrix, vectors), their, ids[:, None] != their[None, :])
            row, score, their = best.rows()
            found.append(pd.DataFrame({
                "first": tile.first, "row": row, "anchor_id": ids[row], "positive_id": their, "positive_score": score}))
        return pd.concat(found)

    per_label = _grid(
        _blocked(anchors, ["label"], "negatives-by-label"), _blocked(candidates, ["label"], "negatives-by-label"), ["label"],
        positive, "first bigint, row int, anchor_id bigint, positive_id bigint, positive_score bigint")
    best_first = Window.partitionBy("first", "row").orderBy(F.desc("positive_score"), "positive_id")
    chosen = per_label.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= positives)
    chosen = staged(chosen, "negatives-positives")
    asked = chosen.groupBy("first").agg(F.collect_list(F.struct("row", "place", "positive_score")).alias("asked"))
    low, high, whole = WINDOW

    def negative(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        found = []
        for tile, ids, matrix in _unpacked(one):
            level = np.zeros((positives, len(ids), 1), np.int64)
            wanted = np.zeros((positives, len(ids), 1), bool)
            for ask in tile.asked:
                level[ask["place"] - 1, ask["row"]], wanted[ask["place"] - 1, ask["row"]] = ask["positive_score"], True
            best = [Best(len(ids), negatives) for _ in range(positives)]
            for their_tile, their, vectors in _unpacked(other):
                if their_tile.label == tile.label:
                    continue
                score, others = scores(matrix, vectors), ids[:, None] != their[None, :]
                for heap, own, asks in zip(best, level, wanted):
                    fits = (low * own <= whole * score) & (whole * score <= high * own)
                    heap.add(score, their, fits & others & asks)
            for place, heap in enumerate(best, 1):
                row, score, their = heap.rows()
                found.append(pd.DataFrame({
                    "first": tile.first, "row": row, "place": place, "negative_id": their, "negative_score": score}))
        return pd.concat(found)

    found = _grid(
        _blocked(anchors.join(asked, "first"), [], "negatives-grid"), _blocked(candidates, [], "negatives-grid"), [],
        negative, "first bigint, row int, place int, negative_id bigint, negative_score bigint")
    best_first = Window.partitionBy("first", "row", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= negatives)
    return ranked.join(chosen, ["first", "row", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
