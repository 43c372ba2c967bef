"""Operator 5, quality: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.llm.common import hashed_sample, ship, staged
from peoplelake.llm.textfeatures import ngrams, points

BITS = 12
LONGEST = 3
#: Most rows of each grade that the regression is fitted on.
SAMPLE = 2000
PENALTY = 1e-4
ROUNDS = 300


def features(text: str | None) -> np.ndarray:
    """Unit vector of the damped counts of hashed character n-grams, case and signs kept; zero for an empty text."""
    found = np.bincount(ngrams(points(text or ""), 1, LONGEST, BITS), minlength=1 << BITS)
    found = np.sqrt(found)
    return (found / (np.linalg.norm(found) or 1.0)).astype(np.float32)


@dataclass
class QualityModel:
    """``grades`` in order; one weight vector for all of them; P(grade > grades[k]) = sigmoid(weights x - thresholds[k])."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: str | None) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1, 2, ..., falling."""
        margin = float(self.weights @ features(text)) - self.thresholds
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, levels: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds that maximise the weighted likelihood of grades 0 .. levels-1.

    The first threshold is free and each next adds the exponential of a free step, so the order always holds.
    """
    n, k = x.shape[1], levels - 1
    share = np.array([(weight * (grade > i)).sum() for i in range(k)]).clip(1e-6, 1 - 1e-6)
    start = -np.log(share / (1 - share))
    free = np.append(start[:1], np.log(np.maximum(np.diff(start), 1e-3)))
    w = np.zeros(n)
    mean, square = np.zeros(n + k), np.zeros(n + k)
    rows = np.arange(len(grade))
    for step in range(1, ROUNDS + 1):
        cuts = np.cumsum(np.append(free[:1], np.exp(free[1:])))
        margin = (x @ w.astype(np.float32)).astype(np.float64)
        # P(grade > i) at the cuts around each row's grade, with 1 below the first and 0 above the last
        tail = np.ones((len(grade), k + 2))
        tail[:, 1:-1] = 1 / (1 + np.exp(-np.clip(margin[:, None] - cuts, -500, 500)))
        tail[:, -1] = 0
        slope = tail * (1 - tail)
        chance = np.maximum(tail[rows, grade] - tail[rows, grade + 1], 1e-12)
        to_margin = -weight * (slope[rows, grade] - slope[rows, grade + 1]) / chance
        to_cuts = np.zeros(k + 2)
        np.add.at(to_cuts, grade, weight * slope[rows, grade] / chance)
        np.add.at(to_cuts, grade + 1, -weight * slope[rows, grade + 1] / chance)
        after = np.cumsum(to_cuts[1:-1][::-1])[::-1]
        to_free = after * np.append(1.0, np.exp(free[1:]))
        found = np.append((to_margin.astype(np.float32) @ x).astype(np.float64) + PENALTY * w, to_free)
        mean = 0.9 * mean + 0.1 * found
        square = 0.999 * square + 0.001 * found**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, free = w - move[:n], free - move[n:]
    return w, np.cumsum(np.append(free[:1], np.exp(free[1:])))


def train(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade"
) -> QualityModel:
    """Fit on the texts of ``docs`` whose id ``ratings`` gives an integer grade; of repeated ratings the highest holds.

    At most SAMPLE ids of each grade are used, those with the smallest hashes, each weighing as many as it stands for. They
    are drawn from the ratings, so texts of others stay where they are. Null ids, texts and grades are left out. With one
    grade only, or none, there are no thresholds and every text is expected to have that grade (0 if none).
    """
    ship(docs.sparkSession)
    known = ratings.filter(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(grade_col).cast("int")).alias("grade"))
    total = {r["grade"]: r["count"] for r in known.groupBy("grade").count().collect()}
    grades = sorted(total)
    if len(grades) < 2:
        return QualityModel(grades or [0], np.zeros(1 << BITS), np.zeros(0))
    few = staged(hashed_sample(known, "grade", "id", SAMPLE, total), "quality-sample")
    # at most SAMPLE rows per grade are broadcast
    few = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(few), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("grade").alias("grade"))
    rows = sum(total.values())

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.array(frame["x"].tolist(), dtype=np.float32)
        grade = frame["grade"].to_numpy()
        held = {g: int((grade == g).sum()) for g in grades}
        weight = np.array([total[g] / rows / held[g] for g in grade])
        w, cuts = fit_ordinal(x, np.searchsorted(grades, grade), len(grades), weight)
        return pd.DataFrame({"weights": [w], "thresholds": [cuts]})

    sample = few.select("grade", vectors("text").alias("x"))
    fitted = sample.groupBy().applyInPandas(fit, "weights array<double>, thresholds array<double>").first()
    return QualityModel(grades, np.array(fitted["weights"]), np.array(fitted["thresholds"]))


def rate(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tails`` (P(grade >= second grade), >= third, ...) in place of the text.

    Columns of these names are replaced. The whole text is read and nothing else; null counts as empty.
    """
    own = ["expected_grade", "tails"]
    kept = [c for c in docs.columns if c != text_col and c.lower() not in own]
    schema = T.StructType([
        *(docs.schema[c] for c in kept), T.StructField("expected_grade", T.DoubleType()),
        T.StructField("tails", T.ArrayType(T.DoubleType()))])
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        steps = np.diff(shipped.value.grades)
        for batch in batches:
            tails = [shipped.value.tails(t.as_py()) for t in batch.column(len(kept))]
            expected = [shipped.value.grades[0] + float(steps @ t) for t in tails]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:len(kept)], pa.array(expected, pa.float64()), pa.array(tails, pa.list_(pa.float64()))],
                names=[f.name for f in schema])

    return docs.select(*kept, text_col).mapInArrow(run, schema)
