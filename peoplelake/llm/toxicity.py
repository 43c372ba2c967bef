"""Operator 2, toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

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

BITS = 20
#: Hashes whose counts travel in one row.
BLOCK = 1 << 12
SHORTEST, LONGEST = 3, 6
#: N-grams that the classifier weighs, those whose ratio is best supported.
FEATURES = 1 << 12
#: Most rows of either label that the weights are fitted on; all labelled rows are counted for the ratios.
SAMPLE = 3000
#: Labelled rows that one counting task takes at least, as each sends counts for all hashes.
COUNT_ROWS = 1 << 13
SMOOTH = 1.0
PENALTY = 3.0
ROUNDS = 400
THRESHOLD = 0.7


def present(text: str) -> np.ndarray:
    """Hashes of the character n-grams that occur in a text, lower case, white space as one blank; each once."""
    return np.unique(ngrams(points(f" {' '.join(text.lower().split())} "), SHORTEST, LONGEST, BITS))


@dataclass
class ToxicityModel:
    """Weight per n-gram that counts (ratio times fitted weight) by hash, and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        found = ngrams(points(f" {' '.join((text or '').lower().split())} "), SHORTEST, LONGEST, BITS)
        found = np.unique(found[self.weights[found] != 0])
        margin = self.intercept + float(self.weights[found].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def fit_weights(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on ``ratio``-scaled presence of the features 0 .. len(ratio)-1 of each row.

    Rows of either label count half in total, so a score is for a text that may as well have either. Gradient steps with
    momentum scaled by running squares; the L2 penalty is on the weights of the scaled features.
    """
    size = np.array([len(r) for r in rows])
    at = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), size)
    value = ratio[at]
    each = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    w, b, n = np.zeros(len(ratio)), 0.0, len(ratio)
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, ROUNDS + 1):
        margin = np.bincount(row, value * w[at], minlength=len(rows)) + b
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label) * each
        slope = np.bincount(at, value * error[row], minlength=n) + PENALTY * w / max(1, len(rows))
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = 0.02 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> ToxicityModel:
    """Learn from rows with a text and a label 0 or 1; others are left out.

    Per n-gram, the rows of either label that hold it are counted over all rows. The ratio is the log of its smoothed share
    in label 1 over that in label 0. The FEATURES best supported (the ratio over its standard error) are
    weighed, on at most SAMPLE different texts of each label, those with the smallest text hashes. Without rows of both labels every
    score is that of the one label seen, 0 if there is none. The driver gets FEATURES rows.
    """
    ship(labelled.sparkSession)
    known = staged(labelled.filter(F.col(text_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")), "toxicity-labelled")
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    negatives, positives = total.get(0, 0), total.get(1, 0)
    if not negatives or not positives:
        return ToxicityModel(np.zeros(1 << BITS), 500.0 if positives else -500.0)

    def held(batches):
        seen = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[label, present(text.as_py())] += 1
        # a row per block of hashes rather than per hash: mostly small numbers, which pack well in the shuffle
        parts = seen.reshape(2, -1, BLOCK)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(np.arange(parts.shape[1]), pa.int32()), "without": pa.array(list(parts[0]), pa.list_(pa.int32())),
            "with": pa.array(list(parts[1]), pa.list_(pa.int32()))})

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sums = [np.sum(np.stack(frame[c].to_list()), axis=0, dtype=np.int64) for c in ("without", "with")]
        some = np.flatnonzero(sums[0] + sums[1])
        return pd.DataFrame({"feature": key[0] * BLOCK + some, "without": sums[0][some], "with": sums[1][some]})

    tasks = -(-(negatives + positives) // COUNT_ROWS)
    counted = known.select("text", "label").coalesce(tasks).mapInArrow(held, "block int, without array<int>, with array<int>")
    counted = counted.groupBy("block").applyInPandas(add, "feature bigint, without bigint, with bigint")
    share_1 = (F.col("with") + SMOOTH) / F.lit(positives + 2 * SMOOTH)
    share_0 = (F.col("without") + SMOOTH) / F.lit(negatives + 2 * SMOOTH)
    ratio = F.log(share_1 / share_0)
    support = F.abs(ratio) / F.sqrt(1 / (F.col("with") + SMOOTH) + 1 / (F.col("without") + SMOOTH))
    best = counted.withColumns({"ratio": ratio, "support": support}).orderBy(F.desc("support"), "feature").limit(FEATURES)
    chosen = best.select("feature", "ratio").toPandas().sort_values("feature")
    feature, of = chosen["feature"].to_numpy(), chosen["ratio"].to_numpy()

    few = hashed_sample(known, "label", "text", SAMPLE, total)

    @F.pandas_udf("array<int>")
    def places(texts: pd.Series) -> pd.Series:
        spot = np.full(1 << BITS, -1)
        spot[feature] = np.arange(len(feature))
        return pd.Series([(at := spot[present(t)])[at >= 0] for t in texts], dtype=object)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        w, b = fit_weights([np.asarray(x, np.int64) for x in frame["places"]], frame["label"].to_numpy(), of)
        return pd.DataFrame({"weights": [w], "intercept": [b]})

    sample = staged(few.select("label", places("text").alias("places")), "toxicity-sample")
    fitted = sample.groupBy().applyInPandas(fit, "weights array<double>, intercept double").first()
    weights = np.zeros(1 << BITS)
    weights[feature] = np.array(fitted["weights"]) * of
    return ToxicityModel(weights, fitted["intercept"])


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) in place of the text; a column ``score`` is replaced.

    The whole text is read and nothing else. Null and empty texts get the score of a text without n-grams that count.
    """
    kept = [c for c in docs.columns if c != text_col and c.lower() != "score"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType())])
    ship(docs.sparkSession)
    at = np.flatnonzero(model.weights)
    shipped = docs.sparkSession.sparkContext.broadcast((at, model.weights[at], model.intercept))

    def run(batches):
        where, weights, intercept = shipped.value
        own = ToxicityModel(np.zeros(1 << BITS), intercept)
        own.weights[where] = weights
        for batch in batches:
            found = pa.array([own.score(t.as_py()) for t in batch.column(len(kept))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], found], names=[*kept, "score"])

    return docs.select(*kept, text_col).mapInArrow(run, schema)
