"""Operator 9, language identification: nearest of several clustered centroids per language, with rejection by distance."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.llm.common import fresh, hashed_sample, ship, staged
from peoplelake.llm.textfeatures import letters, ngrams

BITS = 12
LONGEST = 3
CENTROIDS = 4
#: Most texts of a language that its centroids are clustered from.
SAMPLE = 2000
#: Quantile of the similarities of a language's own texts, and of those of another language's texts, that a floor lies
#: midway between if it can.
OWN, OTHER = 0.005, 0.95
#: Different n-grams with which a text meets the whole floor; with fewer, a cosine is smaller as the root of their number.
RICH = 64
NONE = "und"


def counts(text: str) -> np.ndarray:
    """Hashed letter n-gram counts of a text, by code points in lower case."""
    return np.bincount(ngrams(letters(text), 1, LONGEST, BITS), minlength=1 << BITS).astype(np.float64)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vector; zero if the text has no letters. Term frequencies are damped by a square root."""
    found = np.sqrt(counts(text)) * idf
    return found / (np.linalg.norm(found) or 1.0)


def evidence(vectors: np.ndarray) -> np.ndarray:
    """Share of a floor that each text has to meet, 1 for texts of RICH different n-grams or more."""
    return np.sqrt(np.clip(np.count_nonzero(vectors, axis=-1), 1, RICH) / RICH)


@dataclass
class LanguageModel:
    """``centroids``: unit rows; ``names``: the language of each; ``floors``: the similarity under which it rejects a rich text."""

    idf: np.ndarray
    centroids: np.ndarray
    names: list[str]
    floors: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, similarity (0 to 1) and whether it is accepted. No letters or no model: ``und``, 0, rejected."""
        if not text or not self.names or not _has_letter(text):
            return NONE, 0.0, False
        found = vector(text, self.idf)
        near = self.centroids @ found
        best = int(np.argmax(near))
        return self.names[best], float(min(1.0, max(0.0, near[best]))), bool(near[best] >= self.floors[best] * evidence(found))


def _has_letter(text: str) -> bool:
    return len(letters(text)) > 1


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread starts: unit centroids, at most ``k``, fewer if there are fewer distinct vectors."""
    centers = [vectors[0]]
    for _ in range(k - 1):
        far = (vectors @ np.array(centers).T).max(axis=1)
        if far.min() > 1 - 1e-9:
            break
        centers.append(vectors[int(np.argmin(far))])
    found = np.array(centers)
    for _ in range(rounds):
        nearest = np.argmax(vectors @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), found)
    return found


def train(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", centroids: int = CENTROIDS, sample: int = SAMPLE
) -> LanguageModel:
    """Learn from the rows of ``docs`` with a language and a text.

    Document frequencies count all rows. Centroids are clustered from at most ``sample`` different texts of each
    language, those with the smallest hashes. The floor of a language lies midway between what nearly all of its own
    sampled texts reach, each on centroids of the other half of them, and what nearly all of the texts of the nearest other
    language reach on its centroids, both over :func:`evidence`; it is the former if that is lower or there is no other
    language. A language of one text has the latter. The model holds ``centroids`` vectors of 2**BITS numbers per language and comes to the driver;
    it grows with the languages only. No rows give a model that answers ``und``.
    """
    ship(docs.sparkSession)
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("name"), F.col(text_col).alias("text"))

    def frequencies(batches):
        held, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                held += counts(text.as_py()) > 0
                rows += 1
        yield pa.RecordBatch.from_pydict({
            "feature": np.arange(-1, 1 << BITS), "held": np.concatenate([[rows], held])})

    per_task = known.select("text").mapInArrow(frequencies, "feature bigint, held bigint")
    summed = {r["feature"]: r["held"] for r in per_task.groupBy("feature").agg(F.sum("held").alias("held")).collect()}
    rows = summed.get(-1, 0)
    idf = np.log((1 + rows) / (1 + np.array([summed.get(i, 0) for i in range(1 << BITS)]))) + 1

    held = {r["name"]: r["count"] for r in known.groupBy("name").count().collect()}
    few = staged(hashed_sample(known, "name", "text", sample, held), "language-sample")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array([vector(t, idf) for t in sorted(frame["text"]) if _has_letter(t)])
        if not len(vectors):
            return pd.DataFrame({"name": [], "centroid": [], "own": []})
        found = cluster(vectors, centroids)
        return pd.DataFrame({"name": frame["name"].iloc[0], "centroid": list(found), "own": _own(vectors, centroids)})

    model = few.groupBy("name").applyInPandas(fit, "name string, centroid array<double>, own double").collect()
    model.sort(key=lambda r: (r["name"], r["centroid"]))
    names, found = [r["name"] for r in model], np.array([r["centroid"] for r in model])
    starts = [i for i, name in enumerate(names) if not i or name != names[i - 1]]
    shipped = docs.sparkSession.sparkContext.broadcast((idf, found, starts))

    def reach(frame: pd.DataFrame) -> pd.DataFrame:
        idf, found, starts = shipped.value
        vectors = np.array([vector(t, idf) for t in frame["text"] if _has_letter(t)]).reshape(-1, 1 << BITS)
        near = np.maximum.reduceat(vectors @ found.T, starts, axis=1) / evidence(vectors)[:, None]
        reached = [np.quantile(near, OTHER, axis=0)] if len(near) else []
        return pd.DataFrame({"name": frame["name"].iloc[0], "reached": reached})

    floors = {names[i]: model[i]["own"] for i in starts}
    if len(starts) > 1:
        per_name = few.groupBy("name").applyInPandas(reach, "name string, reached array<double>").collect()
        for at, i in enumerate(starts):
            other = max(r["reached"][at] for r in per_name if r["name"] != names[i])
            own = floors[names[i]]
            floors[names[i]] = other if own is None else min(own, (own + other) / 2)
    return LanguageModel(idf, found, names, np.array([floors[name] or 0.0 for name in names]))


def _own(vectors: np.ndarray, centroids: int) -> float | None:
    """What nearly all texts reach on centroids of the other half of them; None for one text."""
    if len(vectors) < 2:
        return None
    order = np.random.default_rng(0).permutation(len(vectors))
    halves = vectors[order[::2]], vectors[order[1::2]]
    near = [(a @ cluster(b, centroids).T).max(axis=1) / evidence(a) for a, b in (halves, halves[::-1])]
    return float(np.quantile(np.concatenate(near), OWN, method="lower"))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``; columns of these names are replaced, the text is dropped.

    The language is that of the centroid with the largest cosine (the first in order of name on a tie), and the score that
    cosine. A text is rejected if it is under the centroid's floor times its :func:`evidence`. Null texts and texts without a letter are ``und`` with
    score 0 and rejected. Only the text is looked at.
    """
    own = ["lang_pred", "score", "accepted"]
    kept = [c for c in docs.columns if c != text_col and c.lower() not in own]
    schema = T.StructType([
        *(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [shipped.value.predict(t.as_py()) for t in batch.column(len(kept))]
            names, scores, taken = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:len(kept)], pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                pa.array(taken, pa.bool_())], names=[f.name for f in schema])

    return docs.select(*kept, text_col).mapInArrow(run, schema)


def drop_rejected(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model accepts, with all their columns."""
    taken = fresh("accepted", docs.columns)
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        return pd.Series([shipped.value.predict(t)[2] for t in texts], dtype=bool)

    return docs.withColumn(taken, accepted(text_col)).filter(taken).drop(taken)
