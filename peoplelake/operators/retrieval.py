"""Vector retrieval: exact cosine top-k, context packing, embedding, and collection maintenance."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.functions.text import fixed_point

# Default result size, similarity floor, prompt budget, encoder batch size and vector width.
TOP_K = 5
MIN_SIMILARITY = 0.0
CONTEXT_CHARS = 2500
BATCH_SIZE = 32
DIMENSIONS = 384
# Similarities are compared at nine decimals so that equal vectors tie exactly, whatever order a BLAS kernel used.
SIMILARITY_DIGITS = 9
# Queries scored at once, or rows of a side that travels with the tasks: 4096 vectors of 384 doubles are 12 MB.
MAX_QUERY_SLICE = 4096
# Corpus rows that a task holds where both sides are large: 16384 vectors of 384 doubles are 50 MB.
TILE_ROWS = 16_384
# Scores held at once by a task: 4M doubles are 32 MB.
SCORE_CELLS = 4_000_000

Encoder = Callable[[Sequence[str]], np.ndarray]

# The scoring helpers travel inside the task, so executors need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def where_equal(df: DataFrame, where: Mapping[str, object] | None) -> DataFrame:
    """Metadata equality filter on promoted columns; a plain predicate, so it reaches the Parquet scan."""
    for column, value in (where or {}).items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def _unit_rows(rows: Sequence[Sequence[float]]) -> np.ndarray:
    matrix = np.asarray([np.asarray(r, dtype=np.float64) for r in rows], dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def cosine_top_k(
    corpus: DataFrame,
    queries: DataFrame,
    *,
    id_col: str,
    vector_col: str,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    k: int = TOP_K,
    where: Mapping[str, object] | None = None,
    min_similarity: float = MIN_SIMILARITY,
    slice_rows: int = MAX_QUERY_SLICE,
) -> DataFrame:
    """Exact ``k`` nearest corpus rows per query: ``query_id, id, similarity, rank``.

    The metadata filter runs first. Of a batch of rows scored together only the best ``k`` per query leave the task, so pairs
    are never materialised. Ties go to the smaller id. A query set of at most ``slice_rows`` travels with the tasks and the
    corpus streams past it. Of a larger one, a corpus of at most ``slice_rows`` travels and the queries stream past that, and
    nothing but results is shuffled. Two large sides meet in a shuffle, see :func:`_grid_top_k`. Either way it is one lazy plan
    with one scan of what streams, and no query and no corpus row is left out. Query ids are taken to be unique.
    Similarity is ``max(0, cosine)``; rows under ``min_similarity`` are dropped after the top-k, as in the filter order
    of a vector store.
    """
    rows = where_equal(corpus, where).select(id_col, vector_col).filter(F.col(vector_col).isNotNull())
    fields = queries.schema[query_id].dataType.simpleString(), corpus.schema[id_col].dataType.simpleString()
    ddl = f"{query_id} {fields[0]}, {id_col} {fields[1]}, similarity double"

    spark = queries.sparkSession
    asked = queries.select(query_id, query_vector).filter(F.col(query_vector).isNotNull())
    known = asked.limit(slice_rows + 1).count()
    if not known:
        return spark.createDataFrame([], ddl + ", rank int")
    if known <= slice_rows:
        ids, matrix = _shipped(asked, query_id, query_vector)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = None
            for batch in batches:
                if len(batch):
                    best = _best_of_batch(batch[id_col].to_numpy(), _unit_rows(batch[vector_col]), ids, matrix, k)
                    held = best if held is None else _best_of_both(held, best, k)
            if held is not None:
                yield held.rename(columns={"q": query_id, "i": id_col})

        found = rows.mapInPandas(score, ddl)
    elif (few := rows.limit(slice_rows + 1).count()) <= slice_rows:
        if not few:
            return spark.createDataFrame([], ddl + ", rank int")
        held_ids, held_rows = _shipped(rows, id_col, vector_col)

        def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    best = _best_of_batch(held_ids, held_rows, batch[query_id].to_numpy(), _unit_rows(batch[query_vector]), k)
                    yield best.rename(columns={"q": query_id, "i": id_col})

        found = asked.mapInPandas(rank, ddl)
    else:
        found = _grid_top_k(rows, asked, id_col, vector_col, query_id, query_vector, k, slice_rows, ddl)
    best = Window.partitionBy(query_id).orderBy(F.desc("similarity"), F.asc(id_col))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .withColumn("similarity", F.greatest(F.lit(0.0), F.col("similarity")))
        .filter(F.col("similarity") >= min_similarity)
    )


def _shipped(frame: DataFrame, key: str, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of a side that travels with the tasks; it comes to the driver as Arrow, not as Python numbers."""
    side = frame.select(F.col(key).alias("key"), F.col(vector).alias("vector")).toArrow()
    return side["key"].to_pandas().to_numpy(), _unit_rows(side["vector"].to_pandas())


def _grid_top_k(
    rows: DataFrame, asked: DataFrame, id_col: str, vector_col: str, query_id: str, query_vector: str, k: int, slice_rows: int, ddl: str
) -> DataFrame:
    """The best ``k`` corpus rows per query and tile of the corpus, for sides of any size.

    The corpus is dealt into tiles of about ``TILE_ROWS``, whatever the queries are. A cell of the grid is a tile with one part
    of the queries: within a task the tile of a cell comes first and the queries stream past it, ``slice_rows`` of them at a
    time, so a task holds one tile and one Arrow batch. There are as many parts as give every task a cell, one if there are
    tiles enough: a corpus row is sent once to each part, a query once to each tile.
    """
    tiles = max(1, -(-rows.count() // TILE_ROWS))
    parts = -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // tiles)

    def dealt(frame: DataFrame, key: str, vector: str, kind: int, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        return frame.select(
            F.lit(kind).alias("kind"), F.pmod(F.xxhash64(key), F.lit(own_count)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))).alias(other),
            F.col(key).alias("i" if kind == 0 else "q"), F.col(vector).cast("array<double>").alias("v"))

    both = dealt(rows, id_col, vector_col, 0, "tile", tiles, "part", parts).unionByName(
        dealt(asked, query_id, query_vector, 1, "part", parts, "tile", tiles), allowMissingColumns=True)
    cells = both.repartition("tile", "part").sortWithinPartitions("tile", "part", "kind")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, tile = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy() for name in ("tile", "part", "kind")], axis=1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else keys[:0, 0]
            for start, stop in zip(starts, [*starts[1:], len(keys)], strict=True):
                if cell != (cell := tuple(keys[start, :2])):
                    waiting, tile = [], None
                piece = batch.slice(start, stop - start)
                if keys[start, 2] == 0:
                    waiting.append((piece.column("i").to_numpy(zero_copy_only=False), _unit_rows(piece.column("v").to_pandas())))
                    continue
                if waiting:
                    tile, waiting = tuple(map(np.concatenate, zip(*waiting))), []
                for some in (piece.slice(at, slice_rows) for at in range(0, len(piece) if tile else 0, slice_rows)):
                    best = _best_of_batch(*tile, some.column("q").to_numpy(zero_copy_only=False), _unit_rows(some.column("v").to_pandas()), k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(best["q"], piece.column("q").type), pa.array(best["i"], piece.column("i").type), pa.array(best["similarity"])],
                        names=[query_id, id_col, "similarity"])

    return cells.select("tile", "part", "kind", "q", "i", "v").mapInArrow(score, ddl)


def _best_of_both(one: pd.DataFrame, other: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` per query of two such results, equal scores in id order."""
    both = pd.concat([one, other]).sort_values(["q", "similarity", "i"], ascending=[True, False, True], kind="stable")
    return both.groupby("q", sort=False).head(k)


def _best_of_batch(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """At most ``k`` rows per query from one Arrow batch, equal scores in id order."""
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], vectors[by_id]
    k = min(k, len(ids))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, SCORE_CELLS // len(ids))
    for start in range(0, len(query_ids), step):
        block = np.round(queries[start : start + step] @ vectors.T, SIMILARITY_DIGITS) + 0.0
        kth = np.partition(block, -k, axis=1)[:, -k]
        for row, scores in enumerate(block):
            above = np.flatnonzero(scores > kth[row])
            level = np.flatnonzero(scores == kth[row])[: k - len(above)]
            picked = np.concatenate([above, level])
            found.append((np.repeat(query_ids[start + row : start + row + 1], len(picked)), ids[picked], scores[picked]))
    q, i, similarity = (np.concatenate(part) for part in zip(*found))
    return pd.DataFrame({"q": q, "i": i, "similarity": similarity})


def pack_context(
    hits: DataFrame,
    *,
    query_id: str = "query_id",
    id_col: str = "chunk_id",
    text: str = "text",
    rank: str = "rank",
    max_chars: int = CONTEXT_CHARS,
) -> DataFrame:
    """Keep, per query and in rank order, the longest prefix of bullet lines that fits the character budget.

    Runs on top-k hits, so a window partition holds at most ``k`` rows. Texts are used whole; a line that does not fit
    ends the context.
    """
    line = F.concat(
        F.lit("- ["), F.col(id_col).cast("string"), F.lit(" | sim="), fixed_point(F.col("similarity"), 2), F.lit("] "),
        F.coalesce(F.col(text), F.lit("")),
    )
    running = Window.partitionBy(query_id).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    lines = hits.withColumn("line", line).withColumn("used_chars", F.sum(F.length("line")).over(running))
    return lines.filter(F.col("used_chars") <= max_chars)


def hashing_vectors(df: DataFrame, text_col: str, output: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """Model-free unit vectors: hashed term counts scaled to length one.

    A term counts at the place that the first 32 bits of its MD5 digest give, modulo ``dimensions``, which any SQL engine can
    state. Terms are runs of letters and digits in lower case; a text without any, or null, is the zero vector. Texts are split
    and counted by Arrow and numpy, a batch at a time; each different term of a batch is hashed once.
    """

    def run(texts: pa.Array) -> pa.Array:
        listed = pc.split_pattern_regex(texts, pattern=r"[^\p{L}\p{N}]+")
        sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
        terms = listed.flatten().dictionary_encode()
        place = np.array(
            [int.from_bytes(hashlib.md5(w.encode()).digest()[:4]) % dimensions if w else -1 for w in terms.dictionary.to_pylist()], np.int64)
        at = place[terms.indices.to_numpy(zero_copy_only=False)] if len(place) else place
        cell = np.repeat(np.arange(len(texts)) * dimensions, sizes) + at
        counts = np.bincount(cell[at >= 0], minlength=len(texts) * dimensions).reshape(len(texts), dimensions)
        length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        unit = np.divide(counts, length, out=np.zeros(counts.shape), where=length > 0).astype(np.float32)
        starts = np.arange(len(texts) + 1, dtype=np.int32) * dimensions
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(unit.ravel()))

    # arrow_udf reads the function type from the annotations, which are strings in this module.
    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return df.withColumn(output, F.arrow_udf(run, "array<float>")(F.lower(F.coalesce(F.col(text_col), F.lit("")))))


def embed(
    df: DataFrame,
    text_col: str,
    encoder: Encoder | None = None,
    *,
    output: str = "embedding",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Add a unit-length vector column.

    ``encoder`` maps a list of texts to a matrix and runs inside the tasks on Arrow batches, ``batch_size`` texts per
    call; without one, hashed term counts are used. Models with a costly load should load lazily inside the encoder,
    once per Python worker.
    """
    if encoder is None:
        return hashing_vectors(df, text_col, output)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = texts.fillna("").tolist()
            parts = [_unit_rows(encoder(values[i : i + batch_size])) for i in range(0, len(values), batch_size)]
            vectors = np.concatenate(parts).astype(np.float32) if parts else np.empty((0, 0), np.float32)
            yield pd.Series(list(vectors))

    # pandas_udf reads the function type from the annotations, which are strings in this module.
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(output, F.pandas_udf(run, "array<float>")(F.col(text_col)))


def delete_where(collection: DataFrame, where: Mapping[str, object]) -> DataFrame:
    """Rows that do not match the metadata filter; rows without the field do not match it and stay."""
    matches = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in where.items()), F.lit(bool(where)))
    return collection.filter(~matches)


def reset(collection: DataFrame) -> DataFrame:
    """The emptied collection, schema kept."""
    return collection.limit(0)
