"""Operator 7, embedding near-deduplication: a forest of random-projection trees with spill, compared within leaves."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import join_by_key, ship, staged
from peoplelake.llm.components import components

THRESHOLD = 0.93
TREES = 6
LEAF = 256
#: Levels that are split in one pass, and most vectors of a group that its split points are taken from: few enough that Spark
#: keeps so many per group and task before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold), whatever the group holds.
LEVELS = 6
SAMPLE = 1000
#: Half width of the overlap at a split, in standard deviations of the projected difference of two vectors that just link. A
#: level then parts about 2.5 % of the pairs that just link: 17 % over 7 levels, 49 % over 26, and six trees miss 0.002 % or 1.4 %.
SPILL = 0.4
#: A split counts if the larger side has at most this share of the vectors; a group no pass can make smaller is a leaf.
USEFUL = 0.85
#: Vectors of a leaf that one task compares with as many others.
BLOCK = 1024
SEED = 7


def directions(tree: int, depth: int, levels: int, size: int, seed: int = SEED) -> np.ndarray:
    """Unit directions, one column per level from ``depth`` on; all nodes of a level share theirs."""
    drawn = [np.random.default_rng([seed, tree, depth + i]).standard_normal(size) for i in range(levels)]
    return (np.array(drawn) / np.linalg.norm(drawn, axis=1, keepdims=True)).T


def unit(vectors) -> np.ndarray:
    found = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def margin(size: int, threshold: float) -> float:
    return SPILL * float(np.sqrt(max(0.0, 2 - 2 * threshold) / size))


def split_points(projected: np.ndarray, scale: float, leaf: int, half: float) -> np.ndarray:
    """Medians of a subtree's inner nodes in heap order, NaN where all go left: few are left, or a split wouldn't help."""
    levels = projected.shape[1]
    cuts = np.full((1 << levels) - 1, np.nan)
    at = {0: np.arange(len(projected))}
    for level in range(levels):
        below: dict[int, np.ndarray] = {}
        for node, rows in at.items():
            value = projected[rows, level]
            if len(rows) * scale > leaf and len(rows) > 1:
                cut = float(np.median(value))
                left, right = rows[value <= cut + half], rows[value > cut - half]
                if max(len(left), len(right)) <= USEFUL * len(rows):
                    cuts[node] = cut
                    below[2 * node + 1], below[2 * node + 2] = left, right
                    continue
            below[2 * node + 1] = rows
        at = below
    return cuts


def route(projected: np.ndarray, cuts: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for every leaf that a row falls into; near a split point it goes both ways."""
    rows, node = np.arange(len(projected)), np.zeros(len(projected), np.int64)
    for level in range(projected.shape[1]):
        cut, value = cuts[node], projected[rows, level]
        left = np.isnan(cut) | (value <= cut + half)
        right = ~np.isnan(cut) & (value > cut - half)
        rows, node = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    return rows, node - ((1 << projected.shape[1]) - 1)


def grow(nodes: DataFrame, trees: int, leaf: int, threshold: float) -> DataFrame:
    """(node, vector, held, tree, path): ``nodes`` (node, vector, held, path) in the leaves of every tree.

    In each pass, groups over ``leaf`` vectors get the split points of LEVELS levels from a sample of their own, and
    all their vectors are sent down. A group that a pass leaves nearly whole stays as it is. So the passes
    grow with the logarithm of the rows, and nothing of the forest is held in one place.
    """
    rows = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumns({
        "depth": F.lit(0), "was": F.lit(2.0**62)})
    rows, done = staged(rows, "forest"), None
    while True:
        sizes = staged(rows.groupBy("tree", "path").agg(F.count(F.lit(1)).alias("size"), F.first("was").alias("was")), "forest-sizes")
        large = sizes.filter((F.col("size") > leaf) & (F.col("size") <= F.col("was") * USEFUL)).select("tree", "path", "size")
        settled = rows.join(large, ["tree", "path"], "left_anti").drop("was", "depth")
        done = settled if done is None else done.unionByName(settled)
        if large.isEmpty():
            return done
        rows = staged(_send_down(rows.drop("was").join(large, ["tree", "path"]), leaf, threshold), "forest")


def sampled(rows: DataFrame) -> DataFrame:
    """At most SAMPLE rows of each group, those of the smallest hashes."""
    by_hash = Window.partitionBy("tree", "path").orderBy("place", "node")
    placed = rows.withColumn("place", F.xxhash64("vector", "tree"))
    return placed.withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= SAMPLE).drop("nth", "place", "held", "node")


def _send_down(rows: DataFrame, leaf: int, threshold: float) -> DataFrame:
    few = sampled(rows)

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        vectors, depth = unit(frame["vector"]), int(frame["depth"].iloc[0])
        size = vectors.shape[1]
        projected = vectors @ directions(int(key[0]), depth, LEVELS, size)
        cuts = split_points(projected, float(frame["size"].iloc[0]) / len(frame), leaf, margin(size, threshold))
        return pd.DataFrame({"tree": [key[0]], "path": [key[1]], "cuts": [cuts]})

    model = few.groupBy("tree", "path").applyInPandas(fit, "tree int, path string, cuts array<double>")
    joined = rows.withColumnRenamed("size", "was").join(staged(model, "forest-cuts"), ["tree", "path"])

    def send(frames):
        for frame in frames:
            for (tree, path), group in frame.groupby(["tree", "path"], sort=False):
                vectors, depth = unit(group["vector"]), int(group["depth"].iloc[0])
                size = vectors.shape[1]
                found, place = route(
                    vectors @ directions(int(tree), depth, LEVELS, size), np.asarray(group["cuts"].iloc[0]), margin(size, threshold))
                sent = group.iloc[found].drop(columns="cuts")
                yield sent.assign(path=[f"{path}.{x}" for x in place.tolist()], depth=depth + LEVELS, was=sent["was"].astype(float))

    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"tree int, path string, node bigint, vector {kind}, held bigint, depth int, was double"
    columns = [c.split()[0] for c in schema.split(", ")]
    return joined.select(*columns, "cuts").mapInPandas(lambda frames: (f[columns] for f in send(frames)), schema)


def _least(linked: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Per row of the matrix, the least label of the columns linked to it (or a large number)."""
    return np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)


def compare(one: pd.DataFrame, other: pd.DataFrame | None, leaf: int, threshold: float) -> pd.DataFrame:
    """Links within ``one`` or, if given, between ``one`` and ``other``, which share a leaf.

    Per node: ``links``, the vectors linked to it by pairs whose first common leaf this is, and ``root``, a node that links
    lead to. ``leaves`` of a row are all its leaves in the forest.
    """
    twin = other is None
    right = one if twin else other
    a, b = unit(one["vector"]), unit(right["vector"])
    linked = a @ b.T >= threshold
    if twin:
        np.fill_diagonal(linked, False)
    keep_a, keep_b = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    one, right, linked = one.iloc[keep_a], right.iloc[keep_b], linked[np.ix_(keep_a, keep_b)]
    earlier = sorted({x for leaves in [*one["leaves"], *right["leaves"]] for x in leaves if x < leaf})
    spot = {x: i for i, x in enumerate(earlier)}

    def member(frame):
        out = np.zeros((len(frame), len(earlier)), np.float32)
        for i, leaves in enumerate(frame["leaves"]):
            out[i, [spot[x] for x in leaves if x < leaf]] = 1
        return out

    first = linked & ~(member(one) @ member(right).T > 0)
    of_a = first @ right["held"].to_numpy(dtype=np.int64) if len(one) else np.zeros(0, np.int64)
    at_a, at_b = one["node"].to_numpy(dtype=np.int64), right["node"].to_numpy(dtype=np.int64)
    root_a, root_b = at_a.copy(), at_b.copy()
    while True:  # least node along links, within these rows
        new_a = np.minimum(root_a, _least(linked, root_b))
        new_b = new_a if twin else np.minimum(root_b, _least(linked.T, new_a))
        if (new_a == root_a).all() and (new_b == root_b).all():
            break
        root_a, root_b = new_a, new_b
    parts = [pd.DataFrame({"node": at_a, "links": of_a, "root": root_a})]
    if not twin:
        of_b = first.T @ one["held"].to_numpy(dtype=np.int64) if len(right) else np.zeros(0, np.int64)
        parts.append(pd.DataFrame({"node": at_b, "links": of_b, "root": root_b}))
    return pd.concat(parts).astype({"node": "int64", "links": "int64", "root": "int64"})


def leaf_links(leaves: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(node, links, root) from comparing all vectors within each leaf of :func:`grow`, block with block.

    A leaf of more than ``block`` vectors, one that can't be split, is cut into blocks by hash, and each pair of blocks is
    a task of its own. A pair that meets in several leaves is counted in the first; no pair leaves its task.
    """
    leaves = staged(leaves.withColumn("leaf", F.xxhash64("tree", "path")), "leaves")
    of_node = leaves.groupBy("node").agg(F.collect_set("leaf").alias("leaves"))  # trees times spill, not rows
    sizes = leaves.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    rows = leaves.select("leaf", "node", "vector", "held").join(of_node, "node").join(sizes.filter("blocks > 1"), "leaf", "left")
    rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "with"), "high": F.greatest("own", "with")}).drop("with", "blocks")

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        leaf, low, high = (int(k) for k in key)
        if low == high:
            return compare(frame, None, leaf, threshold)
        return compare(frame[frame["own"] == low], frame[frame["own"] == high], leaf, threshold)

    return rows.groupBy("leaf", "low", "high").applyInPandas(meet, "node bigint, links bigint, root bigint")


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, id_col: str = "vec_id",
    vector_col: str = "embedding", group_col: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``, over links of cosine >= ``threshold`` in equal groups.

    Equal vectors of a group are one node, linked among themselves. Candidates share a leaf of the forest; each is verified
    in double precision, so links are exact and those missed are pairs that no tree keeps together. Vectors of a null
    group, null, empty or zero vectors and those with null or non-finite components link with nothing; nor do vectors of
    different lengths. component_id is the smallest id reachable, itself included. Null ids come last. Other columns are not
    looked at. No rows give no rows.
    """
    ship(vectors.sparkSession)
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"  # any other type keeps its digits as doubles
    vector, group = F.col(vector_col).cast("array<float>" if single else "array<double>"), F.col(group_col)
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = group.isNotNull() & (squares > 0) & (squares < float("inf"))  # a null or NaN component makes this null or false
    rows = vectors.select(
        F.col(id_col).alias("id"), group.cast("string").alias("name"), vector.alias("vector"),
        F.coalesce(usable & ~F.isnan(squares), F.lit(False)).alias("usable"))
    keyed = staged(rows.withColumn("key", F.when(
        F.col("usable"), F.sha2(F.to_json(F.struct("name", "vector")), 256))), "vectors")
    alike = keyed.filter("usable").groupBy("key").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("held"), F.first("vector").alias("vector"), F.first("name").alias("name"))
    nodes = staged(alike.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    start = nodes.select("node", "vector", "held", F.concat(F.sha2("name", 256), F.lit(":"), F.size("vector")).alias("path"))
    found = staged(leaf_links(grow(start, trees, leaf, threshold), threshold), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    labelled = staged(
        nodes.select("node", "key", "first", "held").join(counts, "node", "left").join(joined, "node", "left").select(
            "key", "first", "held", (F.coalesce("links", F.lit(0)) + F.col("held") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component")), "vector-labels")
    names = staged(labelled.groupBy("component").agg(
        F.min("first").alias("component_id"), F.count(F.lit(1)).alias("nodes")), "vector-names")
    named = staged(join_by_key(labelled, names, "component", "nodes").select("key", "held", "n_links", "component_id"), "vector-named")
    linked = join_by_key(keyed.filter("usable").select("id", "key"), named, "key", "held").select("id", "n_links", "component_id")
    alone = keyed.filter(~F.col("usable")).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
