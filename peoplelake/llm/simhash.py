"""Operator 6, SimHash near-deduplication: fingerprints meet in the middle of their Hamming balls."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.llm.common import fresh, join_by_key, ship, staged
from peoplelake.llm.components import components

BITS = 64
WIDTH = 4
RADIUS = 4
SEED = 42
#: Fingerprints per prefix for which the prefix length is chosen, and for which one task makes the variants.
PER_PREFIX = 1024
PER_SLICE = 4096
#: Bands in whose cells texts are first compared with one of the cell, and members of sets counted in one product.
FIRST_BANDS = 8
BLOCK_MEMBERS = 4096
_STEP = 1 << 16


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Hash of every word shingle of a text, repeats included, A-Z in lower case; fewer words than ``width`` are one."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII white space and letters only
    if not words:
        return np.zeros(0, "<u8")
    line, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(words) < width:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[:len(words) - width + 1], ends[width - 1:]
    of = xxhash.xxh64_intdigest
    return np.array([of(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    """Bit i of the result is 1 if it is set in over half of the hashes; 0 for none."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _STEP):
        bits = np.unpackbits(hashes[at:at + _STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """SimHash of the word shingles of a text; 0 without words."""
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """(id, print): the fingerprint of each whole text, as a signed long."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["id", "print"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("print", T.LongType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def ball(bits: int, radius: int) -> list[int]:
    """All words of ``bits`` bits with at most ``radius`` ones."""
    return [sum(1 << i for i in ones) for r in range(radius + 1) for ones in combinations(range(bits), r)]


def _met(prefix: int, lead: int, slices: int, cut: int, prints: np.ndarray, radius: int, bits: int, wide: int) -> np.ndarray:
    """Pairs among ``prints`` that meet in a variant with this prefix of ``lead`` bits, as rows of two prints.

    Variants are made here from the prints in whose half-radius ball the prefix lies. ``cut`` of ``slices`` is the share of
    the variants that this call looks at. The prints that made a variant are paired each with the next ``wide`` and with the
    first of them; pairs are places in ``prints``, each once and checked.
    """
    low, half = bits - lead, radius // 2
    spent = np.bitwise_count((prints >> np.uint64(low)) ^ np.uint64(prefix))
    base, below = np.uint64(prefix << low), np.uint64((1 << low) - 1)
    made, owner = [], []
    for flips in range(half + 1):
        own = np.flatnonzero(spent == flips)
        masks = np.array(ball(low, half - flips), dtype=np.uint64)
        step = max(1, (1 << 22) // len(masks))
        for at in range(0, len(own), step):
            some = own[at:at + step]
            variants = ((prints[some] & below) | base)[:, None] ^ masks
            who = np.repeat(some, len(masks)).astype(np.int32)
            variants = variants.ravel()
            if slices > 1:
                here = (variants * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(slices) == cut
                variants, who = variants[here], who[here]
            made.append(variants)
            owner.append(who)
    variants, owner = np.concatenate(made), np.concatenate(owner)
    order = np.sort(variants)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    del order
    if not twice.size:
        return np.zeros((0, 2), np.uint64)
    at = np.minimum(np.searchsorted(twice, variants), len(twice) - 1)
    hit = np.flatnonzero(twice[at] == variants)
    hit = hit[np.lexsort((owner[hit], variants[hit]))]
    made, who = variants[hit], owner[hit]
    first = np.flatnonzero(np.append(True, made[1:] != made[:-1]))
    pairs = [np.stack([who[np.repeat(first, np.diff(np.append(first, len(made))))], who], axis=1)]
    for step in range(1, wide + 1):
        same = made[step:] == made[:-step]
        pairs.append(np.stack([who[:-step][same], who[step:][same]], axis=1))
    found = np.unique(np.concatenate(pairs), axis=0)
    apart = np.bitwise_count(prints[found[:, 0]] ^ prints[found[:, 1]])
    keep = (found[:, 0] != found[:, 1]) & (apart <= radius)
    return found[keep][np.argsort(apart[keep], kind="stable")]


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Places of the pairs, taken in order, that make a spanning forest of them."""
    parent: dict[int, int] = {}
    kept = []

    def root(x: int) -> int:
        while (above := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[above]
        return x

    for at, (a, b) in enumerate(pairs.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            kept.append(at)
    return np.array(kept, dtype=np.int64)


def ball_links(
    prints: DataFrame, radius: int = RADIUS, bits: int = BITS, wide: int = 1, forests: int = 1,
    per_prefix: int = PER_PREFIX, per_slice: int = PER_SLICE,
) -> DataFrame:
    """(tab, a, b): links that connect the same fingerprints as all pairs of ``prints`` (tab, print; distinct) within ``radius``.

    Two fingerprints of a table ``tab`` within the radius have a word within half the radius of both. Each is sent to every
    prefix of such a word, where all its words with that prefix are made and meet those of others: all variants are made,
    once each, but only prefixes are shuffled. Prefixes are long enough for ``per_prefix`` prints each on average; one that
    holds over ``per_slice`` is dealt to several tasks by a hash of the word. All prints that made a word are within the
    radius of each other, so each need only be linked to the next ``wide``; of all links of a task, nearest first, as many
    spanning forests are returned as ``forests`` says, so there are never more than that many per print and prefix. The radius
    must be even.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    ship(prints.sparkSession)
    most = prints.groupBy("tab").count().agg(F.max("count")).first()[0] or 0
    lead = min(24, bits - 8, max(4, (most // per_prefix).bit_length()))
    prefix = F.shiftrightunsigned("print", bits - lead)
    sizes = prints.groupBy("tab", prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("held"))
    heavy = sizes.filter(F.col("held") > per_slice).select(
        "tab", "prefix", F.ceil(F.col("held") / F.lit(per_slice)).cast("int").alias("slices"))
    near = prints.select("tab", "print", F.explode(F.array(*[
        F.lit(m) for m in ball(lead, radius // 2)])).alias("flip")).select(
        "tab", "print", prefix.bitwiseXOR(F.col("flip").cast("bigint")).alias("prefix"))
    dealt = near.join(heavy, ["tab", "prefix"], "left").select(
        "tab", "print", "prefix", F.coalesce("slices", F.lit(1)).alias("slices"))
    dealt = dealt.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held = np.sort(frame["print"].to_numpy().view(np.uint64))
        pairs = _met(int(key[1]), lead, int(frame["slices"].iloc[0]), int(key[2]), held, radius, bits, wide)
        taken = []
        for _ in range(forests):
            some = _forest(pairs)
            taken.append(held[pairs[some]])
            pairs = np.delete(pairs, some, axis=0)
        found = np.concatenate(taken).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"tab": np.full(len(found), key[0], np.int32), "a": found[:, 0], "b": found[:, 1]})

    return dealt.groupBy("tab", "prefix", "cut").applyInPandas(meet, "tab int, a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, print, component_id) per row of ``docs``: component_id is the smallest id reachable over links.

    Texts link when their fingerprints differ in ``radius`` bits or fewer. Equal fingerprints are one node with any number
    of rows. Null and empty texts have fingerprint 0 and link like any other. Null ids never name a component unless all
    ids of it are null. Other columns are not looked at. No rows give no rows.
    """
    rows = staged(fingerprints(docs, id_col, text_col, width), "simhash")
    nodes = staged(rows.groupBy("print").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("held")), "simhash-nodes")
    found = components(ball_links(nodes.select(F.lit(0).alias("tab"), "print"), radius).select("a", "b"))
    labelled = staged(nodes.join(found, nodes["print"] == found["node"], "left").select(
        "print", "first", "held", F.coalesce("component", "print").alias("component")), "simhash-labels")
    names = labelled.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("prints"))
    named = join_by_key(labelled, staged(names, "simhash-names"), "component", "prints")
    out = join_by_key(rows, staged(named.select("print", "held", "component_id"), "simhash-named"), "print", "held")
    return out.select(F.col("id").alias(id_col), "print", "component_id")


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band of a shingle set, repeats aside: two sets share each key with their Jaccard similarity to the ``rows``."""
    keys = np.zeros(bands, np.uint64)
    for band in range(bands):
        key = np.uint64(2 * band + 1)
        for row in range(band * rows, (band + 1) * rows):
            mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(2 * (0x4F1BBCDCBFA53E0B + 7919 * row) + 1)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            least = mixed.min() if len(mixed) else np.uint64(0)
            key = np.bitwise_xor(key, np.bitwise_xor(least, least >> np.uint64(31))).reshape(1) * np.uint64(0x9E3779B97F4A7C15)
            key = (key ^ (key >> np.uint64(32)))[0]
        keys[band] = key
    return keys.view(np.int64)


def set_links(nodes: np.ndarray, groups: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Pairs of nodes of different groups whose sets are alike, all compared, as a spanning forest of them.

    With two sides, only pairs across them are compared. Shared members are counted by products of 0/1 blocks.
    """
    size = np.array([len(s) for s in sets])
    members = np.concatenate([*sets, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(sets)), size)
    _, member, times = np.unique(members, return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1
    several = times[member] > 1
    member, owner = place[member[several]], owner[several]
    order = np.argsort(member, kind="stable")
    member, owner = member[order], owner[order]
    a = np.flatnonzero(sides == sides.min())
    b = np.flatnonzero(sides == sides.max())
    shared = np.zeros((len(a), len(b)), np.int64)
    for low in range(0, int(member[-1]) + 1 if len(member) else 0, BLOCK_MEMBERS):
        start, stop = np.searchsorted(member, [low, low + BLOCK_MEMBERS])
        held = np.zeros((len(sets), BLOCK_MEMBERS), np.float32)
        held[owner[start:stop], member[start:stop] - low] = 1
        shared += (held[a] @ held[b].T).astype(np.int64)
    union = size[a][:, None] + size[b][None, :] - shared
    alike = np.where(union > 0, shared / np.maximum(union, 1), 1.0) >= similarity
    found = np.argwhere(alike & (groups[a][:, None] != groups[b][None, :]))
    ends = np.stack([a[found[:, 0]], b[found[:, 1]]], axis=1)
    ends = ends[ends[:, 0] != ends[:, 1]]
    return nodes[ends[_forest(ends)]].reshape(-1, 2)


def print_links(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that connect the same nodes of ``nodes`` (node, print) as all pairs of prints within ``radius``: every node
    with the first of its print, and the firsts of prints that :func:`ball_links` links."""
    firsts = staged(nodes.groupBy("print").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("held")), "print-firsts")
    same = join_by_key(nodes.select("node", "print"), firsts, "print", "held").filter(F.col("node") != F.col("first"))
    found = staged(ball_links(firsts.select(F.lit(0).alias("tab"), "print"), radius), "print-links")
    ends = [firsts.select(F.col("print").alias(side), F.col("first").alias(f"first_{side}")) for side in ("a", "b")]
    apart = found.join(ends[0], "a").join(ends[1], "b")
    return staged(same.select(F.col("first").alias("a"), F.col("node").alias("b")).unionByName(
        apart.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))), "near-prints")


def alike_texts(
    docs: DataFrame, width: int = 5, similarity: float = 0.8, bands: int = 24, rows: int = 5, few: int = 32, block: int = 256,
    id_col: str = "doc_id", text_col: str = "text", radius: int | None = None,
) -> DataFrame:
    """(id, text_hash, component_id) per distinct (id, text) of ``docs``: component_id is the smallest id reachable over links.

    With a ``radius``, texts link first as in :func:`near_duplicates`: by fingerprints that differ in that many bits or fewer,
    found by :func:`ball_links`. All else adds links to those. Texts link whose sets of ``width``-word shingles have a Jaccard similarity of ``similarity`` or more. At 0.8 one bit in
    seven of a SimHash differs, too many for a ball that can be listed, so texts meet in cells of equal band keys of minima
    of their sets: a pair at 0.8 has no cell in common in 1 case of 14 000, nearer pairs more seldom. First each text is
    compared with one of each of its first cells, which joins most copies. Then every pair of a cell that these links have
    not joined is compared on its sets: by pairs in cells of up to ``few`` texts, in larger ones by two blocks of ``block``
    texts a task. Only links that passed leave pairs out. Null and empty texts are all alike. Null ids come last.
    """
    spark = docs.sparkSession
    ship(spark)
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.select(F.col(id_col).alias("id"), text_hash.alias("text_hash"), F.col(text_col).alias("text"))

    def sign(batches):
        for batch in batches:
            found = [band_keys(shingle_hashes(t.as_py(), width), bands, rows).tolist() for t in batch.column(2)]
            prints = [0 if radius is None else fingerprint(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.list_(pa.int64())), pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=["id", "text_hash", "keys", "print"])

    schema = T.StructType(
        [*keyed.schema.fields[:2], T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("print", T.LongType())])
    signed = staged(keyed.mapInArrow(sign, schema), "signed")
    nodes = staged(signed.dropDuplicates(["id", "text_hash"]).withColumn("node", F.monotonically_increasing_id()), "signed-nodes")
    near = print_links(nodes, radius) if radius is not None else nodes.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    cells = nodes.select("node", F.posexplode("keys").alias("band", "cell"))
    # of each cell a node that differs from band to band; cells of one node are left out
    heads = staged(cells.groupBy("cell").agg(
        F.min(F.struct(F.xxhash64("node", "cell").alias("lot"), "node"))["node"].alias("head"), F.count(F.lit(1)).alias("held")
    ).filter("held > 1"), "heads")
    cells = staged(join_by_key(cells, heads, "cell", "held"), "cells")

    wanted = cells.select("node").distinct()
    own = nodes.select(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"), "node").join(wanted, "node")
    texts = keyed.join(own, keyed["id"].eqNullSafe(own["own_id"]) & (keyed["text_hash"] == own["own_hash"])).select("node", "text")

    def gather(batches):
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), width)).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    sets = staged(texts.mapInArrow(gather, "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "shingle-sets")

    @F.pandas_udf("double")
    def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - shared
            return shared / union if union else 1.0

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=float)

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = staged(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "pairs")
        both = pairs.join(sets.withColumnsRenamed({"node": "x", "shingles": "sx"}), "x").join(
            sets.withColumnsRenamed({"node": "y", "shingles": "sy"}), "y")
        return both.filter(jaccard("sx", "sy") >= similarity).select(F.col("x").alias("a"), F.col("y").alias("b"))

    first = cells.filter((F.col("band") < FIRST_BANDS) & (F.col("node") != F.col("head")))
    links = staged(checked(first.select(F.col("node").alias("x"), F.col("head").alias("y"))).unionByName(near), "first-links")
    joined = staged(components(links), "joined")
    grouped = staged(cells.join(joined, "node", "left").select(
        "cell", "node", F.coalesce("component", "node").alias("group")), "grouped")
    shares = grouped.groupBy("cell", "group").agg(F.count(F.lit(1)).alias("rows"))
    mixed = staged(shares.groupBy("cell").agg(
        F.sum("rows").alias("held"), F.max(F.struct("rows", "group")).alias("most"), F.count(F.lit(1)).alias("groups")
    ).filter("groups > 1").select("cell", "held", F.col("most.rows").alias("major"), F.col("most.group").alias("lead")), "mixed")

    small = grouped.join(mixed.filter(F.col("held") <= few).select("cell"), "cell")
    pairs = small.alias("p").join(small.alias("q"), "cell").filter("p.node < q.node and p.group <> q.group").select(
        F.col("p.node").alias("x"), F.col("q.node").alias("y"))
    # larger cells: blocks of the nodes outside the largest group come first, and each meets every block
    large = mixed.filter(F.col("held") > few)
    dealt = join_by_key(grouped, large, "cell", "held")
    lone = F.col("held") <= block
    minor = F.when(lone, 1).otherwise(F.ceil((F.col("held") - F.col("major")) / F.lit(block)).cast("int"))
    major = F.when(lone, 0).otherwise(F.ceil(F.col("major") / F.lit(block)).cast("int"))
    lot = F.xxhash64("node", "cell")
    dealt = dealt.withColumns({"minor": minor, "all": minor + major}).withColumn("at", F.when(
        ~lone & (F.col("group") == F.col("lead")), F.col("minor") + F.pmod(lot, F.col("all") - F.col("minor"))).otherwise(
        F.pmod(lot, F.col("minor"))).cast("int"))
    others = F.sequence(F.lit(0), F.when(F.col("at") < F.col("minor"), F.col("all") - 1).otherwise(F.col("minor") - 1))
    dealt = dealt.withColumn("other", F.explode(others)).select(
        "cell", F.least("at", "other").alias("p"), F.greatest("at", "other").alias("q"), "at", "node", "group")

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        found = set_links(frame["node"].to_numpy(), frame["group"].to_numpy(), frame["at"].to_numpy(), list(frame["shingles"]), similarity)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    met = dealt.join(sets, "node").groupBy("cell", "p", "q").applyInPandas(meet, "a bigint, b bigint")
    found = components(links.unionByName(checked(pairs)).unionByName(met))
    labelled = staged(nodes.select("id", "text_hash", "node").join(found, "node", "left").select(
        "id", "text_hash", F.coalesce("component", "node").alias("component")), "alike")
    names = staged(labelled.groupBy("component").agg(
        F.min("id").alias("component_id"), F.count(F.lit(1)).alias("held")), "alike-names")
    out = join_by_key(labelled, names, "component", "held")
    return out.select(F.col("id").alias(id_col), "text_hash", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id names their group by :func:`alike_texts`: one document of each, with all its columns.

    Rows that repeat the id that stays are kept only if their text is of that group.
    """
    marked = alike_texts(docs.select(id_col, text_col), id_col=id_col, text_col=text_col, **options)
    own, mark = fresh("own_id", docs.columns), fresh("own_hash", docs.columns)
    kept = marked.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(
        F.col(id_col).alias(own), F.col("text_hash").alias(mark))
    same = F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == kept[mark]
    return docs.join(kept, docs[id_col].eqNullSafe(kept[own]) & same, "left_semi")
