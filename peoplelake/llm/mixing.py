"""Operator 10, mixing sources to target weights: fixed-length blocks, multinomial counts per shard, index permutations."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.llm.common import WORD, fresh, positions, ship, staged, total_of
from peoplelake.llm.feistel import permute

BLOCK = 128
SHARD_BLOCKS = 4096
SHARE = 1.5
CAP = 2.0
#: Weights by rank of the source, repeating; fixed values.
WEIGHTS = (3.0, 1.0, 2.0)
SEED = 20240617
_WORDS = re.compile(WORD)


def word_count(text: str | Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_rank, source_size, target) per source of ``sizes`` (source, size).

    Sources are ranked by code point, null last. Together they get ``share`` of all sizes by weight; a target stops at
    ``cap`` times its source's size and the excess is shared anew among the rest, which is one level for all that are not
    full: a source is full if its cap per weight is under the level that is left once all fuller ones are. The windows run
    over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per_source.withColumn(
        "source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    at = F.col("source_rank") % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), at)
    ranked = ranked.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(cap))})
    everyone = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "due": F.sum("source_size").over(everyone) * F.lit(float(share)), "all_weight": F.sum("weight").over(everyone)})
    level = (F.col("due") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    full = ranked.withColumn("full", F.col("most") <= F.col("weight") * level)
    rest = (F.col("due") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everyone)) / (
        F.sum(F.when(~F.col("full"), F.col("weight"))).over(everyone))
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * rest)
    return full.select("source", "source_rank", "source_size", target.alias("target"))


@lru_cache(maxsize=1 << 16)
def _split(first: int, last: int, count: int, rank: int, seed: int) -> int:
    """Of ``count`` draws of a source that fall into shards ``first`` .. ``last - 1``, those in the first half."""
    middle = (first + last) // 2
    rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, rank, first, last])))
    return int(rng.binomial(count, (middle - first) / (last - first)))


def draws_in_shard(shard: int, shards: int, count: int, rank: int, seed: int = SEED) -> tuple[int, int]:
    """How many of a source's ``count`` draws fall into ``shard``, and how many into the shards before it.

    Over the shards the counts are multinomial with equal chances. Each shard finds its own by walking down a tree of
    halves whose binomial splits are seeded by their place, so no shard needs another.
    """
    first, last, before = 0, shards, 0
    while last - first > 1:
        middle, left = (first + last) // 2, _split(first, last, count, rank, seed)
        if shard < middle:
            last, count = middle, left
        else:
            first, before, count = middle, before + left, count - left
    return count, before


@dataclass
class Mix:
    """``rows``: row_id, id, size, source_rank, start per input row. ``sources``: its targets and blocks.
    ``plan``: shard, source_rank, epoch, block: what the mix takes. ``spans``: source_rank, block, row_id, offset, words:
    which words of which rows a block holds (offset counts words within the row)."""

    rows: DataFrame
    sources: DataFrame
    plan: DataFrame
    spans: DataFrame

    def taken(self) -> DataFrame:
        """(row_id, taken): words that the mix takes of a row, repeats counted; rows of which it takes none are missing."""
        times = self.plan.groupBy("source_rank", "block").agg(F.count(F.lit(1)).alias("times"))
        held = self.spans.join(times, ["source_rank", "block"])
        return held.groupBy("row_id").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))

    def pieces(self) -> DataFrame:
        """(row_id, shard, source_rank, epoch, block, offset, words): the mix itself, block by block."""
        return self.plan.join(self.spans, ["source_rank", "block"])


def mix(
    docs: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, share: float = SHARE, cap: float = CAP,
    weights: tuple = WEIGHTS, seed: int = SEED, keys: tuple[str, ...] = ("doc_id",), source_col: str = "source",
    text_col: str = "text",
) -> Mix:
    """Mix the words of ``docs`` by source.

    The words of a source, in the order of ``keys`` and text hash, are one stream cut into blocks of ``block`` words (the
    last may be shorter). A source's target gives a number of draws, at most ``cap`` per block; multinomial draws spread
    them over shards of about ``shard_blocks`` blocks; draw j takes block perm(j mod blocks), where the permutation is the
    source's own and another in each epoch j div blocks. So a block is taken at most ``cap`` (rounded up) times and all of
    them once before any is taken twice. A hot source is split by range like any other rows.

    A null text has size 0 and is never taken, nor are texts without words; a null source is a source. Rows equal in key,
    text and source are interchangeable. Other columns are not looked at. No rows give no rows.
    """
    ship(docs.sparkSession)
    narrow = docs.select(
        *(F.col(k).alias(f"key{i}") for i, k in enumerate(keys)), F.col(source_col).alias("source"),
        F.xxhash64(text_col).alias("text_hash"), word_count(text_col).alias("size"))
    sizes = staged(narrow, "mix-sizes")
    targets = source_targets(sizes, share, cap, weights)
    blocks = F.ceil(F.col("source_size") / F.lit(block)).cast("bigint")
    draws = F.round(F.col("target") * blocks / F.col("source_size")).cast("bigint")
    sources = staged(targets.withColumns({
        "blocks": blocks,
        "draws": F.when(F.col("source_size") > 0, F.least(draws, F.floor(blocks * F.lit(cap)))).otherwise(0).cast("bigint"),
    }), "mix-sources")

    # place of each row's first word in its source's stream: running sums within a partition, then of whole partitions
    order = ["source", *(f"key{i}" for i in range(len(keys))), "text_hash", "size"]
    placed = positions(sizes, order, "mix-order", lambda ranged: ranged.mapInPandas(
        _running, T.StructType([*ranged.schema.fields, T.StructField("within", T.LongType())])))
    per_part = placed.groupBy("source", "part").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_part.select("source", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("first"))
    first = first.withColumnsRenamed({"source": "of", "part": "in_part"})
    keyed = placed.join(first, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
    ranks = sources.select(F.col("source").alias("is"), "source_rank")
    keyed = keyed.join(ranks, F.col("source").eqNullSafe(F.col("is")))
    rows = staged(keyed.select(
        (F.shiftleft(F.col("part").cast("bigint"), 33) + F.col("nth")).alias("row_id"),
        *(F.col(f"key{i}").alias(k) for i, k in enumerate(keys)), "text_hash", "size", "source_rank",
        (F.col("first") + F.col("within")).alias("start")), "mix-rows")

    begin, end = F.col("start"), F.col("start") + F.col("size")
    spans = rows.filter("size > 0").select(
        "source_rank", "row_id", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    low, high = F.greatest(begin, F.col("block") * block), F.least(end, (F.col("block") + 1) * block)
    spans = spans.select("source_rank", "block", "row_id", (low - begin).alias("offset"), (high - low).alias("words"))

    shards = max(1, -(-total_of(sources, "draws") // shard_blocks))

    @F.pandas_udf("count bigint, before bigint")
    def drawn(rank: pd.Series, draws: pd.Series, shard: pd.Series) -> pd.DataFrame:
        found = [draws_in_shard(int(s), shards, int(d), int(r), seed) for r, d, s in zip(rank, draws, shard, strict=True)]
        return pd.DataFrame(found, columns=["count", "before"])

    @F.pandas_udf("bigint")
    def block_of(draw: pd.Series, blocks: pd.Series, rank: pd.Series) -> pd.Series:
        draw, blocks = draw.to_numpy(), blocks.to_numpy()
        return pd.Series(permute(draw % blocks, blocks, seed, rank.to_numpy() * 8 + draw // blocks))

    per_shard = sources.filter("draws > 0").select(
        "source_rank", "draws", "blocks", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    per_shard = per_shard.repartition("source_rank", "shard").withColumn("got", drawn("source_rank", "draws", "shard"))
    plan = per_shard.filter("got.count > 0").select(
        "shard", "source_rank", "blocks",
        F.explode(F.sequence(F.col("got.before"), F.col("got.before") + F.col("got.count") - 1)).alias("draw"))
    plan = plan.select(
        "shard", "source_rank", F.expr("draw div blocks").cast("int").alias("epoch"),
        block_of("draw", "blocks", "source_rank").alias("block"))
    return Mix(rows, sources, staged(plan, "mix-plan"), spans)


def mixed_texts(docs: DataFrame, mixed: Mix, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix as rows of ``docs``: per row and epoch, the words that were taken, as the original text has them.

    A row taken whole keeps its text byte for byte; of others, each run of neighbouring words is cut out with the white
    space inside it, and runs are joined by a line break. A row taken in no block is dropped, one taken in two epochs
    comes twice. ``mixed`` must be of the same ``docs`` by the same key; rows equal in key and text all get what the
    first of them gets. Texts are shuffled once.
    """
    rows = mixed.rows.select("row_id", "size", F.col(key).alias("mix_key"), "text_hash")
    first = rows.groupBy("mix_key", "text_hash").agg(F.min(F.struct("row_id", "size")).alias("first"))
    first = first.select("mix_key", "text_hash", "first.row_id", "first.size")
    taken = mixed.pieces().groupBy("row_id", "epoch").agg(
        F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("offset", "words"))).alias("runs"))
    runs = taken.join(first, "row_id").select(
        "mix_key", "text_hash", F.when(F.col("words") < F.col("size"), F.col("runs")).alias("runs"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([t if r is None else cut_words(t, [(x["offset"], x["words"]) for x in r])
                          for t, r in zip(text, runs, strict=True)], dtype=object)

    mark = fresh("text_hash", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64(text_col))
    joined = marked.join(runs, marked[key].eqNullSafe(runs["mix_key"]) & (marked[mark] == runs["text_hash"]))
    return joined.select(*(cut(marked[c], runs["runs"]).alias(c) if c == text_col else marked[c] for c in docs.columns))


def cut_words(text: str, runs: list[tuple[int, int]]) -> str:
    """The words of ``text`` at these (offset, count) runs, sorted by offset, with the white space within each run."""
    at = [m.span() for m in _WORDS.finditer(text)]
    joined: list[list[int]] = []
    for offset, words in runs:
        if joined and joined[-1][1] == offset:
            joined[-1][1] += words
        else:
            joined.append([offset, offset + words])
    return "\n".join(text[at[a][0]:at[b - 1][1]] for a, b in joined)


def _running(frames):
    """Add ``within``: words of the same source in the rows before, in this partition. Rows come in order of source."""
    last, total = None, 0
    for frame in frames:
        if frame.empty:
            continue
        source, size = frame["source"].to_numpy(dtype=object), frame["size"].to_numpy()
        within = np.cumsum(size) - size
        cuts = [0, *(np.flatnonzero(source[1:] != source[:-1]) + 1), len(source)]
        for a, b in pairwise(cuts):
            within[a:b] += (total if a == 0 and source[0] == last else 0) - within[a]
        last, total = source[-1], int(within[-1] + size[-1])
        yield frame.assign(within=within)
