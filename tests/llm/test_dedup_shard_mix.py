"""Exact dedup, sharding and mixing against plain Python on small tables with every odd case."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from peoplelake.llm import exact_dedup, feistel, mixing, sharding

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, part int, copies string"


def documents(spark, rows):
    """Rows of (doc_id, text, source) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, 1, "x", 7, "y") for i, t, s in rows], SCHEMA)


ODD = [
    (1, "a b c", "s0"), (2, "a b c", "s1"), (2, "a b c", "s1"), (3, None, "s0"), (4, "", None), (5, "  ", "s0"), (6, "a  b c", "s2"),
    (None, "a b c", "s0"), (None, "lonely", None), (7, "x " * 30_000, "s0"), (8, "é ü", "s2"), (9, "A b c", "s0"),
]


def test_exact_dedup_matches_brute_force(spark, tmp_path):
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), buckets=4)
    got = exact_dedup.dedup_report(documents(spark, ODD), index, "one").collect()
    groups = defaultdict(list)
    for i, text, _ in ODD:
        groups[text or ""].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            stays = i == keep and not seen
            seen |= stays
            want[i, keep, len(ids), stays, hashlib.sha256(text.encode()).digest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in got) == want


def test_index_persists_and_later_batches_lose(spark, tmp_path):
    path = str(tmp_path / "index")
    first = exact_dedup.DigestIndex.open(spark, path, buckets=4)
    exact_dedup.dedup_report(documents(spark, [(1, "a", "s"), (2, "b", "s")]), first, "one").collect()
    first.close()
    again = exact_dedup.DigestIndex.open(spark, path, buckets=99)
    assert again.buckets == 4 and again.table().count() == 2
    rows = exact_dedup.dedup_report(documents(spark, [(9, "a", "s"), (8, "c", "s"), (7, "c", "s")]), again, "two").collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in rows} == {(9, 1, False), (8, 8, True), (7, 8, False)}
    rows = exact_dedup.dedup_report(documents(spark, [(9, "a", "s"), (8, "c", "s")]), again, "two").collect()
    assert {(r["doc_id"], r["kept"]) for r in rows} == {(9, False), (8, True)} and again.table().count() == 3


def test_index_is_merged_without_a_shuffle_or_sort_of_its_own(spark, tmp_path):
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), buckets=3)  # not the session's shuffle partitions
    for batch in range(3):
        rows = [(i, f"text {i}", "s") for i in range(batch * 40, batch * 40 + 60)]
        kept = exact_dedup.dedup_report(documents(spark, rows), index, str(batch)).filter("kept").collect()
        assert {r["doc_id"] for r in kept} == {i for i, _, _ in rows if batch == 0 or i >= batch * 40 + 20}
    assert len(index.runs()) == 3 and index.table().count() == 140
    groups = documents(spark, ODD).select(exact_dedup.digest("text").alias("digest")).distinct()
    new = groups.repartition(3, "digest")
    for run in index.runs():
        new = new.join(run.hint("merge"), "digest", "left_anti")
    for found, sides in ((new, 1), (index.look_up(groups), 3)):  # only the new digests are sorted, once a branch
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == plan.count("Bucketed: true") == 3
        assert plan.count("Sort [") == sides


def test_runs_of_an_index_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUNS", 2)
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), buckets=2)
    for batch in range(4):
        exact_dedup.dedup_report(documents(spark, [(batch * 10 + i, f"t{batch * 2 + i}", "s") for i in range(3)]), index, str(batch)).collect()
        assert len(index.runs()) <= 2
    held = {bytes(r["digest"]): (r["keep_id"], r["batch"]) for r in index.table().collect()}
    want = {hashlib.sha256(f"t{n}".encode()).digest(): n for n in range(9)}
    assert held.keys() == want.keys() and index.table().count() == 9
    assert held[hashlib.sha256(b"t2").digest()] == (2, "0") and held[hashlib.sha256(b"t3").digest()] == (11, "1")


def test_exact_copies_are_dropped_whole(spark):
    kept = exact_dedup.drop_exact_copies(documents(spark, ODD))
    assert kept.columns == documents(spark, ODD).columns
    assert Counter((r["doc_id"], (r["text"] or "")[:9]) for r in kept.collect()) == Counter(
        {(2, "a b c"): 1, (4, ""): 1, (5, "  "): 1, (6, "a  b c"): 1, (None, "lonely"): 1, (7, "x x x x x"): 1, (8, "é ü"): 1, (9, "A b c"): 1})
    assert exact_dedup.drop_exact_copies(documents(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_feistel_is_a_permutation_with_inverse(n):
    x = np.arange(n)
    for tweak in (0, 5):
        y = feistel.permute(x, n, 3, tweak)
        assert sorted(y) == list(x) and (feistel.permute(y, n, 3, tweak, forward=False) == x).all()
    big = 10**12 + 7
    far = np.array([0, 1, big - 1])
    assert (feistel.permute(feistel.permute(far, big, 3), big, 3, forward=False) == far).all()
    with pytest.raises(ValueError):
        feistel.permute([n], n, 3)


def test_shards_are_even_gapless_and_computable(spark):
    got = sharding.shard_rows(documents(spark, ODD).repartition(3)).collect()
    ordered = sorted(got, key=lambda r: r["row"])
    assert [r["row"] for r in ordered] == list(range(len(ODD)))
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"]) for r in ordered]
    assert keys == sorted(keys)
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ODD)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sizes
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert sharding.row_at(r["shard"], r["slot"], len(ODD))[0] == r["row"]
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    other = sharding.shard_rows(documents(spark, ODD[::-1])).collect()
    assert Counter((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in other) == Counter(
        (r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in got)
    assert sharding.shard_rows(documents(spark, [])).count() == 0


def water_fill(size, share, cap, weights):
    names = sorted(size, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full, due = dict.fromkeys(names, 0.0), set(), share * sum(size.values())
    while True:
        rest = [s for s in names if s not in full]
        left = due - sum(cap * size[s] for s in full)
        for s in rest:
            target[s] = left * weight[s] / sum(weight[x] for x in rest)
        over = {s for s in rest if target[s] >= cap * size[s]}
        if not over:
            return target
        for s in over:
            target[s] = cap * size[s]
        full |= over


def mixture(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = list(ODD)
    for i in range(100, 300):
        words = ["w%d" % x for x in rng.integers(0, 50, rng.integers(0, 60))]
        rows.append((i, "\t".join(words) if i % 3 else " ".join(words), f"s{min(9, int(rng.exponential(2)))}"))
    return rows, documents(spark, rows)


def test_mix_targets_and_takings(spark):
    rows, docs = mixture(spark)
    mixed = mixing.mix(docs, block=8, shard_blocks=64)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = Counter()
    for _, t, s in rows:
        size[s] += words(t)
    target = water_fill(size, 1.5, 2.0, (3.0, 1.0, 2.0))
    sources = {r["source"]: r for r in mixed.sources.collect()}
    assert {s: r["source_size"] for s, r in sources.items()} == dict(size)
    assert all(abs(sources[s]["target"] - target[s]) < 1e-6 for s in size)
    of_rank = {r["source_rank"]: s for s, r in sources.items()}
    taken = {r["row_id"]: r["taken"] for r in mixed.taken().collect()}
    per_source = Counter()
    for r in mixed.rows.collect():
        assert taken.get(r["row_id"], 0) <= 2 * r["size"]
        per_source[of_rank[r["source_rank"]]] += taken.get(r["row_id"], 0)
    assert all(abs(per_source[s] - target[s]) <= 8 for s in size)
    # spans tile each stream without gaps
    blocks = Counter()
    for r in mixed.spans.collect():
        blocks[r["source_rank"], r["block"]] += r["words"]
    for s, r in sources.items():
        held = [blocks[r["source_rank"], b] for b in range(r["blocks"])]
        assert sum(held) == size[s] and all(x == 8 for x in held[:-1])
    again = mixing.mix(docs.repartition(5), block=8, shard_blocks=64)
    key = ["shard", "source_rank", "epoch", "block"]
    assert sorted(map(tuple, again.plan.select(key).collect())) == sorted(map(tuple, mixed.plan.select(key).collect()))


def test_each_epoch_takes_a_block_once(spark):
    _, docs = mixture(spark, 1)
    plan = [tuple(r) for r in mixing.mix(docs, block=8, shard_blocks=16).plan.select("source_rank", "epoch", "block").collect()]
    assert len(plan) == len(set(plan)) and {e for _, e, _ in plan} <= {0, 1}
    first, second = ({(s, b) for s, e, b in plan if e == k} for k in (0, 1))
    full = {s for s, _ in second}
    assert all((s, b) in first for s, b in second) and full


def test_draws_over_shards_add_up():
    for shards in (1, 2, 7, 100):
        counts = [mixing.draws_in_shard(s, shards, 1000, 3) for s in range(shards)]
        assert sum(c for c, _ in counts) == 1000
        assert [b for _, b in counts] == list(np.cumsum([0] + [c for c, _ in counts])[:-1])


def test_mixed_texts(spark):
    rows, docs = mixture(spark, 2)
    mixed = mixing.mix(docs, block=8, shard_blocks=64)
    out = mixing.mixed_texts(docs, mixed).collect()
    text = defaultdict(set)
    for i, t, _ in rows:
        text[i].add(t)
    taken = Counter()
    for r in out:
        whole = next(iter(text[r["doc_id"]])) if len(text[r["doc_id"]]) == 1 else None
        if whole is not None:
            assert r["text"] == whole or all(run in whole for run in r["text"].split("\n"))
        taken[r["doc_id"]] += len(r["text"].split())
    want = defaultdict(int)
    by_row = {r["row_id"]: r["doc_id"] for r in mixed.rows.collect()}
    for r in mixed.taken().collect():
        want[by_row[r["row_id"]]] += r["taken"]
    assert all(taken[i] == want[i] for i in range(100, 300))
    assert mixing.mixed_texts(documents(spark, []), mixing.mix(documents(spark, []))).count() == 0


def test_cut_words():
    assert mixing.cut_words(" a  b\tc d e", [(0, 1), (1, 2), (4, 1)]) == "a  b\tc\ne"
