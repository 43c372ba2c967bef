"""SimHash and embedding links, and components, against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from peoplelake.llm import embeddings, simhash
from peoplelake.llm.components import components


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def plain_fingerprint(text, width=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(1)
    for text in [None, "", " \t", "One", "É ü\x1cx", "a b c d", "A B c D e f", " ".join(rng.choice("abcdef") for _ in range(500)),
                 "x y z", "w " * 70_000]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize(("per_prefix", "per_slice", "wide", "forests"), [(1024, 4096, 1, 1), (4, 8, 1, 1), (2, 3, 4, 3)])
def test_ball_links_connect_what_all_pairs_do(spark, per_prefix, per_slice, wide, forests):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(120)} | {0, (1 << 64) - 1}
    for p in list(prints)[:40]:  # chains and dense balls
        for _ in range(rng.randint(1, 12)):
            p ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 5))) & ((1 << 64) - 1)
            prints.add(p)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    want = least_reachable(signed.values(), [
        (signed[a], signed[b]) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4])
    frame = spark.createDataFrame([(0, p) for p in signed.values()], "tab int, print bigint")
    links = simhash.ball_links(frame, per_prefix=per_prefix, per_slice=per_slice, wide=wide, forests=forests).collect()
    back = {v: k for k, v in signed.items()}
    assert all((back[r["a"]] ^ back[r["b"]]).bit_count() <= 4 for r in links)
    assert least_reachable(signed.values(), [(r["a"], r["b"]) for r in links]) == want
    with pytest.raises(ValueError):
        simhash.ball_links(frame, radius=3)


TEXT = " ".join(f"word{i}" for i in range(300))
ODD = [(5, None), (6, ""), (4, " \n"), (9, TEXT), (2, TEXT), (2, TEXT), (7, TEXT.upper()), (8, TEXT + " more"), (1, "other words here"),
       (None, TEXT), (3, "long " * 50_000)]


def test_near_duplicates_match_all_pairs(spark):
    docs = spark.createDataFrame([(i, t, "c", "c", 1) for i, t in ODD], "doc_id bigint, text string, print string, component string, id int")
    got = simhash.near_duplicates(docs).collect()
    prints = {n: plain_fingerprint(t) for n, (_, t) in enumerate(ODD)}
    group = least_reachable(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])
    least = {g: min(ODD[n][0] for n in prints if group[n] == g and ODD[n][0] is not None) for g in set(group.values())}
    want = sorted((ODD[n][0] or -1, prints[n], least[group[n]]) for n in prints)
    assert sorted((r["doc_id"] or -1, r["print"] % (1 << 64), r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def near_texts(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(25):
        words = [f"t{rng.randrange(10**6)}" for _ in range(rng.randint(60, 250))]
        for _ in range(4):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((n, " ".join(copy)))
            n += 1
    return rows


def test_alike_texts_are_exact_and_nearly_complete(spark):
    rows = near_texts(4)
    got = {r["doc_id"]: r["component_id"] for r in simhash.alike_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    sets = {i: {tuple(w) for w in zip(*(t.split()[k:] for k in range(5)), strict=False)} for i, t in rows}
    links = [(a, b) for a, _ in rows for b, _ in rows if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    want = least_reachable([i for i, _ in rows], links)
    assert all(want[i] == want[got[i]] for i in got)  # never joins what all pairs don't
    assert sum(got[a] == got[b] for a, b in links) >= 0.95 * len(links) and len(links) > 20


@pytest.mark.parametrize("options", [{}, {"few": 8, "block": 16}])
def test_alike_texts_among_many_of_one_template(spark, options):
    """Texts at 0.74 of each other and 60 pairs at 0.84: every pair is to be found, and no other."""
    rng = random.Random(11)
    shared, rows = [f"s{i}" for i in range(174)], []

    def own(n):
        return [f"u{rng.randrange(10**9)}" for _ in range(n)]

    for n in range(300):
        tail = own(30)
        rows.append((2 * n, " ".join(shared + tail)))
        rows.append((2 * n + 1, " ".join(shared + (tail[:13] + own(17) if n < 60 else own(30)))))
    sets = {i: {tuple(w) for w in zip(*(t.split()[k:] for k in range(5)), strict=False)} for i, t in rows}
    links = [(a, b) for a, _ in rows for b, _ in rows if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    assert links == [(2 * n, 2 * n + 1) for n in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.alike_texts(frame, **options).collect()}
    missed = [(a, b) for a, b in links if got[a] != got[b]]
    assert missed == [] and got == least_reachable([i for i, _ in rows], links)


def test_alike_texts_look_at_sets_not_at_repeats():
    """A line that one text repeats leaves the sets at 0.95, so nearly half of the keys, of repeats at 1 to 40, are shared."""
    rng = random.Random(5)
    for times in (5, 10, 40):
        for _ in range(10):
            words = [f"w{rng.randrange(10**9)}" for _ in range(300)]
            line = [f"l{rng.randrange(10**9)}" for _ in range(12)]
            a, b = (simhash.band_keys(simhash.shingle_hashes(" ".join(t), 5), 24, 5) for t in (words, words + line * times))
            again = simhash.band_keys(np.unique(simhash.shingle_hashes(" ".join(words + line * times), 5)), 24, 5)
            assert (a == b).sum() >= 8 and (b == again).all()


def test_alike_texts_with_a_repeated_line(spark):
    rng = random.Random(6)
    rows = []
    for n in range(20):
        words = [f"w{rng.randrange(10**9)}" for _ in range(300)]
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(words + [f"l{n}x{i}" for i in range(12)] * 20))]
    got = {r["doc_id"]: r["component_id"] for r in simhash.alike_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_near_copies_are_dropped(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in ODD], "doc_id bigint, text string, component_id string")
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 2, 3, 4]
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(0, i) for i in range(1000, 1400)] + [
        (i, i + 1) for i in range(2000, 2200)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == least_reachable({n for link in real for n in link}, real)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(120):
            v = rng.standard_normal(16)
            for _ in range(rng.integers(1, 5)):
                w = v / np.linalg.norm(v) + rng.standard_normal(16) * rng.choice([0, 0.02, 0.07, 0.1])
                rows.append((n, [float(x) for x in w.astype(np.float32)], label))
                n += 1
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3, [1.0] * 3, [1.0] * 4]
    return rows + [(n + i, v, 0) for i, v in enumerate(odd)]


@pytest.mark.parametrize(("leaf", "block", "trees"), [(256, 1024, 2), (20, 16, 8)])
def test_embedding_links_match_all_pairs(spark, monkeypatch, leaf, block, trees):
    monkeypatch.setattr(embeddings, "LEVELS", 2)
    monkeypatch.setattr(embeddings.leaf_links, "__defaults__", (block,))
    rows = vectors(6)
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, node string, held int")
    got = {r["vec_id"]: r for r in embeddings.near_vectors(frame, trees=trees, leaf=leaf).collect()}
    usable = {i: (v, lab) for i, v, lab in rows if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = []
    for a, (v, la) in usable.items():
        for b, (w, lb) in usable.items():
            if a < b and la == lb and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                links.append((a, b))
    degree = {i: 0 for i, _, _ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    found = sum(r["n_links"] for r in got.values())
    assert len(got) == len(rows) and all(got[i]["n_links"] <= degree[i] for i in degree)
    assert found >= 0.97 * 2 * len(links) > 400
    want = least_reachable(degree, links)
    if found == 2 * len(links):
        assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(want[i] == want[r["component_id"]] and r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_embedding_copies_and_empty(spark):
    rows = [(i, [1.0, 2.0], 1) for i in range(50)] + [(None, [1.0, 2.0], 1), (3, [1.0, 2.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = embeddings.near_vectors(frame).collect()
    assert len(got) == 52 and {(r["n_links"], r["component_id"]) for r in got} == {(51, 0)}
    assert embeddings.near_vectors(frame.limit(0)).count() == 0


def test_a_group_sends_few_rows_to_its_sample(spark):
    """Spark limits the rows of a group in every task before the shuffle, so no task gets all vectors of a label."""
    rows = spark.range(5000).selectExpr(
        "int(id % 1) AS tree", "concat('a', id % 1) AS path", "id AS node", "array(id + 1F, 2F) AS vector", "1L AS held", "0 AS depth", "5000L AS size")
    few = embeddings.sampled(rows)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert few.count() == embeddings.SAMPLE and set(few.columns) == {"tree", "path", "vector", "depth", "size"}


def test_embeddings_of_doubles_keep_their_digits(spark):
    """A cosine just under the threshold in double precision that single precision would round to above it."""
    def pair(cosine, length):
        return [1.0, 0.0], [length * cosine, length * float(np.sqrt(1 - cosine * cosine))]

    def cosine(a, b):
        return float(np.dot(embeddings.unit([a])[0], embeddings.unit([b])[0]))

    a, b = next(p for i in range(1, 2000) for p in [pair(embeddings.THRESHOLD - 1e-9, 1 + i / 1000)]
                if cosine(*p) < embeddings.THRESHOLD <= cosine(*(np.float32(v) for v in p)))
    for kind, links in (("double", 0), ("float", 1)):
        frame = spark.createDataFrame([(1, a, 0), (2, b, 0)], f"vec_id bigint, embedding array<{kind}>, label int")
        assert {r["n_links"] for r in embeddings.near_vectors(frame).collect()} == {links}


@pytest.mark.parametrize("trees", [embeddings.TREES])
def test_embedding_recall_at_the_threshold(spark, trees):
    """4 000 vectors, each with one other at a cosine between 0.93 and 0.95, in trees with several levels of splits."""
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((2, 2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (b * a).sum(axis=1, keepdims=True) * a
    c = rng.uniform(0.9305, 0.95, size=(2000, 1))
    both = np.concatenate([a, c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b, axis=1, keepdims=True)]).astype(np.float32)
    unit = embeddings.unit(both)
    want = int((unit @ unit.T >= embeddings.THRESHOLD).sum()) - len(unit)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(both)], "vec_id bigint, embedding array<float>, label int")
    found = embeddings.near_vectors(frame, trees=trees, leaf=64).agg({"n_links": "sum"}).first()[0]
    assert 0.99 * want <= found <= want and want >= 4000


def test_pipeline_links_by_fingerprint_first(spark):
    """Every link of operator 6 counts in the pipeline's stage, and those of alike sets beside them."""
    import corpus_pipeline

    rng = random.Random(12)
    words = [f"w{rng.randrange(10**9)}" for _ in range(40)]
    rows = [(n, " ".join([words[n % 40]] * 3)) for n in range(4)]
    long = [f"v{i}" for i in range(40)]
    line = "one line that comes often in a text and settles bits".split() * 30
    for n in range(6):  # the repeated line settles the bits, the sets share little
        rows.append((10 + n, " ".join(line + [f"own{n}x{i}" for i in range(30)])))
    rows += [(20, " ".join(long)), (21, " ".join(long[:38] + ["else", "where"])), (22, " ".join(long[:20]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = {i: plain_fingerprint(t) for i, t in rows}
    sets = {i: {tuple(w) for w in zip(*(t.split()[k:] for k in range(5)), strict=False)} or {tuple(t.split())} for i, t in rows}
    by_print = [(a, b) for a, _ in rows for b, _ in rows if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    by_set = [(a, b) for a, _ in rows for b, _ in rows if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    assert set(by_print) - set(by_set)
    want = least_reachable([i for i, _ in rows], by_print + by_set)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()}
    assert kept == set(want.values())
    assert corpus_pipeline.near_dedup_stage(spark, docs.limit(0), "").count() == 0
