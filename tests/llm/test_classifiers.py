"""Language, toxicity and quality: held-out accuracy, stated results for odd rows, and the fitting itself."""

import base64

import numpy as np
import pytest

from peoplelake.llm import language, quality, toxicity
from peoplelake.llm.common import hashed_sample
from peoplelake.llm.textfeatures import letters, ngrams, points

WORDS = {
    "aa": "the and with for water house river stone green little winter children morning story under over".split(),
    "bb": "der und mit haus wasser fluss stein grün klein winter kinder morgen geschichte unter über nicht".split(),
    "cc": "los con para agua casa piedra verde pequeño invierno niños mañana historia bajo sobre entre cuando".split(),
}


def texts(name, n, seed, extra=()):
    rng = np.random.default_rng(seed)
    return [" ".join([*rng.choice(WORDS[name], rng.integers(5, 40)), *extra]) for _ in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, name) for name in WORDS for t in texts(name, 60, 1)] + [(None, "aa"), ("no language", None), ("", "bb"), ("...", "cc")]
    return language.train(spark.createDataFrame(rows, "text string, lang string"))


def test_language_held_out(spark, model):
    rows = [(t, name, 0.5) for name in WORDS for t in texts(name, 40, 2)]
    out = language.identify(spark.createDataFrame(rows, "text string, truth string, score double"), model)
    assert out.columns == ["truth", "lang_pred", "score", "accepted"]
    got = out.collect()
    assert all(r["truth"] == r["lang_pred"] and r["accepted"] and 0 < r["score"] <= 1 for r in got) and len(got) == 120


def test_language_odd_rows(spark, model):
    odd = [None, "", "  \n", "1234 !!", "漢字の文書です", "the", "the " * 50_000]
    got = {r["n"]: r for r in language.identify(
        spark.createDataFrame(list(enumerate(odd)), "n int, text string"), model).collect()}
    assert all((got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False) for i in range(4))
    assert got[4]["lang_pred"] in WORDS and not got[4]["accepted"]
    assert all(got[i]["lang_pred"] == "aa" and got[i]["accepted"] for i in (5, 6))
    rows = spark.createDataFrame([(t, "x") for t in odd], "text string, accepted string")
    assert language.drop_rejected(rows, model).columns == ["text", "accepted"]
    assert sorted(len(r["text"]) for r in language.drop_rejected(rows, model).collect()) == [3, 200_000]
    assert language.identify(rows.limit(0), model).count() == 0
    empty = language.train(spark.createDataFrame([], "text string, lang string"))
    assert language.identify(rows, empty).select("lang_pred").distinct().collect() == [("und",)]


LETTERS = {  # invented words of three letter habits, as in the driver's documents
    "xx": ["th", "er", "ing", "and", "ou", "wh", "ly", "ck"], "yy": ["ein", "sch", "ung", "ch", "ie", "zu", "tz", "ver"],
    "zz": ["ción", "ar", "os", "que", "ll", "ñe", "ía", "do"]}


def invented(name, n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join("".join(rng.choice(LETTERS[name], rng.integers(1, 4))) for _ in range(rng.integers(20, 60))) for _ in range(n)]


def test_other_letters_are_rejected(spark):
    rng = np.random.default_rng(8)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 300)) for _ in range(50)]
    noise += [base64.b64encode(rng.bytes(300)).decode() for _ in range(50)]
    for left_out in LETTERS:
        rows = [(t, name) for name in LETTERS if name != left_out for t in invented(name, 150, 1)]
        found = language.train(spark.createDataFrame(rows, "text string, lang string"))
        clean = [found.predict(t) for name in LETTERS if name != left_out for t in invented(name, 150, 2)]
        assert sum(taken for _, _, taken in clean) >= 0.99 * len(clean)
        assert not any(found.predict(t)[2] for t in noise)
        assert sum(found.predict(t)[2] for t in invented(left_out, 150, 3)) <= 3


def test_floor_with_one_text_or_one_language(spark):
    one = language.train(spark.createDataFrame([(t, "xx") for t in invented("xx", 40, 1)], "text string, lang string"))
    assert one.predict(invented("xx", 1, 5)[0])[2] and not one.predict("zzqj xvkq pfgb")[2]
    rows = [(t, "xx") for t in invented("xx", 40, 1)] + [(invented("yy", 1, 1)[0], "yy")]
    two = language.train(spark.createDataFrame(rows, "text string, lang string"))
    assert all(two.predict(t)[0::2] == ("yy", True) for t in invented("yy", 20, 2))


def test_training_does_not_depend_on_partitioning(spark, model):
    rows = [(t, name) for name in WORDS for t in texts(name, 60, 1)] + [(None, "aa"), ("no language", None), ("", "bb"), ("...", "cc")]
    again = language.train(spark.createDataFrame(rows[::-1], "text string, lang string").repartition(7))
    assert np.allclose(again.idf, model.idf) and again.names == model.names and np.allclose(again.floors, model.floors)


def test_clusters_cover_distinct_groups():
    v = np.eye(4)[[0, 0, 1, 1, 2, 2]]
    found = language.cluster(v, 3)
    assert sorted(np.argmax(found, axis=1)) == [0, 1, 2]
    assert len(language.cluster(v[:2], 3)) == 1


def labelled(seed, n=150):
    rng = np.random.default_rng(seed)
    clean = [(t, 0) for t in texts("aa", n, seed)]
    bad = []
    for t in texts("aa", n // 3, seed + 1):
        words = t.split()
        words.insert(int(rng.integers(0, len(words))), ["nasty", "rotten", "vile"][rng.integers(0, 3)])
        bad.append((" ".join(words), 1))
    return clean + bad


def test_toxicity_held_out_and_odd_rows(spark):
    train = spark.createDataFrame([*labelled(3), (None, 1), ("no label", None), ("odd label", 7)], "text string, label int")
    model = toxicity.train(train)
    rows = [*labelled(9), ("", 0), (None, 0), ("the " * 30_000 + "nasty", 1)]
    out = toxicity.score(spark.createDataFrame([(t, y, "c") for t, y in rows], "text string, y int, score string"), model)
    assert out.columns == ["y", "score"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([(r["score"] >= 0.5) == r["y"] for r in got]) > 0.97
    assert toxicity.score(spark.createDataFrame([], "text string"), model).count() == 0


def test_toxicity_without_both_labels(spark):
    one = toxicity.train(spark.createDataFrame([("a", 1)], "text string, label int"))
    none = toxicity.train(spark.createDataFrame([], "text string, label int"))
    assert one.score("x") > 0.99 and none.score("x") < 0.01


def test_ratio_is_the_smoothed_log_count_ratio(spark):
    rows = [("aab", 1), ("aab", 1), ("ccd", 0)]
    model = toxicity.train(spark.createDataFrame(rows, "text string, label int"))
    seen = toxicity.present("aab")
    assert (model.weights[seen] > 0).any() and model.score("aab") > model.score("ccd")


def test_score_counts_each_ngram_once():
    model = toxicity.ToxicityModel(np.zeros(1 << toxicity.BITS), -1.0)
    model.weights[toxicity.present("bad")] = 0.5
    once, often = model.score("bad"), model.score("bad " * 9)
    assert abs(once - 1 / (1 + np.exp(1 - 0.5 * len(toxicity.present("bad"))))) < 1e-9
    assert often >= once


def graded(seed, n=80):
    out = []
    for t in texts("aa", n, seed):
        out += [(t, 2), (t.upper() + "!!", 1), (" | ".join(t.split()) + "$$$", 0)]
    return out


def fitted(spark, rows):
    """Texts by id, some of them repeated, and ratings by id, some of them of no text."""
    docs = [(i, t) for i, (t, _) in enumerate(rows)] + [(0, "again"), (None, "no id")]
    ratings = [(i, g) for i, (_, g) in enumerate(rows)] + [(0, -1), (10**6, 2), (None, 2)] if rows else []
    return quality.train(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(ratings, "doc_id bigint, grade int"))


def test_quality_order_and_odd_rows(spark):
    model = fitted(spark, [*graded(1), (None, 2), ("x", None)])
    assert model.grades == [0, 1, 2] and (np.diff(model.thresholds) > 0).all()
    rows = [*graded(5), ("", None), (None, None), ("the " * 30_000, None)]
    got = quality.rate(spark.createDataFrame([(t, g, "c") for t, g in rows], "text string, g int, tails string"), model).collect()
    assert len(got) == len(rows) and all(r["tails"][0] >= r["tails"][1] and 0 <= r["expected_grade"] <= 2 for r in got)
    assert np.mean([round(r["expected_grade"]) == r["g"] for r in got if r["g"] is not None]) > 0.9
    assert fitted(spark, []).grades == [0]
    one = quality.train(spark.createDataFrame([(1, "a")], "doc_id int, text string"), spark.createDataFrame([(1, 3)], "doc_id int, grade int"))
    assert quality.rate(spark.createDataFrame([("b",)], "text string"), one).first()["expected_grade"] == 3
    assert quality.rate(spark.createDataFrame([], "text string"), model).count() == 0


def test_ordinal_slope_matches_differences():
    """The fit ends where no small step of any parameter helps."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 2)).astype(np.float32)
    hidden = 2 * x[:, 0] - x[:, 1] + rng.logistic(size=400)
    grade = np.digitize(hidden, [-1.0, 1.5])
    w, cuts = quality.fit_ordinal(x, grade, 3, np.full(400, 1 / 400))

    def loss(w, cuts):
        tail = np.column_stack([np.ones(400), 1 / (1 + np.exp(-((x @ w)[:, None] - cuts))), np.zeros(400)])
        return -np.log(tail[np.arange(400), grade] - tail[np.arange(400), grade + 1]).mean() + quality.PENALTY * (w @ w) / 2

    best = loss(w, cuts)
    for step in np.vstack([np.eye(4), -np.eye(4)]) * 0.05:
        assert loss(w + step[:2], cuts + step[2:]) > best - 1e-4
    assert abs(w[0] - 2) < 0.5 and abs(w[1] + 1) < 0.4


def test_hashed_sample_is_bounded_and_folds_copies(spark):
    rows = [("a", f"t{i}") for i in range(500)] + [("b", "same")] * 300 + [("b", "other")]
    df = spark.createDataFrame(rows, "g string, text string")
    got = hashed_sample(df.repartition(5), "g", "text", 20, {"a": 500, "b": 301}).collect()
    assert sum(r["g"] == "a" for r in got) == 20 and sum(r["g"] == "b" for r in got) <= 2
    assert sorted(got) == sorted(hashed_sample(df, "g", "text", 20, {"a": 500, "b": 301}).collect())


def test_hashed_sample_has_every_text_of_a_group_of_copies(spark):
    rows = [("a", f"copied {i % 50}") for i in range(60_000)] + [("b", "one")] * 20_000 + [("c", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, text string")
    got = [(r["g"], r["text"]) for r in hashed_sample(df, "g", "text", 20, {"a": 60_000, "b": 20_000, "c": 3000}).collect()]
    assert len(set(got)) == len(got) and [sum(g == x for g, _ in got) for x in "abc"] == [20, 1, 20]
    got = hashed_sample(df, "g", "text", 100, {"a": 60_000, "b": 20_000, "c": 3000}).collect()
    assert [sum(r["g"] == x for r in got) for x in "abc"] == [50, 1, 100]


def test_features():
    assert "".join(map(chr, letters("Ab, cD9é"))) == " ab cd é "
    assert len(ngrams(points("abc"), 1, 5, 10)) == 6 and len(ngrams(points(""), 1, 3, 10)) == 0
    assert ngrams(points("abcabc"), 3, 3, 20)[0] == ngrams(points("abcabc"), 3, 3, 20)[3]
