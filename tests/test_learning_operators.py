"""Quasi-Newton minima, largest inner products and naive Bayes against plain computations."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import feature, recommendation
from pyspark.sql import functions as F

from tarnwork.catalog import registered
from tarnwork.ml import lbfgs, naive_bayes
from tarnwork.ml.gradient import descend
from tarnwork.ml.inner_products import largest_products
from tarnwork.plans import learning


def points(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.c_[np.ones(n), rng.normal(size=(n, 2)) * [1, 5]]
    y = (1 / (1 + np.exp(-(x @ [0.5, -1.0, 0.3]))) > rng.random(n)).astype(float)
    return spark.createDataFrame([(float(a), list(map(float, b))) for a, b in zip(y, x)], "label double, features array<double>").persist(), x, y


def test_logistic_minimum_has_no_slope(spark):
    df, x, y = points(spark)
    for reg in (0.0, 0.1):
        found = lbfgs.fit(df, [0.0, 0.0, 0.0], "logistic", "l2", reg)
        w = np.array(found.weights)
        assert np.abs(x.T @ (1 / (1 + np.exp(-(x @ w))) - y) / len(y) + reg * w).max() < 1e-5
        assert found.converged and all(a >= b for a, b in zip(found.history, found.history[1:])) and len(found.history) < 25
    slow = []
    descend(df, [0.0, 0.0, 0.0], "logistic", step=1.0, iterations=20, history=slow)
    assert lbfgs.fit(df, [0.0, 0.0, 0.0], "logistic").history[-1] < slow[-1]


def test_least_squares_and_hinge(spark):
    df, x, y = points(spark)
    found = lbfgs.fit(df, [0.0] * 3, "least_squares", tolerance=1e-14)
    assert np.allclose(found.weights, np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-5)
    hinge = lambda w: np.maximum(0, 1 - (2 * y - 1) * (x @ w)).mean() + 0.05 * (np.array(w) @ w) / 2
    w = lbfgs.fit(df, [0.0] * 3, "hinge", "l2", 0.05).weights
    rng = np.random.default_rng(2)
    assert all(hinge(w) <= hinge(w + d) + 2e-3 for d in rng.normal(size=(200, 3)) * 0.2)


def test_l1_leaves_what_does_not_pay_at_zero():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(60, 8))
    b = a @ [3, 0, 0, -2, 0, 0, 0, 0] + 0.1 * rng.normal(size=60)
    for l1 in (0.5, 2.0, 100.0):
        found = lbfgs.minimise(lambda w: (float(((a @ w - b) ** 2).mean()), 2 * a.T @ (a @ w - b) / 60), [0.1] * 8, l1, iterations=300)
        w, slope = np.array(found.weights), 2 * a.T @ (a @ found.weights - b) / 60
        assert np.all(np.abs(slope[w == 0]) <= l1 + 1e-6) and np.allclose(slope[w != 0], -l1 * np.sign(w[w != 0]), atol=1e-3)
        assert (w == 0).sum() >= 5


def test_a_valley_and_no_rows(spark):
    rosenbrock = lambda w: ((1 - w[0]) ** 2 + 100 * (w[1] - w[0] ** 2) ** 2, np.array([-2 * (1 - w[0]) - 400 * w[0] * (w[1] - w[0] ** 2), 200 * (w[1] - w[0] ** 2)]))
    assert np.allclose(lbfgs.minimise(lambda w: (float(rosenbrock(w)[0]), rosenbrock(w)[1]), [-1.2, 1.0], tolerance=1e-14).weights, [1, 1], atol=1e-4)
    df = spark.createDataFrame([], "label double, features array<double>")
    assert lbfgs.fit(df, [1.0, 2.0], "logistic").weights == [1.0, 2.0]
    with pytest.raises(ValueError):
        lbfgs.fit(df, [0.0], "logistic", "l3")


@pytest.mark.parametrize("user_rows,item_rows", [(2048, 4096), (7, 5)])
def test_largest_products_of_all_users(spark, user_rows, item_rows):
    rng = np.random.default_rng(4)
    u, v = rng.normal(size=(40, 6)), rng.normal(size=(90, 6)) * rng.lognormal(size=(90, 1))
    v[50:60] = v[10:20]  # equal items tie
    u[3] = 0
    frame = lambda m: spark.createDataFrame([(i * 3, list(map(float, x))) for i, x in enumerate(m)] + [(-1, None)], "id long, features array<double>").repartition(3)
    got = largest_products(frame(u), frame(v), 7, user_rows, item_rows).collect()
    want = []
    for i, x in enumerate(u):
        scores = np.round(v @ x, 9)
        want += [(i * 3, p + 1, int(j) * 3, float(scores[j])) for p, j in enumerate(np.lexsort((np.arange(90), -scores))[:7])]
    assert sorted((r.user, r.place, r.item) for r in got) == sorted(w[:3] for w in want)
    assert np.allclose([r.score for r in sorted(got)], [w[3] for w in sorted(want)], atol=2e-9)


def test_fewer_items_than_asked_for(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, -1.0])], "id long, features array<double>")
    items = spark.createDataFrame([(5, [2.0, 2.0]), (6, [2.0, 3.0])], "id long, features array<double>")
    got = sorted((r.user, r.place, r.item, r.score) for r in largest_products(users, items, 4).collect())
    assert got == [(1, 1, 5, 2.0), (1, 2, 6, 2.0), (2, 1, 5, -2.0), (2, 2, 6, -3.0)]
    assert largest_products(users, items.limit(0), 4).collect() == [] == largest_products(users.limit(0), items, 4).collect()


def test_naive_bayes_with_missing_labels_and_texts(spark):
    rows = [(1, "x", "a a b"), (2, "y", "b c"), (3, None, "a a"), (4, "x", None), (5, "y", " \n"), (6, None, "c new words c"), (7, None, None)]
    df = spark.createDataFrame(rows, "id long, label string, text string")
    classes, weights = naive_bayes.fit(df, "label", "text")
    counts = {"x": Counter("aab"), "y": Counter("bc")}
    got = {r.label: (r.prior, r.unseen) for r in classes.collect()}
    assert np.allclose([*got["x"], *got["y"]], [math.log(3 / 6), math.log(1 / 6), math.log(3 / 6), math.log(1 / 5)])
    told = {(r.label, r.word): r.weight for r in weights.collect()}
    assert set(told) == {(k, w) for k, c in counts.items() for w in c}
    assert all(abs(v - math.log((counts[k][w] + 1) / (sum(counts[k].values()) + 3))) < 1e-12 for (k, w), v in told.items())

    def best(text):
        score = lambda k: got[k][0] + sum(told.get((k, w), got[k][1]) for w in (text or "").split())
        return min(got, key=lambda k: (-round(score(k), 6), k))

    assert {r.id: r.label for r in naive_bayes.predict(df, "id", "text", (classes, weights)).collect()} == {i: best(t) for i, _, t in rows}
    assert naive_bayes.fit(df.limit(0), "label", "text")[1].collect() == []


def test_words_are_counted_without_shuffling_them(spark):
    from tarnwork.ml.text_features import term_counts

    texts = spark.createDataFrame([(1, "a b a"), (1, "a c"), (None, "a a"), (2, None), (3, "")], "id long, text string")
    got = term_counts(texts, "id", F.split("text", " "))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a", 3), (1, "b", 1), (1, "c", 1), (None, "a", 2)], key=str)
    counted = naive_bayes.words(texts.withColumn("label", F.lit("x")), "id", "label", "text")
    assert sorted(map(tuple, counted.collect()), key=str) == sorted([(1, "x", "a", 3), (1, "x", "b", 1), (1, "x", "c", 1), (None, "x", "a", 2)], key=str)
    for df in (got, counted):
        assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1


def test_items_are_sent_as_floats_and_users_in_a_bounded_number_of_blocks(spark, monkeypatch):
    from tarnwork.ml import inner_products as ip

    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 6)).astype(np.float32)
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, features array<float>").coalesce(1)
    made = {}
    blocks = ip._blocks
    monkeypatch.setattr(ip, "_blocks", lambda *a: made.setdefault(a[-1], blocks(*a)))
    monkeypatch.setattr(ip, "USERS", 10)
    monkeypatch.setattr(ip, "USER_BLOCKS", 2)
    got = {(r.user, r.place): r.item for r in ip.largest_products(frame, frame, 3, item_rows=90).collect()}
    assert made["user-blocks"].count() == 2
    assert made["item-blocks"].selectExpr("sum(length(vectors)) AS n").head()[0] == 700 * 6 * 4
    scores = np.round(x.astype(float) @ x.astype(float).T, 9)
    assert got == {(i, k + 1): int(j) for i in range(700) for k, j in enumerate(np.lexsort((np.arange(700), -scores[i]))[:3])}


def test_word_vectors_read_sentences_that_are_cut_once(spark, monkeypatch, tmp_path):
    """The model gets written sentences of two words or more: its plan cuts nothing, neither for a row nor for a condition."""
    texts = ["Ab cd, ef!\ngh\n\nij kl mn", None, "", "one", "ÉT là–ab 2 cd"] + ["ab cd ef gh ij kl mn"] * 20
    spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    read, fit = [], feature.Word2Vec.fit
    monkeypatch.setattr(feature.Word2Vec, "fit", lambda self, df: read.append(df) or fit(self, df))
    row = registered()["ml11_word2vec"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in row] == [(8, True, 5)]
    assert "split(" not in read[0]._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r.words) for r in read[0].collect()) == sorted(
        [("ab", "cd", "ef"), ("ij", "kl", "mn"), ("ét", "là", "ab", "cd")] + [tuple("ab cd ef gh ij kl mn".split())] * 20)


def test_ratings_lie_in_blocks_of_a_bounded_size(spark, monkeypatch, tmp_path):
    """Ratings are written once, and the model gets as many blocks as they need, ten at least."""
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(6) for i in range(20)] + [(0, 0, 2.0)]
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    made, fit = [], recommendation.ALS.fit
    monkeypatch.setattr(recommendation.ALS, "fit", lambda self, df: made.append((self, df)) or fit(self, df))
    for most, blocks in ((2_000_000, 10), (9, 14)):
        monkeypatch.setattr(learning, "BLOCK_RATINGS", most, raising=False)
        row = registered()["ml15_als_implicit"](spark, str(tmp_path)).collect()
        assert [r.pairs for r in row] == [120]
        als, ratings = made.pop()
        assert (als.getNumUserBlocks(), als.getNumItemBlocks()) == (blocks, blocks)
        assert "Aggregate" not in ratings._jdf.queryExecution().executedPlan().toString()
        got = {(r.user, r.item): r.rating for r in ratings.collect()}
        assert got == {(u, i): ((u * i) % 5 + 1) / 10 for u in range(6) for i in range(20)} | {(0, 0): 0.15}
