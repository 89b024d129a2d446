"""Statistics and models against numpy and plain Python."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tarnwork.ml import draws, matrix, metrics, ranks
from tarnwork.ml.gradient import descend
from tarnwork.ml.regression import fit_penalised


@pytest.fixture(scope="module")
def data():
    return np.random.default_rng(5).normal(size=(60, 5)) @ np.diag([5, 3, 2, 1, 0.5])


@pytest.fixture(scope="module")
def rows(spark, data):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "id long, features array<double>").repartition(6)


def table(df, n=5):
    m = np.zeros((n, n))
    for r in df.collect():
        m[r.i, r.j] = r.v
    return m


def test_products(rows, data):
    assert np.allclose(table(matrix.gramian(rows)), data.T @ data)
    assert np.allclose(table(matrix.covariance(rows)), np.cov(data.T))
    assert np.allclose(table(matrix.correlation(rows)), np.corrcoef(data.T))


@pytest.mark.parametrize("limit", [4096, 2])
def test_svd_local_and_distributed(rows, data, monkeypatch, limit):
    monkeypatch.setattr(matrix, "LOCAL_COLUMNS", limit)
    u, sigma, v = matrix.svd(rows, 3)
    assert sigma == pytest.approx(np.linalg.svd(data)[1][:3], rel=1e-4)
    back = {r.id: r.features for r in matrix.multiply(u, np.diag(sigma) @ v.T).collect()}
    best = np.linalg.svd(data, full_matrices=False)
    approx = best[0][:, :3] @ np.diag(best[1][:3]) @ best[2][:3]
    assert np.allclose(np.array([back[i] for i in range(60)]), approx, atol=1e-2)


def test_rank_deficient_svd_drops_small_values(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(1, 9)], "id long, features array<double>")
    _u, sigma, _v = matrix.svd(df, 2, r_cond=1e-6)
    assert len(sigma) == 1


def test_principal_components(rows, data):
    values, vectors = matrix.principal_components(rows, 2)
    want = np.sort(np.linalg.eigvalsh(np.cov(data.T)))[::-1][:2]
    assert values == pytest.approx(want) and np.allclose(vectors.T @ vectors, np.eye(2))


def test_areas_match_pair_counting(spark):
    rng = np.random.default_rng(2)
    pts = [(float(s), int(y)) for s, y in zip(rng.integers(0, 8, 70), rng.integers(0, 2, 70))]
    curve = metrics.confusion_by_threshold(spark.createDataFrame(pts, "score double, label int"))
    got = metrics.areas(curve).head()
    pos, neg = [s for s, y in pts if y], [s for s, y in pts if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got.area_roc == pytest.approx(want)


def test_multiclass(spark):
    pts = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (2, 2)]
    m = {r.cls: r for r in metrics.per_class(spark.createDataFrame(pts, "label int, prediction int")).collect()}
    assert m[0].precision == 0.5 and m[0].recall == 0.5 and m[0].fpr == 0.25
    assert m[1].precision == pytest.approx(2 / 3) and m[1].recall == 1.0
    w = metrics.weighted(metrics.per_class(spark.createDataFrame(pts, "label int, prediction int"))).head()
    assert w.accuracy == pytest.approx(4 / 6)


def test_label_validation(spark):
    good = spark.createDataFrame([(0.0,), (1.0,)], "label double")
    assert metrics.require_binary_labels(good) is good
    with pytest.raises(ValueError):
        metrics.require_binary_labels(good.union(spark.createDataFrame([(2.0,)], "label double")))


@pytest.mark.parametrize("loss,penalty", [("least_squares", "none"), ("logistic", "l2"), ("hinge", "l1")])
def test_descent_matches_numpy(spark, loss, penalty):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(30, 2)), rng.integers(0, 2, 30).astype(float)
    df = spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], "label double, features array<double>")
    w = np.zeros(2)
    for t in range(1, 5):
        m = x @ w
        if loss == "least_squares":
            s = 2 * (m - y)
        elif loss == "logistic":
            s = 1 / (1 + np.exp(-m)) - y
        else:
            sign = 2 * y - 1
            s = np.where(sign * m < 1, -sign, 0.0)
        rate = 0.5 / np.sqrt(t)
        g = (s[:, None] * x).sum(0) / 30
        if penalty == "l2":
            w = w * (1 - rate * 0.1)
        w = w - rate * g
        if penalty == "l1":
            w = np.sign(w) * np.maximum(0, np.abs(w) - 0.1 * rate)
    history = []
    got = descend(df, [0.0, 0.0], loss, penalty, 0.1, 0.5, 4, history=history)
    assert got == pytest.approx(list(w)) and len(history) == 4


def test_penalties_and_spearman(spark):
    pts = [(float(i), 3.0 * i + (i % 4)) for i in range(40)]
    df = spark.createDataFrame(pts, "x double, label double")
    vec = df.select("label", array_to_vector(F.array("x")).alias("features"))
    x, y = np.array(pts).T
    cov, var = np.cov(x, y, bias=True)[0, 1], x.var()
    assert fit_penalised(vec, "l2", 50.0).coefficients[0] == pytest.approx(cov / (var + 25), rel=1e-4)
    assert fit_penalised(vec, "l1", 50.0).coefficients[0] == pytest.approx((cov - 25) / var, rel=1e-4)
    assert ranks.spearman(df.withColumn("y", F.pow("x", F.lit(3.0))), "x", "y").head()[0] == pytest.approx(1.0)


def test_draws_do_not_depend_on_partitioning(spark):
    df = spark.range(50).withColumnRenamed("id", "u")
    pick = lambda d: sorted(map(tuple, d.select("u", draws.normal("u", 1).alias("g"), draws.poisson("u", 2, 3.0).alias("p")).collect()))
    assert pick(df) == pick(df.repartition(7))


def test_wide_svd_equals_the_exact_one_and_fails_when_cut_short(spark, monkeypatch):
    data = np.random.default_rng(5).normal(size=(300, 40))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "row long, features array<double>").repartition(4)
    want = np.linalg.svd(data)[1][:3]
    _u, exact, _v = matrix.svd(df, 3)
    monkeypatch.setattr(matrix, "LOCAL_COLUMNS", 10)
    _u, wide, v = matrix.svd(df, 3)
    assert np.abs(wide - want).max() < 1e-8 and np.abs(exact - want).max() < 1e-8
    assert np.abs(v.T @ v - np.eye(3)).max() < 1e-8
    with pytest.raises(RuntimeError):
        matrix._top_vectors(df, 3, rounds=2)
    with pytest.raises(ValueError):
        matrix.principal_components(df, 2)


def test_partial_products_are_bounded_by_cores(spark):
    data = np.random.default_rng(6).normal(size=(200, 5))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "row long, features array<double>").repartition(37)
    assert matrix._partial_products(df).count() <= 6 * spark.sparkContext.defaultParallelism
    got = {(r.i, r.j): r.v for r in matrix.gramian(df).collect()}
    want = data.T @ data
    assert all(abs(got[i, j] - want[i, j]) < 1e-9 for i in range(5) for j in range(5))
