"""Trees against a plain search over all splits; exact samples against whole sorts."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.ml import trees
from tarnwork.operators import sampling


def frame(spark, x, y):
    return spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], "label double, features array<double>")


def plain(x, y, categories, depth, number=1, least_rows=1):
    """(node, rows, prediction, gain) by trying every threshold and every subset."""
    out = [(number, len(y), y.mean(), 0.0)]
    if not depth:
        return out
    best = (1e-12, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if f in categories:
            ways = [set(s) for r in range(1, len(values)) for s in itertools.combinations(values, r)]
        else:
            ways = [set(values[: i + 1]) for i in range(len(values) - 1)]
        for way in ways:
            left = np.isin(x[:, f], list(way))
            if min(left.sum(), (~left).sum()) < least_rows:
                continue
            if f in categories and y[left].mean() > y[~left].mean():
                continue  # the other side of the same split
            gain = round(y.var() - sum(len(s) * s.var() for s in (y[left], y[~left])) / len(y), 12)
            if gain > best[0] + 1e-9:
                best = (gain, left)
    if best[1] is None:
        return out
    out[0] = (number, len(y), y.mean(), best[0])
    left = best[1]
    return out + plain(x[left], y[left], categories, depth - 1, 2 * number, least_rows) + plain(x[~left], y[~left], categories, depth - 1, 2 * number + 1, least_rows)


@pytest.mark.parametrize("least_rows", [1, 20])
def test_every_node_of_a_tree(spark, least_rows):
    rng = np.random.default_rng(6)
    x = np.c_[rng.integers(0, 20, 300), rng.integers(0, 5, 300), rng.integers(0, 7, 300)]
    y = np.where(x[:, 1] % 2 == 1, 3.0, 0.0) + np.where(x[:, 0] > 11, 1.5, 0) * (x[:, 2] < 3) + rng.normal(size=300) * 0.3
    df = frame(spark, x, y)
    tree = trees.grow(df, 3, categories=[1], depth=3, least_rows=least_rows)
    want = plain(x, y, {1}, 3, least_rows=least_rows)
    assert sorted((n.number, n.rows) for n in tree.values()) == sorted(w[:2] for w in want)
    for number, _, mean, gain in want:
        assert abs(tree[number].prediction - mean) < 1e-9 and abs(tree[number].gain - gain) < 1e-6
    assert tree[1].feature == 1 and tree[1].left == (0, 2, 4)
    leaves = {n: m for n, _, m, g in want if not g}
    got = [r[0] for r in df.select(trees.predict(tree)).collect()]
    assert set(np.round(got, 9)) == set(np.round(list(leaves.values()), 9))
    assert ((np.array(got) - y) ** 2).mean() < 0.2


def test_sketched_thresholds_nulls_and_no_rows(spark):
    rng = np.random.default_rng(7)
    x = rng.random((2000, 1))
    y = (x[:, 0] > 0.37).astype(float)
    df = frame(spark, x, y).union(spark.createDataFrame([(None, [0.5]), (1.0, [None]), (float("nan"), [0.1]), (1.0, [0.1, 0.2]), (1.0, None)], "label double, features array<double>"))
    tree = trees.grow(df, 1, depth=2, bins=50)
    assert tree[1].rows == 2000 and abs(tree[1].threshold - 0.37) < 0.03
    assert trees.grow(df.limit(0), 1) == {}
    same = trees.grow(frame(spark, np.zeros((5, 2)), np.arange(5)), 2)
    assert list(same) == [1] and same[1].prediction == 2.0


def test_exact_strata_sort_only_the_border(spark):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 3 == 0, "b").otherwise("a").alias("k"))
    df = df.union(spark.createDataFrame([(-1, None), (-2, "other"), (-3, "one")], "id long, k string"))
    fractions = {"a": 0.1, "b": 0.5, "rare": 0.02, "one": 1.0, "absent": 0.3}
    got, sorted_ = sampling.stratified_with_sizes(df, "k", ["id"], fractions, 4)
    rows = df.where("k is not null").withColumn("h", F.xxhash64(F.lit(4), "id")).collect()
    want = []
    for k, f in fractions.items():
        own = sorted((r.h, r.id) for r in rows if r.k == k)
        want += [i for _, i in own[: -int(-len(own) * f // 1)]]
    assert sorted(r.id for r in got.collect()) == sorted(want)
    assert sum(sorted_.values()) < 6000 and sorted_["one"] == 0


def test_a_border_outside_the_wait_list_is_found_by_sorting_all(spark, monkeypatch):
    monkeypatch.setattr(sampling, "thresholds", lambda take, size: (0.0, 0.0001))
    df = spark.range(5000).withColumn("k", F.col("id") % 2)
    got = sampling.exact_stratified(df, "k", ["id"], {0: 0.1, 1: 0.0}, 2).collect()
    want = sorted((r.h, r.id) for r in df.withColumn("h", F.xxhash64(F.lit(2), "id")).where("k = 0").collect())[:250]
    assert sorted(r.id for r in got) == sorted(i for _, i in want)
    monkeypatch.setattr(sampling, "thresholds", lambda take, size: (1.0, 1.0))
    assert sampling.exact_sample(spark.range(300), ["id"], 40).count() == 40


def test_exact_samples_of_any_size(spark):
    df = spark.range(3000)
    for n in (0, 1, 700, 3000, 9000):
        got = [r.id for r in sampling.exact_sample(df, ["id"], n, 3).collect()]
        assert len(got) == len(set(got)) == min(n, 3000)
    draws = [{r.id for r in sampling.exact_sample(df, ["id"], 300, s).collect()} for s in range(12)]
    mean = np.mean([np.mean(list(d)) for d in draws])
    assert abs(mean - 1500) < 60  # six standard errors
