"""Ordered operators against plain Python, with a key that holds most rows and with nulls."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnwork.operators.ordering import chunked_lists, index_rows, rank_within, running_totals, sliding
from tarnwork.operators.percentiles import exact_percentile


def skewed(n=400, seed=3):
    rng = random.Random(seed)
    keys = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, "c"])) for _ in range(n)]
    return [(k, i, rng.randint(0, 20)) for i, k in enumerate(keys)]


@pytest.mark.parametrize("parts", [1, 7])
def test_running_totals_any_partitioning(spark, parts):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(parts)
    got = {(r.k, r.i): r.t for r in running_totals(df, ["k"], [F.col("i").desc()], {"t": F.col("v")}).collect()}
    want, sums = {}, {}
    for k, i, v in sorted(rows, key=lambda r: -r[1]):
        sums[k] = sums.get(k, 0) + v
        want[(k, i)] = sums[k]
    assert got == want


def test_rank_and_index(spark):
    rows = skewed(150)
    df = spark.createDataFrame(rows, "k string, i long, v long")
    ranks = {(r.k, r.rank) for r in rank_within(df, ["k"], [F.col("v"), F.col("i")]).collect()}
    assert ranks == {(k, n + 1) for k in {r[0] for r in rows} for n in range(sum(1 for r in rows if r[0] == k))}
    idx = index_rows(df, [F.col("v").desc_nulls_last(), F.col("i")]).orderBy("idx").collect()
    assert [r.i for r in idx] == [r[1] for r in sorted(rows, key=lambda r: (-r[2], r[1]))]
    assert [r.idx for r in idx] == list(range(len(rows)))


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, i long, v long")
    assert running_totals(df, ["k"], [F.col("i")], {"t": F.col("v")}).count() == 0


def test_chunked_lists_are_whole_and_bounded(spark):
    rows = skewed(300)
    df = spark.createDataFrame(rows, "k string, i long, v long")
    got = chunked_lists(df, ["k"], F.col("i"), [F.col("i")], "xs", 25).collect()
    assert max(len(r.xs) for r in got) <= 25
    for k in {r[0] for r in rows}:
        parts = sorted((r.chunk, r.xs) for r in got if r.k == k)
        assert [x for _c, xs in parts for x in xs] == [r[1] for r in rows if r[0] == k]


@pytest.mark.parametrize("n,block", [(1, 4), (3, 4), (5, 5), (4, 1000)])
def test_sliding(spark, n, block):
    values = list(range(23))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v long")
    got = {r.start: r["values"] for r in sliding(df, [F.col("i")], F.col("v"), n, block).collect()}
    assert got == {s: values[s:s + n] for s in range(len(values) - n + 1)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40), st.floats(0, 1))
def test_exact_percentile(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = exact_percentile(df, [], "v", p).head()[0]
    s = sorted(values)
    t = (len(s) - 1) * p
    lo, hi = s[int(t // 1)], s[min(len(s) - 1, int(-(-t // 1)))]
    assert got == pytest.approx(lo + (hi - lo) * (t - t // 1))


def test_index_rows_shuffles_nothing_after_its_stage(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    indexed = index_rows(df, [F.col("v")])
    assert all(r.idx == r.v for r in indexed.collect())
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    # Only the table of offsets is exchanged: by partition, to one task, and broadcast.
    assert "hashpartitioning(_part" in plan and plan.count("Sort [") <= 2 * plan.count("Window")
    assert not any("v#" in line and "Exchange hashpartitioning" in line for line in plan.splitlines())
