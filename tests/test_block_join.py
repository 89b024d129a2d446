"""Joins on any condition by blocks, against Spark's own join of small tables."""

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.joins import block_join


def sides(spark):
    left = spark.createDataFrame([(i, i % 17 if i % 5 else None, "x" * (i % 3)) for i in range(230)] + [(3, 3, "")] * 3, "a long, v long, s string")
    right = spark.createDataFrame([(i, i % 23 if i % 4 else None) for i in range(90)] + [(None, None), (None, None)], "b long, w long")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("rows", [7, 50, 1000])
def test_against_a_plain_join(spark, how, rows):
    left, right = sides(spark)
    got = block_join(left, right, lambda a, b: (a("v") > b("w") * 3) & (a("a") != b("b")), how, rows)
    want = left.join(right, (F.col("v") > F.col("w") * 3) & (F.col("a") != F.col("b")), how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_empty_sides_and_conditions_that_never_hold(spark, how):
    left, right = sides(spark)
    for x, y, on in ((left.limit(0), right, "a > b"), (left, right.limit(0), "a > b"), (left, right, "a < b AND a > b")):
        got = block_join(x, y, lambda a, b, on=on: (a("a") > b("b")) if on == "a > b" else (a("a") < b("b")) & (a("a") > b("b")), how, 60)
        assert sorted(map(str, got.collect())) == sorted(map(str, x.join(y, F.expr(on), how).collect()))


def test_no_side_is_broadcast_and_cells_are_partitions(spark):
    left, right = sides(spark)
    joined = block_join(left, right, lambda a, b: a("v") > b("w"), rows=30)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    with pytest.raises(ValueError):
        block_join(left, left, lambda a, b: a("a") > b("a"))
    with pytest.raises(ValueError):
        block_join(left, right, lambda a, b: a("a") > b("b"), "semi")


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_lanes_leave_out_no_pair(spark, how):
    prices = [None, 0.0, -5.0, 1.0, 9.99, 10.0, 10.0, 10.01, 99.9, 100.0, 1e300, float("inf"), float("nan"), 1.79e308]
    left = spark.createDataFrame([(i, p) for i, p in enumerate(prices * 2)], "a long, v double")
    right = spark.createDataFrame([(i, p) for i, p in enumerate([*prices, 55.0, 10.0])], "b long, w double")
    on = lambda a, b: (a("v") > b("w") * 0.99) & (a("v") < b("w") * 1.01) & (a("a") % 3 != b("b") % 3)
    most, w = 1.7976931348623157e308, F.col("w")
    lane = lambda x: F.floor(F.ln(F.when(x <= most, x)) / 0.03)
    got = block_join(left, right, on, how, lanes=(lane(F.col("v")), lane(w * 0.99), lane(F.least(w * 1.01, F.lit(most)))))
    want = left.join(right, on(F.col, F.col), how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_near_prices_meet_by_lanes_not_all_by_all(spark, tmp_path):
    from tarnwork.catalog import registered

    ids = spark.range(500)
    ids.selectExpr("id AS l_orderkey", "1 AS l_linenumber", "pow(1.0002D, id) AS l_extendedprice", "timestamp'2024-01-01' AS l_shipdate", "-1L AS l_suppkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    ids.selectExpr("id AS o_orderkey", "pow(1.0002D, id) AS o_totalprice", "timestamp'2024-01-02' AS o_orderdate", "id AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    for how in ("inner", "full"):
        got = registered()[f"join11_blocks_{how}"](spark, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == [(i, 1, i) for i in range(500)]
        assert "_lane" in got._jdf.queryExecution().analyzed().toString()
