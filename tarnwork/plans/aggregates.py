"""Grouped, global, keyed and approximate aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwork.catalog import query, register
from tarnwork.operators.combine import combine_by_key, tree_aggregate
from tarnwork.operators.estimates import (
    approximate_counts, approximate_mean_and_sum, histogram_edges, histogram_even,
)
from tarnwork.operators.ordering import chunked_lists

c = F.col
_NULLS = "(SELECT p_type, p_brand, p_partkey, p_retailprice, nullif(p_size % 5, 0) AS n FROM part)"


def _nulls(t):
    return t.part.select("p_type", "p_brand", "p_partkey", "p_retailprice", F.expr("nullif(p_size % 5, 0)").alias("n"))


@query("agg01_group_by", f"SELECT n, count(*) AS rows, sum(p_partkey)::BIGINT AS total FROM {_NULLS} GROUP BY n")
def _(t):
    return _nulls(t).groupBy("n").agg(F.count("*").alias("rows"), F.sum("p_partkey").alias("total"))


@query(
    "agg02_group_by_dsl",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
              round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_net, round(avg(l_quantity), 6) AS avg_qty,
              count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""",
)
def _(t):
    return (
        t.lineitem.where("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
            F.round(F.sum(c("l_extendedprice") * (1 - c("l_discount"))), 4).alias("sum_net"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.count("*").alias("n"),
        )
    )


@query("agg03_global_aggregate", "SELECT count(*) AS n, max(o_totalprice) AS top, count(*) FILTER (WHERE o_totalprice < 0) AS none_left, max(CASE WHEN o_totalprice < 0 THEN o_custkey END) AS of_none FROM orders")
def _(t):
    negative = c("o_totalprice") < 0
    return t.orders.agg(
        F.count("*").alias("n"), F.max("o_totalprice").alias("top"), F.count_if(negative).alias("none_left"),
        F.max(F.when(negative, c("o_custkey"))).alias("of_none"),
    )


@query("agg04_two_phase", "SELECT l_suppkey, count(*) AS n, min(l_shipdate)::VARCHAR AS first_ship, sum(l_linenumber)::BIGINT AS s FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.min("l_shipdate").cast("string").alias("first_ship"), F.sum("l_linenumber").alias("s")
    )


@query("agg05_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING max(o_totalprice) > 450000")
def _(t):
    return t.sql("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING max(o_totalprice) > 450000", "orders")


def _by_type(name, spark_agg, sql_agg, out="v"):
    register(
        name,
        lambda t: _nulls(t).groupBy("p_type").agg(spark_agg().alias(out)),
        f"SELECT p_type, {sql_agg} AS {out} FROM {_NULLS} GROUP BY p_type",
    )


_by_type("agg06_count_column", lambda: F.count("n"), "count(n)")
_by_type("agg06_count_rows", lambda: F.count("*"), "count(*)")
_by_type("agg07_count_distinct", lambda: F.count_distinct("n", "p_brand"), "count(DISTINCT CASE WHEN n IS NOT NULL THEN (n, p_brand) END)")
_by_type("agg08_sum", lambda: F.sum("n"), "sum(n)::BIGINT")
_by_type("agg08_sum_of_none", lambda: F.sum(F.when(c("n") > 99, c("n"))), "sum(CASE WHEN n > 99 THEN n END)::BIGINT")
_by_type("agg09_sum_distinct", lambda: F.sum_distinct("n"), "sum(DISTINCT n)::BIGINT")
_by_type("agg10_avg", lambda: F.round(F.avg("n"), 8), "round(avg(n), 8)")
_by_type("agg11_min", lambda: F.min("n"), "min(n)")
_by_type("agg12_max", lambda: F.max("n"), "max(n)")
_by_type("agg13_first_non_null", lambda: F.min_by("n", F.when(c("n").isNotNull(), c("p_partkey"))), "arg_min(n, p_partkey) FILTER (WHERE n IS NOT NULL)")


def _near(exact, estimate, rsd):
    """Within four standard errors, with one unit of slack for tiny sets."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), 4 * rsd * exact)


def _distinct_near(df, key, value, rsd):
    """Exact distinct counts and their estimates by key, each by itself: together, every distinct row would keep a sketch."""
    exact = df.groupBy(key).agg(F.count_distinct(value).alias("exact"))
    estimate = df.groupBy(c(key).alias("_key")).agg(F.approx_count_distinct(value, rsd).alias("e"))
    return exact.join(estimate, c(key).eqNullSafe(c("_key"))).select(key, "exact", _near(c("exact"), c("e"), rsd).alias("near"))


@query("agg14_approx_count_distinct", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS exact, true AS near FROM lineitem GROUP BY 1")
def _(t):
    return _distinct_near(t.lineitem, "l_returnflag", "l_orderkey", 0.05)


@query("agg15_query_count", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return t.orders.where("o_orderstatus = 'F'").agg(F.count("*").alias("n"))


@query("agg16_reduce", "SELECT max(l_extendedprice) AS top FROM lineitem")
def _(t):
    return tree_aggregate(t.lineitem, "l_extendedprice", lambda: float("-inf"), max, max, "top double")


@query("agg17_fold", "SELECT sum(o_custkey)::BIGINT AS total FROM orders")
def _(t):
    add = lambda a, b: a + b
    return tree_aggregate(t.orders, "o_custkey", lambda: 0, add, add, "total long")


@query("agg18_aggregate", "SELECT count(*) AS n, sum(user_id)::BIGINT AS total FROM events")
def _(t):
    acc = tree_aggregate(
        t.events, "user_id", lambda: [0, 0], lambda a, v: [a[0] + 1, a[1] + v],
        lambda a, b: [a[0] + b[0], a[1] + b[1]], "acc array<long>",
    )
    return acc.select(c("acc")[0].alias("n"), c("acc")[1].alias("total"))


@query("agg19_tree_reduce", "SELECT bit_xor(l_orderkey)::BIGINT AS folded FROM lineitem")
def _(t):
    xor = lambda a, b: int(a) ^ int(b)
    return tree_aggregate(t.lineitem.repartition(9, "l_orderkey"), "l_orderkey", lambda: 0, xor, xor, "folded long", fan_in=2, depth=3)


@query("agg20_tree_aggregate", "SELECT min(l_partkey) AS low, max(l_partkey) AS high, count(*) AS n FROM lineitem")
def _(t):
    acc = tree_aggregate(
        t.lineitem.repartition(9, "l_orderkey"), "l_partkey", lambda: [2**62, -(2**62), 0],
        lambda a, v: [min(a[0], v), max(a[1], v), a[2] + 1],
        lambda a, b: [min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2]], "acc array<long>", fan_in=3,
    )
    return acc.select(c("acc")[0].alias("low"), c("acc")[1].alias("high"), c("acc")[2].alias("n"))


@query("agg21_count", "SELECT count(*) AS n FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count("*").alias("n"))


# Estimates run at a confidence where missing the truth would be a bug, and say whether they cover it.
_SURE = 0.9999999


@query("agg22_count_approx", "SELECT count(*) AS exact, true AS covered FROM lineitem")
def _(t):
    unit = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    bounds = approximate_counts(t.lineitem, [], unit, 0.1, _SURE)
    exact = t.lineitem.agg(F.count("*")).scalar()
    return bounds.select(exact.alias("exact"), exact.between(c("low"), c("high")).alias("covered"))


@query("agg23_count_by_value", "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL")
def _(t):
    return t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))


def _covered_counts(df, key, unit):
    bounds = approximate_counts(df, [key], unit, 0.25, _SURE)
    exact = df.groupBy(key).agg(F.count("*").alias("exact"))
    return exact.join(bounds, key, "left").select(key, "exact", c("exact").between(c("low"), c("high")).alias("covered"))


@query("agg24_count_by_value_approx", "SELECT l_quantity, count(*) AS exact, true AS covered FROM lineitem GROUP BY 1")
def _(t):
    return _covered_counts(t.lineitem, "l_quantity", ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("agg25_count_approx_distinct_rows", "SELECT count(*) AS exact, true AS near FROM (SELECT DISTINCT user_id, event_type FROM events)")
def _(t):
    # Each by itself: beside a distinct count, the estimate would keep a sketch for every distinct row.
    rows = t.events.select("user_id", "event_type")
    exact = rows.agg(F.count_distinct("user_id", "event_type").alias("exact"))
    estimate = rows.agg(F.approx_count_distinct(F.struct("*"), 0.02).alias("e"))
    return exact.crossJoin(estimate).select("exact", _near(c("exact"), c("e"), 0.02).alias("near"))


@query(
    "agg26_extreme_rows",
    """SELECT (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1) AS dearest,
              (SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1) AS cheapest""",
)
def _(t):
    row = F.struct("o_totalprice", "o_orderkey")
    return t.orders.agg(F.max(row)["o_orderkey"].alias("dearest"), F.min(row)["o_orderkey"].alias("cheapest"))


def _list_oracle(table, key, value, order, size):
    return f"""SELECT k, (rn - 1) // {size} AS chunk, string_agg(CAST(v AS VARCHAR), ',' ORDER BY rn) AS vs FROM (
        SELECT {key} AS k, {value} AS v, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) GROUP BY 1, 2"""


def _as_text(df):
    return df.withColumn("vs", F.array_join(c("vs").cast("array<string>"), ","))


@query("agg27_group_by_function", _list_oracle("customer", "substring(c_mktsegment, 1, 1)", "c_custkey", "c_custkey", 200))
def _(t):
    keyed = t.customer.select(F.substring("c_mktsegment", 1, 1).alias("k"), "c_custkey")
    return _as_text(chunked_lists(keyed, ["k"], c("c_custkey"), [c("c_custkey")], "vs", 200))


@query("agg28_combine_by_key", "SELECT o_custkey AS k, string_agg(DISTINCT o_orderstatus, '' ORDER BY o_orderstatus) AS seen FROM orders GROUP BY 1")
def _(t):
    # The combiner is the sorted set of letters seen: opaque to SQL, bounded by three statuses.
    join = lambda a, b: "".join(sorted(set(a) | set(b)))
    return combine_by_key(t.orders, "o_custkey", "o_orderstatus", lambda v: v, join, join, "k long, seen string")


@query("agg29_aggregate_by_key", "SELECT l_suppkey AS k, count(*) AS n, max(l_linenumber)::BIGINT AS top FROM lineitem GROUP BY 1")
def _(t):
    acc = combine_by_key(
        t.lineitem, "l_suppkey", "l_linenumber", lambda v: [1, v], lambda a, v: [a[0] + 1, max(a[1], v)],
        lambda a, b: [a[0] + b[0], max(a[1], b[1])], "k long, acc array<long>",
    )
    return acc.select("k", c("acc")[0].alias("n"), c("acc")[1].alias("top"))


@query("agg30_fold_by_key", "SELECT l_partkey AS k, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY 1")
def _(t):
    add = lambda a, b: int(a) + int(b)
    return combine_by_key(t.lineitem, "l_partkey", "l_linenumber", lambda v: 0 + v, add, add, "k long, total long")


_LARGE = "CASE WHEN p_size % 7 = 0 THEN NULL ELSE 1152921504606846976 + p_size END"


@query("agg28_combine_large_and_null_keys", f"SELECT {_LARGE} AS k, count(*) AS n, max(CASE WHEN p_size % 5 > 0 THEN p_partkey + 1152921504606846976 END) AS top FROM part GROUP BY 1")
def _(t):
    keyed = t.part.select(F.expr(_LARGE).alias("k"), F.expr("CASE WHEN p_size % 5 > 0 THEN p_partkey + 1152921504606846976 END").alias("v"))
    top = lambda a, v: v if a is None else a if v is None else max(a, v)
    acc = combine_by_key(keyed, "k", "v", lambda v: [1, v], lambda a, v: [a[0] + 1, top(a[1], v)], lambda a, b: [a[0] + b[0], top(a[1], b[1])],
                         "k long, acc array<long>")
    return acc.select("k", c("acc")[0].alias("n"), c("acc")[1].alias("top"))


@query("agg17_fold_large_and_null_values", "SELECT max(CASE WHEN event_id % 3 > 0 THEN event_id + 1152921504606846976 END) AS top, count(*) FILTER (WHERE event_id % 3 = 0) AS missing FROM events")
def _(t):
    values = t.events.select(F.expr("CASE WHEN event_id % 3 > 0 THEN event_id + 1152921504606846976 END").alias("v"))
    acc = tree_aggregate(values, "v", lambda: [0, 0], lambda a, v: [a[0], a[1] + 1] if v is None else [max(a[0], v), a[1]],
                         lambda a, b: [max(a[0], b[0]), a[1] + b[1]], "acc array<long>")
    return acc.select(c("acc")[0].alias("top"), c("acc")[1].alias("missing"))


@query("agg31_reduce_by_key", "SELECT l_orderkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(c("l_orderkey").alias("k")).agg(F.sum("l_quantity").alias("v"))


@query("agg32_reduce_by_key_locally", "SELECT n_regionkey AS k, count(c_custkey) AS v FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    # The reduced map stays a table; a caller that knows it is small may collect it.
    return (
        t.nation.join(t.customer, c("c_nationkey") == c("n_nationkey"), "left")
        .groupBy(c("n_regionkey").alias("k")).agg(F.count("c_custkey").alias("v"))
    )


@query("agg33_count_by_key", "SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy(c("user_id").alias("k")).agg(F.count("*").alias("n"))


@query("agg34_count_by_key_approx", "SELECT l_returnflag, count(*) AS exact, true AS covered FROM lineitem GROUP BY 1")
def _(t):
    return _covered_counts(t.lineitem, "l_returnflag", ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("agg35_approx_distinct_by_key", "SELECT l_suppkey AS k, count(DISTINCT l_partkey) AS exact, true AS near FROM lineitem GROUP BY 1")
def _(t):
    return _distinct_near(t.lineitem.select(c("l_suppkey").alias("k"), "l_partkey"), "k", "l_partkey", 0.05)


@query("agg36_group_by_key", _list_oracle("orders", "o_orderpriority", "o_orderkey", "o_orderdate, o_orderkey", 1000))
def _(t):
    keyed = t.orders.select(c("o_orderpriority").alias("k"), "o_orderdate", "o_orderkey")
    return _as_text(chunked_lists(keyed, ["k"], c("o_orderkey"), [c("o_orderdate"), c("o_orderkey")], "vs", 1000))


def _moments(name, exprs, sqls):
    register(
        name,
        lambda t: t.orders.agg(*[e().alias(k) for k, e in exprs.items()]),
        "SELECT " + ", ".join(f"{s} AS {k}" for k, s in sqls.items()) + " FROM orders",
    )


_P = "o_totalprice"
_moments("agg37_sum", {"total": lambda: F.round(F.sum(_P), 2)}, {"total": f"round(sum({_P}), 2)"})
_moments(
    "agg38_stats",
    {"n": lambda: F.count(_P), "mean": lambda: F.round(F.avg(_P), 5), "total": lambda: F.round(F.sum(_P), 2),
     "low": lambda: F.min(_P), "high": lambda: F.max(_P), "sd": lambda: F.round(F.stddev_pop(_P), 5)},
    {"n": f"count({_P})", "mean": f"round(avg({_P}), 5)", "total": f"round(sum({_P}), 2)",
     "low": f"min({_P})", "high": f"max({_P})", "sd": f"round(stddev_pop({_P}), 5)"},
)
_moments("agg39_mean", {"mean": lambda: F.round(F.mean(_P), 5)}, {"mean": f"round(avg({_P}), 5)"})
_moments("agg40_population_moments",
         {"v": lambda: F.round(F.var_pop(_P), 1), "sd": lambda: F.round(F.stddev_pop(_P), 5)},
         {"v": f"round(var_pop({_P}), 1)", "sd": f"round(stddev_pop({_P}), 5)"})
_moments("agg41_sample_moments",
         {"v": lambda: F.round(F.var_samp(_P), 1), "sd": lambda: F.round(F.stddev_samp(_P), 5)},
         {"v": f"round(var_samp({_P}), 1)", "sd": f"round(stddev_samp({_P}), 5)"})


@query("agg42_mean_and_sum_approx", "SELECT round(avg(o_totalprice), 4) AS mean, true AS mean_covered, true AS sum_covered FROM orders")
def _(t):
    est = approximate_mean_and_sum(t.orders, c(_P), ["o_orderkey"], 0.2, _SURE)
    mean, total = t.orders.agg(F.avg(_P)).scalar(), t.orders.agg(F.sum(_P)).scalar()
    return est.select(
        F.round(mean, 4).alias("mean"), mean.between(c("mean_low"), c("mean_high")).alias("mean_covered"),
        total.between(c("total_low"), c("total_high")).alias("sum_covered"),
    )


@query(
    "agg43_histogram_even",
    """WITH b AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 12 AS w FROM orders),
            h AS (SELECT least(floor((o_totalprice - lo) / w)::INTEGER, 11) AS bucket, count(*) AS n FROM orders, b GROUP BY 1)
       SELECT g.i::INTEGER AS bucket, round(lo + g.i * w, 6) AS low, coalesce(n, 0) AS n
       FROM range(12) g(i) CROSS JOIN b LEFT JOIN h ON h.bucket = g.i""",
)
def _(t):
    return histogram_even(t.orders, _P, 12).withColumn("low", F.round("low", 6))


@query(
    "agg44_histogram_edges",
    """WITH e(bucket, low, high) AS (VALUES (0, 0.0::DOUBLE, 10.0::DOUBLE), (1, 10.0, 50.0), (2, 50.0, 51.0), (3, 51.0, 200.0), (4, 200.0, 337.16))
       SELECT bucket, low, high, (SELECT count(*) FROM events WHERE value >= low AND (value < high OR (bucket = 4 AND value = high))) AS n FROM e""",
)
def _(t):
    return histogram_edges(t.events, "value", [0.0, 10.0, 50.0, 51.0, 200.0, 337.16])
