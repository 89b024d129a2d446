"""Joins of every kind the relational and the keyed surface offer.

No plan hints a broadcast by itself: Catalyst and adaptive execution
broadcast a side only under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffle both, splitting hot partitions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tarnwork.catalog import query
from tarnwork.operators.joins import (
    band_join, block_join, exists_less_than, full_outer, keep_unmatched_bag, small_side_join,
)
from tarnwork.operators.ordering import chunked_lists

c = F.col

# Suppliers that only some customers' nations have, with null keys on both sides.
_BUYERS = "SELECT c_custkey, CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer"
_SELLERS = "SELECT s_suppkey, CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE s_nationkey END AS k FROM supplier"


def _buyers(t):
    return t.customer.select("c_custkey", F.when(c("c_nationkey") % 6 != 0, c("c_nationkey")).alias("k"))


def _sellers(t):
    return t.supplier.select("s_suppkey", F.when(c("s_nationkey") % 4 != 0, c("s_nationkey")).alias("k"))


@query("join01_logical_join", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def _(t):
    return t.orders.join(t.customer, (c("o_custkey") == c("c_custkey")) & (c("c_acctbal") > 0)).select("o_orderkey", "c_name")


@query("join02_join_dsl", "SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 5")
def _(t):
    return (
        t.lineitem.join(t.part.where("p_size < 5"), c("l_partkey") == c("p_partkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "p_brand")
    )


@query(
    "join03_shuffled_hash",
    "SELECT o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate > o_orderdate",
)
def _(t):
    # The smaller side builds; adaptive execution splits a hot order key on the streamed side.
    return (
        t.lineitem.join(t.orders.hint("shuffle_hash"), c("o_orderkey") == c("l_orderkey"))
        .where("l_shipdate > o_orderdate")
        .select("o_orderkey", "l_linenumber", "l_quantity")
    )


@query("join04_broadcast_hash", "SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    nation = t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    return t.supplier.join(nation, "s_nationkey").select("s_name", "n_name")


@query(
    "join05_left_outer",
    "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000",
)
def _(t):
    return t.customer.join(
        t.orders, (c("c_custkey") == c("o_custkey")) & (c("o_totalprice") > 300000), "left"
    ).select("c_custkey", "o_orderkey")


@query(
    "join06_right_outer",
    "SELECT o_orderkey, c_custkey FROM orders RIGHT JOIN customer ON c_custkey = o_custkey AND o_orderstatus = 'F'",
)
def _(t):
    return t.orders.join(
        t.customer, (c("c_custkey") == c("o_custkey")) & (c("o_orderstatus") == "F"), "right"
    ).select("o_orderkey", "c_custkey")


@query("join07_full_outer", f"SELECT b.k AS bk, s.k AS sk, c_custkey, s_suppkey FROM ({_BUYERS}) b FULL JOIN ({_SELLERS}) s ON b.k = s.k")
def _(t):
    buyers = _buyers(t).withColumn("bk", c("k"))
    sellers = _sellers(t).withColumn("sk", c("k"))
    return full_outer(buyers, sellers, ["k"]).select("bk", "sk", "c_custkey", "s_suppkey")


@query("join08_left_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def _(t):
    big = t.orders.where("o_totalprice > 400000")
    return t.customer.join(big, c("o_custkey") == c("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("join09_left_semi_theta", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM supplier WHERE s_acctbal < c_acctbal)")
def _(t):
    return exists_less_than(t.customer, t.supplier, "c_acctbal", "s_acctbal").select("c_custkey")


@query("join10_cartesian", "SELECT p_partkey, r_name FROM part, region")
def _(t):
    # The operator is all pairs by definition; the right side is checked to be small first.
    return small_side_join(t.part, t.region, None, "cross", max_rows=1000).select("p_partkey", "r_name")


@query(
    "join11_theta_left_outer",
    "SELECT s_suppkey, r_regionkey FROM supplier LEFT JOIN region ON s_acctbal > r_regionkey * 2000 AND s_nationkey <> r_regionkey",
)
def _(t):
    on = (c("s_acctbal") > c("r_regionkey") * 2000) & (c("s_nationkey") != c("r_regionkey"))
    return small_side_join(t.supplier, t.region, on, "left", max_rows=1000).select("s_suppkey", "r_regionkey")


_NEAR = "l_extendedprice > o_totalprice * 0.9999 AND l_extendedprice < o_totalprice * 1.0001 AND l_shipdate < o_orderdate AND l_suppkey <> o_custkey"


def _near(a, b):
    price, paid = a("l_extendedprice"), b("o_totalprice")
    return (price > paid * 0.9999) & (price < paid * 1.0001) & (a("l_shipdate") < b("o_orderdate")) & (a("l_suppkey") != b("o_custkey"))


_LANE, _MOST = 0.0003, 1.7976931348623157e308  # a lane of prices is 0.03 % wide


def _near_lanes():
    """A price's lane, and the lanes of the prices near to what was paid; none where no price can be near."""
    lane = lambda x: F.floor(F.ln(F.when(x <= _MOST, x)) / _LANE)
    paid = c("o_totalprice")
    return lane(c("l_extendedprice")), lane(paid * 0.9999), lane(F.least(paid * 1.0001, F.lit(_MOST)))


def _blocks(how):
    @query(
        f"join11_blocks_{how}",
        f"SELECT l_orderkey, l_linenumber, o_orderkey FROM (SELECT * FROM lineitem) l {how.upper()} JOIN orders o ON {_NEAR}",
    )
    def _(t):
        # Both sides are large and no keys are equal: lines meet the orders in whose lanes of prices they are.
        lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_suppkey")
        orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_custkey")
        return block_join(lines, orders, _near, how, lanes=_near_lanes()).select("l_orderkey", "l_linenumber", "o_orderkey")


for _how in ("inner", "left", "right", "full"):
    _blocks(_how)


@query(
    "join11_interval_theta",
    """SELECT o_orderkey, p_partkey FROM orders JOIN
         (SELECT p_partkey, p_partkey * 250.0 AS lo, p_partkey * 250.0 + p_size AS hi FROM part) b
         ON o_totalprice >= lo AND o_totalprice < hi""",
)
def _(t):
    bands = t.part.select(
        "p_partkey", (c("p_partkey") * 250.0).alias("lo"), (c("p_partkey") * 250.0 + c("p_size")).alias("hi")
    )
    return band_join(t.orders.select("o_orderkey", "o_totalprice"), bands, "o_totalprice", "lo", "hi", 50.0).select(
        "o_orderkey", "p_partkey"
    )


@query(
    "join12_multi_key",
    """SELECT c_custkey, s_suppkey FROM customer JOIN supplier
       ON c_nationkey = s_nationkey AND c_custkey % 10 = s_suppkey % 10 AND c_acctbal < s_acctbal""",
)
def _(t):
    left = t.customer.withColumn("digit", c("c_custkey") % 10)
    right = t.supplier.withColumn("digit", c("s_suppkey") % 10)
    return left.join(
        right,
        (c("c_nationkey") == c("s_nationkey")) & (left["digit"] == right["digit"]) & (c("c_acctbal") < c("s_acctbal")),
    ).select("c_custkey", "s_suppkey")


@query(
    "join13_comma_where",
    "SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey AND r_name <> 'ASIA'",
)
def _(t):
    return t.sql(
        "SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey AND r_name <> 'ASIA'",
        "nation", "region",
    )


@query(
    "join14_self_join",
    "SELECT a.turn AS turn, a.conv_id AS conv, a.role AS role, b.role AS next_role FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1",
)
def _(t):
    a, b = t.conversations.alias("a"), t.conversations.alias("b")
    return a.join(b, (c("a.conv_id") == c("b.conv_id")) & (c("b.turn") == c("a.turn") + 1)).select(
        c("a.turn").alias("turn"), c("a.conv_id").alias("conv"), c("a.role").alias("role"), c("b.role").alias("next_role")
    )


def _order_pairs(t):
    return t.orders.select(c("o_orderkey").alias("k"), c("o_totalprice").alias("v"))


def _line_pairs(t):
    return t.lineitem.where("l_returnflag = 'R'").select(c("l_orderkey").alias("k"), c("l_partkey").alias("w"))


_PAIRS = """WITH a AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders),
                 b AS (SELECT l_orderkey AS k, l_partkey AS w FROM lineitem WHERE l_returnflag = 'R') """


@query("join15_pair_join", _PAIRS + "SELECT a.k AS k, v, w FROM a JOIN b ON a.k = b.k")
def _(t):
    return _line_pairs(t).join(_order_pairs(t), "k").select("k", "v", "w")


@query("join16_pair_left_outer", _PAIRS + "SELECT a.k AS k, v, w FROM a LEFT JOIN b ON a.k = b.k")
def _(t):
    return _order_pairs(t).join(_line_pairs(t), "k", "left").select("k", "v", "w")


@query("join17_pair_right_outer", _PAIRS + "SELECT a.k AS k, v, w FROM b RIGHT JOIN a ON a.k = b.k")
def _(t):
    return _line_pairs(t).join(_order_pairs(t), "k", "right").select("k", "v", "w")


@query(
    "join18_cogroup",
    """WITH b AS (SELECT k, (rn - 1) // 50 AS chunk, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS buyers FROM
                    (SELECT c_nationkey AS k, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer) GROUP BY 1, 2),
            s AS (SELECT k, (rn - 1) // 50 AS chunk, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey) AS sellers FROM
                    (SELECT s_nationkey AS k, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) GROUP BY 1, 2)
       SELECT k, chunk, buyers, sellers FROM b FULL JOIN s USING (k, chunk)""",
)
def _(t):
    # Lists of both inputs per key, in aligned pieces of 50 so that a hot key is many rows.
    buyers = chunked_lists(t.customer.select(c("c_nationkey").alias("k"), "c_custkey"), ["k"], c("c_custkey"), [c("c_custkey")], "b", 50)
    sellers = chunked_lists(t.supplier.select(c("s_nationkey").alias("k"), "s_suppkey"), ["k"], c("s_suppkey"), [c("s_suppkey")], "s", 50)
    join = full_outer(buyers, sellers, ["k", "chunk"], most_pairs=None)
    text = lambda col: F.when(c(col).isNotNull(), F.array_join(c(col).cast("array<string>"), ","))
    return join.select("k", "chunk", text("b").alias("buyers"), text("s").alias("sellers"))


@query("join18_cogroup_function", "SELECT n_nationkey AS k, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS buyers, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS sellers FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)")
def _(t):
    # A user function over both groups sees pre-aggregated partials of each side, never raw groups.
    b = t.customer.groupBy(c("c_nationkey").alias("k"), F.pmod("c_custkey", F.lit(4)).alias("part")).agg(F.count("*").alias("n"))
    s = t.supplier.groupBy(c("s_nationkey").alias("k"), F.pmod("s_suppkey", F.lit(4)).alias("part")).agg(F.count("*").alias("n"))

    def merge(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        k = (x if len(x) else y)["k"].iloc[0]
        return pd.DataFrame({"k": [k], "buyers": [int(x.n.sum())], "sellers": [int(y.n.sum())]})

    return b.groupBy("k").cogroup(s.groupBy("k")).applyInPandas(merge, "k int, buyers long, sellers long")


@query("join19_subtract_by_key", _PAIRS + "SELECT a.k AS k, v FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.k = b.k)")
def _(t):
    return _order_pairs(t).join(_line_pairs(t), "k", "left_anti")


_L = "SELECT c_nationkey AS a, c_mktsegment AS b FROM customer"
_R = "SELECT c_nationkey AS a, c_mktsegment AS b FROM customer WHERE c_acctbal > 9000"


def _left(t):
    return t.customer.select(c("c_nationkey").alias("a"), c("c_mktsegment").alias("b"))


def _right(t):
    return t.customer.where("c_acctbal > 9000").select(c("c_nationkey").alias("a"), c("c_mktsegment").alias("b"))


@query("set01_union_all", "SELECT CAST(s_nationkey AS BIGINT) AS k, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def _(t):
    return t.supplier.select(c("s_nationkey").alias("k"), c("s_name").alias("name")).union(t.customer.select("c_custkey", "c_name"))


@query("set01_union_all_with_text", "SELECT CAST(s_suppkey AS VARCHAR) AS v FROM supplier UNION ALL SELECT c_name FROM customer")
def _(t):
    return t.supplier.select(c("s_suppkey").cast("string").alias("v")).union(t.customer.select("c_name"))


@query("set02_union_distinct", f"{_L} UNION {_R}")
def _(t):
    return _left(t).union(_right(t)).distinct()


@query("set03_intersect", f"{_L} INTERSECT {_R}")
def _(t):
    return _left(t).intersect(_right(t))


@query(
    "set04_except_keeping_duplicates",
    f"SELECT l.a AS a, l.b AS b FROM ({_L}) l WHERE NOT EXISTS (SELECT 1 FROM ({_R}) r WHERE l.a IS NOT DISTINCT FROM r.a AND l.b IS NOT DISTINCT FROM r.b)",
)
def _(t):
    return keep_unmatched_bag(_left(t), _right(t))


@query("set04_except_distinct", f"{_L} EXCEPT {_R}")
def _(t):
    return _left(t).subtract(_right(t))


@query("set05_select_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("set06_union_many", "SELECT n_nationkey AS k FROM nation UNION ALL SELECT s_nationkey FROM supplier UNION ALL SELECT c_nationkey FROM customer")
def _(t):
    from functools import reduce

    parts = [t.nation.select(c("n_nationkey").alias("k")), t.supplier.select("s_nationkey"), t.customer.select("c_nationkey")]
    return reduce(lambda a, b: a.union(b), parts)


@query("set07_intersection_keys", "SELECT o_custkey AS k FROM orders INTERSECT SELECT l_suppkey FROM lineitem")
def _(t):
    return t.orders.select(c("o_custkey").alias("k")).intersect(t.lineitem.select("l_suppkey"))


@query("set08_subtract_keys", "SELECT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT l_suppkey FROM lineitem)")
def _(t):
    return keep_unmatched_bag(t.orders.select(c("o_custkey").alias("k")), t.lineitem.select("l_suppkey"))


@query("set09_distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return t.events.select("user_id", "event_type").distinct()


@query("set10_set_dsl", f"(SELECT a, b FROM ({_L}) UNION ALL SELECT a, b FROM ({_R})) EXCEPT (SELECT a, b FROM ({_L}) WHERE a < 12)")
def _(t):
    return _left(t).unionAll(_right(t)).subtract(_left(t).where("a < 12"))
