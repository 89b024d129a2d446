"""Sorts, limits, numbering, samples and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwork.catalog import query
from tarnwork.operators.combine import salted_totals
from tarnwork.operators.ordering import index_rows, rank_within, sliding
from tarnwork.operators.sampling import bucket_sample, exact_sample, exact_stratified
from tarnwork.session import materialize

c = F.col
_N = "(SELECT p_partkey, p_name, p_retailprice, nullif(p_size % 5, 0) AS n FROM part)"


def _nullable(t):
    return t.part.select("p_partkey", "p_name", "p_retailprice", F.expr("nullif(p_size % 5, 0)").alias("n"))


@query("srt01_order_by", f"SELECT p_partkey, n, row_number() OVER (ORDER BY n ASC NULLS FIRST, p_partkey DESC) - 1 AS place FROM {_N}")
def _(t):
    # The place in the global order is part of the answer, so the order itself is compared.
    return index_rows(_nullable(t), [c("n").asc(), c("p_partkey").desc()], "place").select("p_partkey", "n", "place")


@query("srt02_order_by_dsl", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("srt03_sort_by_hidden_column", "SELECT c_name FROM customer ORDER BY c_acctbal DESC, c_custkey")
def _(t):
    return t.sql("SELECT c_name FROM customer ORDER BY c_acctbal DESC, c_custkey", "customer")


@query("srt04_sort_by", "SELECT l_orderkey, l_linenumber, l_shipdate::VARCHAR AS shipped FROM lineitem")
def _(t):
    return t.lineitem.sortWithinPartitions("l_shipdate", "l_orderkey").select(
        "l_orderkey", "l_linenumber", c("l_shipdate").cast("string").alias("shipped")
    )


@query("srt05_distribute_by", "SELECT o_custkey, count(*) AS n, 1::BIGINT AS places FROM orders GROUP BY 1")
def _(t):
    placed = t.orders.repartition(8, "o_custkey").withColumn("pid", F.spark_partition_id())
    return placed.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_distinct("pid").alias("places"))


@query("srt06_cluster_by", "SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem")
def _(t):
    return t.sql("SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem CLUSTER BY l_suppkey", "lineitem")


@query("srt07_limit", "SELECT least(count(*), 100) AS n FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey").limit(100).agg(F.count("*").alias("n"))


@query("srt08_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("srt09_sort_by_function", "SELECT p_partkey, row_number() OVER (ORDER BY length(p_name), p_partkey) - 1 AS place FROM part")
def _(t):
    return index_rows(t.part.select("p_partkey", "p_name"), [F.length("p_name"), c("p_partkey")], "place").select("p_partkey", "place")


@query("srt10_sort_by_key", "SELECT s_suppkey, row_number() OVER (ORDER BY s_nationkey DESC, s_suppkey) - 1 AS place FROM supplier")
def _(t):
    return index_rows(t.supplier, [F.desc("s_nationkey"), c("s_suppkey")], "place").select("s_suppkey", "place")


@query("srt11_zip_with_index", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events")
def _(t):
    return index_rows(t.events.select("event_id", "ts"), [c("ts"), c("event_id")]).select("event_id", "idx")


@query("srt12_zip_with_unique_id", "SELECT count(*) AS n, count(*) AS ids FROM lineitem")
def _(t):
    tagged = t.lineitem.select(F.monotonically_increasing_id().alias("id"))
    return tagged.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@query("srt13_take", "SELECT least(count(*), 7) AS n FROM customer")
def _(t):
    return t.customer.limit(7).agg(F.count("*").alias("n"))


@query("srt14_top", "SELECT l_extendedprice AS v FROM lineitem ORDER BY 1 DESC LIMIT 10")
def _(t):
    return t.lineitem.select(c("l_extendedprice").alias("v")).orderBy(F.desc("v")).limit(10)


@query("srt15_take_ordered", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal), c_custkey LIMIT 12")
def _(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.abs("c_acctbal"), "c_custkey").limit(12)


def _share_holds(df, sample, fraction):
    """(total, near): the sample size is within six standard deviations of its expectation."""
    total = df.agg(F.count("*")).scalar()
    slack = 6 * F.sqrt(total * fraction)
    return sample.agg(F.count("*").alias("_n")).select(
        total.alias("total"), (F.abs(c("_n") - total * fraction) <= slack).alias("near")
    )


_SHARE = "SELECT count(*) AS total, true AS near FROM lineitem"


@query("srt16_sample_with_replacement", _SHARE)
def _(t):
    return _share_holds(t.lineitem, t.lineitem.sample(True, 0.3, 11), 0.3)


@query("srt17_sample", _SHARE)
def _(t):
    return _share_holds(t.lineitem, t.lineitem.sample(False, 0.2, 7), 0.2)


@query("srt18_take_sample", "SELECT least(count(*), 500) AS n, least(count(*), 500) AS ids FROM orders")
def _(t):
    s = exact_sample(t.orders.select("o_orderkey"), ["o_orderkey"], 500, 3)
    return s.agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("ids"))


@query("srt19_random_split", "SELECT count(*) AS total, 0::BIGINT AS shared, true AS near FROM orders")
def _(t):
    keys = t.orders.select("o_orderkey")
    a, b = keys.randomSplit([0.7, 0.3], 5)
    both = a.withColumn("side", F.lit(1)).union(b.withColumn("side", F.lit(0)))
    each = both.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.sum("side").alias("left"))
    return each.agg(
        F.sum("n").alias("total"), F.count_if(c("n") > 1).alias("shared"),
        (F.abs(F.sum("left") / F.sum("n") - 0.7) < 0.05).alias("near"),
    )


_FRACTIONS = {"F": 0.1, "O": 0.25, "P": 0.5}


@query("srt20_stratified_exact", "SELECT o_orderstatus, ceil(count(*) * CASE o_orderstatus WHEN 'F' THEN 0.1 WHEN 'O' THEN 0.25 ELSE 0.5 END)::BIGINT AS n FROM orders GROUP BY 1")
def _(t):
    s = exact_stratified(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"], _FRACTIONS)
    return s.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("srt20_stratified", "SELECT o_orderstatus, count(*) AS total, true AS near FROM orders GROUP BY 1")
def _(t):
    drawn = t.orders.sampleBy("o_orderstatus", _FRACTIONS, 9).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    total = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("total"))
    share = F.expr("CASE o_orderstatus WHEN 'F' THEN 0.1 WHEN 'O' THEN 0.25 ELSE 0.5 END")
    return total.join(drawn, "o_orderstatus", "left").select(
        "o_orderstatus", "total", (F.abs(c("n") - c("total") * share) < 6 * F.sqrt(c("total") * share)).alias("near")
    )


@query("srt21_tablesample_rows", "SELECT least(count(*), 40) AS n FROM part")
def _(t):
    return t.sql("SELECT count(*) AS n FROM (SELECT * FROM part TABLESAMPLE (40 ROWS))", "part")


@query("srt22_tablesample_percent", _SHARE)
def _(t):
    return _share_holds(t.lineitem, t.sql("SELECT * FROM lineitem TABLESAMPLE (15 PERCENT) REPEATABLE (4)", "lineitem"), 0.15)


@query("srt23_tablesample_bucket", "SELECT count(*) AS total, true AS near FROM orders")
def _(t):
    return _share_holds(t.orders, bucket_sample(t.orders, ["o_orderkey"], 2, 4), 0.25)


@query("srt24_repartition", "SELECT count(*) AS n, 6::BIGINT AS parts FROM orders")
def _(t):
    spread = t.orders.select("o_orderkey").repartition(6).withColumn("pid", F.spark_partition_id())
    return spread.agg(F.count("*").alias("n"), F.count_distinct("pid").alias("parts"))


@query("srt25_coalesce", "SELECT count(*) AS n, true AS fewer FROM orders")
def _(t):
    spread = t.orders.select("o_orderkey").repartition(8).coalesce(3).withColumn("pid", F.spark_partition_id())
    return spread.agg(F.count("*").alias("n"), (F.count_distinct("pid") <= 3).alias("fewer"))


@query("srt26_partition_by_range", "SELECT count(*) AS n, 0::BIGINT AS overlaps FROM orders")
def _(t):
    from pyspark.sql import Window

    placed = t.orders.repartitionByRange(5, "o_custkey", "o_orderkey").withColumn("pid", F.spark_partition_id())
    # Five rows, one per partition: each must start after the one before ends.
    spans = placed.groupBy("pid").agg(
        F.count("*").alias("n"), F.min(F.struct("o_custkey", "o_orderkey")).alias("lo"), F.max(F.struct("o_custkey", "o_orderkey")).alias("hi")
    ).withColumn("before", F.lag("hi").over(Window.partitionBy(F.lit(0)).orderBy("pid")))
    return spans.agg(F.sum("n").alias("n"), F.count_if(c("lo") <= c("before")).alias("overlaps"))


@query("srt27_partition_pruning", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    laid_out = materialize(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), "by-status", ["o_orderstatus"])
    return laid_out.where("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice")


@query(
    "srt28_sliding",
    """SELECT start, a + b + c AS total, concat_ws(',', a::VARCHAR, b::VARCHAR, c::VARCHAR) AS users FROM (
         SELECT row_number() OVER w - 1 AS start, user_id AS a, lead(user_id) OVER w AS b, lead(user_id, 2) OVER w AS c
         FROM events WINDOW w AS (ORDER BY ts, event_id)) WHERE c IS NOT NULL""",
)
def _(t):
    return sliding(t.events.select("ts", "event_id", "user_id"), [c("ts"), c("event_id")], c("user_id"), 3, block=1024).select(
        "start",
        F.aggregate("values", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        F.array_join(c("values").cast("array<string>"), ",").alias("users"),
    )


@query(
    "srt29_skewed_group_by",
    """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k, count(*) AS rows,
              count(DISTINCT l_orderkey) AS units, sum(l_quantity) AS qty FROM lineitem GROUP BY 1""",
)
def _(t):
    # A third of all rows share key 0.
    keyed = t.lineitem.withColumn("k", F.when(c("l_orderkey") % 3 == 0, F.lit(0)).otherwise(c("l_suppkey")))
    return salted_totals(keyed, ["k"], ["l_orderkey"], {"qty": "l_quantity"})


@query(
    "srt29_skewed_numbering",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END
         ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem""",
)
def _(t):
    keyed = t.lineitem.withColumn("k", F.when(c("l_orderkey") % 3 == 0, F.lit(0)).otherwise(c("l_suppkey")))
    order = [c("l_extendedprice"), c("l_orderkey"), c("l_linenumber"), c("l_partkey")]
    return rank_within(keyed, ["k"], order).select("l_orderkey", "l_linenumber", "l_extendedprice", "rank")
