"""Projections, predicates and per-row functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.catalog import Tables, query, register
from tarnwork.operators.ordering import index_rows
from tarnwork.operators.pipes import pipe

# A nullable column and a nullable flag derived from part, for three-valued logic.
_PART_NULLS = "p_partkey, nullif(p_size % 5, 0) AS n, p_size % 3 AS m"


def _nullable_part(t: Tables):
    return t.part.select(
        "p_partkey", F.expr("nullif(p_size % 5, 0)").alias("n"), F.expr("p_size % 3").alias("m")
    )


def _predicate(name: str, column, sql: str) -> None:
    """Show a predicate's full truth table over whole part rows: true, false and null."""
    register(
        name,
        lambda t: _nullable_part(t).select("p_partkey", column().alias("answer")),
        f"SELECT p_partkey, ({sql}) AS answer FROM (SELECT {_PART_NULLS} FROM part)",
    )


@query("prj01_project", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")
    )


@query("prj02_select_auto_names", "SELECT p_size + 1 AS c0, upper(p_brand) AS c1, p_partkey FROM part")
def _(t):
    exprs = ["p_size + 1", "upper(p_brand)", "p_partkey"]
    return t.part.selectExpr(*[e if e.isidentifier() else f"{e} AS c{i}" for i, e in enumerate(exprs)])


@query(
    "prj03_qualified_star",
    "SELECT s.*, n_name FROM supplier s JOIN nation ON s_nationkey = n_nationkey",
)
def _(t):
    s = t.supplier.alias("s")
    return s.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s.*", "n_name")


@query("prj04_alias", "SELECT c_custkey AS id, c_acctbal AS balance FROM customer")
def _(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))


@query("prj05_relation_alias", "SELECT x.n_name AS nation_name FROM nation AS x WHERE x.n_regionkey > 1")
def _(t):
    return t.nation.alias("x").where(F.col("x.n_regionkey") > 1).select(F.col("x.n_name").alias("nation_name"))


@query(
    "prj06_from_subquery",
    "SELECT x.k, x.price FROM (SELECT o_orderkey AS k, o_totalprice AS price FROM orders WHERE o_totalprice > 100000) x WHERE x.price < 200000",
)
def _(t):
    return t.sql(
        """SELECT x.k, x.price FROM (
             SELECT o_orderkey AS k, o_totalprice AS price FROM orders WHERE o_totalprice > 100000) x
           WHERE x.price < 200000""",
        "orders",
    )


@query("prj07_filter", f"SELECT p_partkey, n FROM (SELECT {_PART_NULLS} FROM part) WHERE n > 2")
def _(t):
    return _nullable_part(t).where("n > 2").select("p_partkey", "n")


@F.pandas_udf(T.BooleanType())
def _is_even(values: pd.Series) -> pd.Series:
    return values % 2 == 0


@query("prj08_where_user_predicate", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 2 = 0")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey").where(_is_even("o_custkey"))


@F.pandas_udf(T.BooleanType())
def _dear_for_its_size(row: pd.DataFrame) -> pd.Series:
    return row["p_retailprice"] > 900 + row["p_size"]


@query("prj09_where_dynamic_row", "SELECT p_partkey, p_name FROM part WHERE p_retailprice > 900 + p_size")
def _(t):
    return t.part.where(_dear_for_its_size(F.struct("*"))).select("p_partkey", "p_name")


@query("prj10_filter_rows", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_nationkey = 3")
def _(t):
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[(pdf.c_acctbal < 0) | (pdf.c_nationkey == 3)]

    df = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return df.mapInPandas(keep, df.schema)


@query("prj11_select_without_relation", "SELECT n_nationkey, (SELECT 1) AS one, (SELECT 'a' || 'b') AS ab FROM nation")
def _(t):
    # The one-row relation is attached to every nation as scalar subqueries.
    return t.sql("SELECT n_nationkey, (SELECT 1) AS one, (SELECT 'a' || 'b') AS ab FROM nation", "nation")


@query(
    "prj12_cast",
    """SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS bad,
              TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS good,
              CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(o_custkey AS VARCHAR) AS text,
              (o_custkey % 3 <> 0) AS flag, CAST(o_custkey AS DOUBLE) AS real FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderpriority").cast("int").alias("bad"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("good"),
        F.col("o_totalprice").cast("long").alias("whole"),
        F.col("o_custkey").cast("string").alias("text"),
        (F.col("o_custkey") % 3).cast("boolean").alias("flag"),
        F.col("o_custkey").cast("double").alias("real"),
    )


n, m = (lambda: F.col("n")), (lambda: F.col("m"))
_predicate("prj13_equal", lambda: n() == m(), "n = m")
_predicate("prj14_equal_null_safe", lambda: n().eqNullSafe(m()), "n IS NOT DISTINCT FROM m")
_predicate("prj15_less_than", lambda: n() < m(), "n < m")
_predicate("prj16_less_or_equal", lambda: n() <= m(), "n <= m")
_predicate("prj17_greater_than", lambda: n() > m(), "n > m")
_predicate("prj18_greater_or_equal", lambda: n() >= m(), "n >= m")
_predicate("prj19_not", lambda: ~(n() == 1), "NOT (n = 1)")
_predicate("prj20_and", lambda: (n() > 1) & (m() > 0), "n > 1 AND m > 0")
_predicate("prj21_or", lambda: (n() > 3) | (m() > 1), "n > 3 OR m > 1")
_predicate("prj22_in_list", lambda: n().isin(1, 3), "n IN (1, 3)")
_predicate("prj22_not_in_list", lambda: ~n().isin(1, 3), "n NOT IN (1, 3)")
_predicate("prj23_between", lambda: n().between(2, 3), "n BETWEEN 2 AND 3")
_predicate("prj24_is_null", lambda: n().isNull(), "n IS NULL")
_predicate("prj25_is_not_null", lambda: n().isNotNull(), "n IS NOT NULL")
_predicate("prj26_if", lambda: F.expr("if(n > 2, m, -1)"), "CASE WHEN n > 2 THEN m ELSE -1 END")
_predicate(
    "prj27_case_when",
    lambda: F.expr("concat_ws('|', CASE n WHEN 1 THEN 'one' WHEN 2 THEN 'two' END, CASE WHEN m = 0 THEN 'zero' ELSE 'more' END)"),
    "concat_ws('|', CASE n WHEN 1 THEN 'one' WHEN 2 THEN 'two' END, CASE WHEN m = 0 THEN 'zero' ELSE 'more' END)",
)
_predicate("prj28_coalesce", lambda: F.coalesce(n(), m()), "coalesce(n, m)")


def _text_predicate(name: str, column, sql: str) -> None:
    register(
        name,
        lambda t: t.part.select("p_partkey", "p_name").where(column()),
        f"SELECT p_partkey, p_name FROM part WHERE {sql}",
    )


_text_predicate("prj29_like", lambda: F.col("p_name").like("%r_d%") & ~F.col("p_name").like(r"%\_%"),
                r"p_name LIKE '%r_d%' AND NOT (p_name LIKE '%\_%' ESCAPE '\')")
_text_predicate("prj30_rlike", lambda: F.col("p_name").rlike("l+ (ring|w)"), "regexp_matches(p_name, 'l+ (ring|w)')")
_text_predicate("prj31_contains", lambda: F.col("p_name").contains("d w"), "contains(p_name, 'd w')")
_text_predicate("prj32_starts_with", lambda: F.col("p_name").startswith("red"), "starts_with(p_name, 'red')")
_text_predicate("prj33_ends_with", lambda: F.col("p_name").endswith("ring"), "ends_with(p_name, 'ring')")


@query(
    "prj34_get_item",
    """SELECT doc_id, split(text, ' ')[1] AS first_word, split(text, ' ')[3] AS third_word,
              CAST(NULL AS VARCHAR) AS beyond, n_chars AS by_key, CAST(NULL AS BIGINT) AS no_key FROM documents""",
)
def _(t):
    words = F.split("text", " ")
    counts = F.create_map(F.lit("n"), F.col("n_chars"))
    return t.documents.select(
        "doc_id", words[0].alias("first_word"), words[2].alias("third_word"),
        words[1_000_000].alias("beyond"), counts["n"].alias("by_key"), counts["none"].alias("no_key"),
    )


@query("prj35_get_field", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders")
def _(t):
    s = t.orders.select(
        "o_orderkey",
        F.struct(F.year("o_orderdate").alias("y")).alias("d"),
        F.when(F.col("o_custkey") % 7 != 0, F.struct(F.col("o_orderstatus").alias("s"))).alias("maybe"),
    )
    return s.select("o_orderkey", F.col("d").getField("y").alias("y"), F.col("maybe.s").alias("s"))


@query(
    "prj36_literals",
    """SELECT n_nationkey, 7 AS i, CAST(3000000000 AS BIGINT) AS big, CAST(2 AS BIGINT) AS l, CAST(3 AS SMALLINT) AS s,
              CAST(4 AS TINYINT) AS b, CAST(1.5 AS DOUBLE) AS d, 'it''s' AS str, true AS yes,
              CAST(NULL AS INTEGER) AS nothing FROM nation""",
)
def _(t):
    return t.sql(
        """SELECT n_nationkey, 7 AS i, 3000000000 AS big, 2L AS l, 3S AS s, 4Y AS b, 1.5D AS d,
                  'it\\'s' AS str, true AS yes, CAST(NULL AS INT) AS nothing FROM nation""",
        "nation",
    )


@query("prj37_map_rows", "SELECT event_id, event_type || ':' || CAST(user_id AS VARCHAR) AS tag, value * 2 AS doubled FROM events")
def _(t):
    return t.events.select(
        "event_id",
        F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("tag"),
        (F.col("value") * 2).alias("doubled"),
    )


@query("prj38_flat_map_rows", "SELECT conv_id, turn, unnest(string_split_regex(text, '\\s+')) AS word FROM conversations")
def _(t):
    return t.conversations.select("conv_id", "turn", F.explode(F.split("text", r"\s+")).alias("word"))


@query("prj39_filter_map", "SELECT event_id, CAST(sqrt(value - 100) AS DOUBLE) AS root FROM events WHERE value > 100")
def _(t):
    value = F.col("value")
    return t.events.select(
        "event_id", F.when(value > 100, F.sqrt(value - 100)).alias("root")
    ).where(F.col("root").isNotNull())


@query("prj40_map_partitions", "SELECT o_orderkey, CAST(len(o_orderpriority) AS BIGINT) AS width FROM orders")
def _(t):
    def widths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"o_orderkey": pdf.o_orderkey, "width": pdf.o_orderpriority.str.len()})

    return t.orders.select("o_orderkey", "o_orderpriority").mapInPandas(widths, "o_orderkey long, width long")


@query("prj41_map_partitions_with_index", "SELECT o_orderkey, true AS in_range FROM orders")
def _(t):
    parts = 8

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        for pdf in batches:
            yield pd.DataFrame({"o_orderkey": pdf.o_orderkey, "in_range": [0 <= pid < parts] * len(pdf)})

    keyed = t.orders.select("o_orderkey").repartition(parts, "o_orderkey")
    return keyed.mapInPandas(tag, "o_orderkey long, in_range boolean")


@query("prj42_key_by", "SELECT CAST(l_quantity AS BIGINT) % 10 AS k, l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").withColumn(
        "k", F.col("l_quantity").cast("long") % 10
    )


@query("prj43_map_values", "SELECT l_suppkey AS k, l_quantity + 0.5 AS v FROM lineitem")
def _(t):
    pairs = t.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("v"))
    return pairs.withColumn("v", F.col("v") + 0.5)


@query("prj44_flat_map_values", "SELECT doc_id AS k, unnest(string_split(text, chr(10))) AS v FROM documents")
def _(t):
    return t.documents.select(F.col("doc_id").alias("k"), F.explode(F.split("text", "\n")).alias("v"))


@query("prj45_keys", "SELECT l_suppkey AS k FROM lineitem")
def _(t):
    return t.lineitem.select(F.col("l_suppkey").alias("k"))


@query("prj46_values", "SELECT l_quantity AS v FROM lineitem")
def _(t):
    return t.lineitem.select(F.col("l_quantity").alias("v"))


@query("prj47_lookup", "SELECT l_quantity AS v FROM lineitem WHERE l_suppkey = 7")
def _(t):
    # Pushed to the scan: row groups whose key range misses 7 are not read.
    return t.lineitem.where("l_suppkey = 7").select(F.col("l_quantity").alias("v"))


@query("prj48_collect_as_map", "SELECT c_nationkey AS k, max(c_custkey) AS v FROM customer GROUP BY c_nationkey")
def _(t):
    # The map stays distributed, one row per key; the largest value wins.
    return t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.max("c_custkey").alias("v"))


@query("prj49_pipe", "SELECT upper(p_name) AS line FROM part")
def _(t):
    return pipe(t.part, "p_name", ["tr", "a-z", "A-Z"])


@query("prj49_pipe_whole_partition", "SELECT count(*)::VARCHAR || ' ' || sum(l_linenumber)::BIGINT AS line FROM lineitem")
def _(t):
    # The command keeps state over all rows of its partition; what each says at its end is added up.
    said = pipe(t.lineitem, "l_linenumber", ["awk", "{ n += 1; s += $1 } END { print n + 0, s + 0 }"])
    parts = F.split("line", " ")
    total = said.agg(F.sum(parts[0].cast("long")).alias("n"), F.sum(parts[1].cast("long")).alias("s"))
    return total.select(F.concat_ws(" ", "n", "s").alias("line"))


@query("prj49_pipe_with_context", "SELECT 'begin' AS line UNION ALL SELECT 'AIR ' || r_name FROM region UNION ALL SELECT 'AIR ' || r_name || '!' FROM region")
def _(t):
    said = pipe(t.region.coalesce(1), "r_name", ["sh", "-c", 'read first; echo "$first"; while read x; do echo "$KIND $x"; done'], env={"KIND": "AIR"},
                print_context=lambda out: out("begin"), print_row=lambda row, out: (out(row), out(f"{row}!")))
    return said


@query("prj50_script_transform", "SELECT CAST(c_custkey AS VARCHAR) AS k, c_mktsegment AS seg FROM customer WHERE c_nationkey < 10")
def _(t):
    return t.sql(
        "SELECT TRANSFORM(c_custkey, c_mktsegment) USING 'cat' AS (k STRING, seg STRING) FROM customer WHERE c_nationkey < 10",
        "customer",
    )


@query("prj51_glom", "SELECT sum(l_linenumber)::BIGINT AS total, count(*) AS n FROM lineitem")
def _(t):
    # One array per partition and 10,000 consecutive rows, so a large partition is several arrays.
    rows = t.lineitem.select("l_linenumber").withColumn("_id", F.monotonically_increasing_id())
    arrays = rows.groupBy(F.expr("_id div 10000").alias("piece")).agg(F.collect_list("l_linenumber").alias("rows"))
    return arrays.agg(
        F.sum(F.aggregate("rows", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total"),
        F.sum(F.size("rows")).alias("n"),
    )


@query(
    "prj52_zip",
    """WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS i FROM customer),
            b AS (SELECT o_custkey, row_number() OVER (ORDER BY spent, o_custkey) AS i
                  FROM (SELECT c_custkey AS o_custkey, round(sum(coalesce(o_totalprice, 0)), 2) AS spent
                        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1))
       SELECT a.c_custkey AS by_balance, b.o_custkey AS by_spend FROM a JOIN b USING (i)""",
)
def _(t):
    left = index_rows(t.customer.select("c_custkey", "c_acctbal"), [F.col("c_acctbal"), F.col("c_custkey")])
    spent = (
        t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
        .groupBy("c_custkey")
        .agg(F.round(F.sum(F.coalesce("o_totalprice", F.lit(0.0))), 2).alias("spent"))
    )
    right = index_rows(spent, [F.col("spent"), F.col("c_custkey")])
    return left.alias("a").join(right.alias("b"), "idx").select(
        F.col("a.c_custkey").alias("by_balance"), F.col("b.c_custkey").alias("by_spend")
    )


@query(
    "prj53_zip_partitions",
    """SELECT i // 1000 AS piece, round(sum(a), 2) AS left_sum, sum(b)::BIGINT AS right_sum FROM (
         SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, o_totalprice AS a, 0 AS b FROM orders
         UNION ALL SELECT row_number() OVER (ORDER BY event_id) - 1, 0, user_id FROM events) GROUP BY 1""",
)
def _(t):
    # Aligned pieces of 1,000 consecutive rows of both inputs, each pair seen by one function call.
    def pair(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        piece = (a if len(a) else b)["piece"].iloc[0]
        return pd.DataFrame(
            {"piece": [piece], "left_sum": [round(float(a.o_totalprice.sum()), 2)], "right_sum": [int(b.user_id.sum())]}
        )

    cut = lambda df: df.withColumn("piece", F.expr("idx div 1000"))
    left = cut(index_rows(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_orderkey")]))
    right = cut(index_rows(t.events.select("event_id", "user_id"), [F.col("event_id")]))
    return left.groupBy("piece").cogroup(right.groupBy("piece")).applyInPandas(
        pair, "piece long, left_sum double, right_sum long"
    )


@query("prj54_foreach_partition", "SELECT count(*) AS n, sum(o_custkey)::BIGINT AS total FROM orders")
def _(t):
    seen, total = t.spark.sparkContext.accumulator(0), t.spark.sparkContext.accumulator(0)

    def visit(rows):
        for r in rows:
            seen.add(1)
            total.add(r.o_custkey)

    t.orders.select("o_custkey").foreachPartition(visit)
    return t.spark.createDataFrame([(seen.value, total.value)], "n long, total long")


@query("prj55_accumulator", "SELECT count(*) AS n, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS errors FROM events")
def _(t):
    counters = Observation("counters")
    t.events.observe(
        counters, F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")
    ).write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame([(counters.get["n"], counters.get["errors"])], "n long, errors long")


@query("prj56_column_type_stats", "SELECT count(*) AS n, 'bigint' AS key_types, 'double' AS price_types, 'timestamp_ntz' AS date_types FROM orders")
def _(t):
    types = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(F.typeof(c))))
    return t.orders.agg(
        F.count("*").alias("n"), types("o_orderkey").alias("key_types"),
        types("o_totalprice").alias("price_types"), types("o_orderdate").alias("date_types"),
    )


@query("prj57_broadcast_lookup", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    names = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(names, "c_nationkey", "left").select("c_custkey", "n_name")


@query("prj58_partition_setup", "SELECT p_partkey, p_retailprice * 1.1 AS taxed FROM part")
def _(t):
    def taxed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rate = 1.1  # built once per partition, used by every batch
        for pdf in batches:
            yield pd.DataFrame({"p_partkey": pdf.p_partkey, "taxed": pdf.p_retailprice * rate})

    return t.part.select("p_partkey", "p_retailprice").mapInPandas(taxed, "p_partkey long, taxed double")
