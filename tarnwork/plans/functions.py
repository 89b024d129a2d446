"""Native and registered SQL functions, each over a whole table.

A case is a key column plus one or more (Spark expression, twin) pairs, shown
as a0, a1, ...  Expressions stay built-in, inside generated code.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.catalog import query, register
from tarnwork.functions import legacy
from tarnwork.operators.ordering import chunked_lists
from tarnwork.operators.percentiles import exact_percentile
from tarnwork.session import fresh_dir

c = F.col
_KEYS = {
    "part": "p_partkey", "customer": "c_custkey", "orders": "o_orderkey", "supplier": "s_suppkey",
    "events": "event_id", "pages": "page_id", "documents": "doc_id", "nation": "n_nationkey",
    "benchmark": "item_id",
}


def fn(name: str, table: str, *pairs) -> None:
    key = _KEYS[table]

    def build(t):
        cols = [(p[0]() if callable(p[0]) else F.expr(p[0])).alias(f"a{i}") for i, p in enumerate(pairs)]
        return getattr(t, table).select(key, *cols)

    twin = ", ".join(f"{p[1]} AS a{i}" for i, p in enumerate(pairs))
    register(name, build, f"SELECT {key}, {twin} FROM {table}")


def same(*exprs: str):
    """Expressions that read the same in both dialects."""
    return [(e, e) for e in exprs]


def r(expr: str, places: int = 10):
    """A real-valued expression compared to fixed places."""
    return (f"round({expr}, {places})", f"round({expr}, {places})")


def agg(name: str, table: str, key: str, spark: str | Column, sql: str) -> None:
    register(
        name,
        lambda t: getattr(t, table).groupBy(key).agg((spark() if callable(spark) else F.expr(spark)).alias("answer")),
        f"SELECT {key}, {sql} AS answer FROM {table} GROUP BY {key}",
    )


# ---- native expressions -------------------------------------------------
fn("fn01_unary_minus", "customer", *same("-c_acctbal", "-c_nationkey"))
fn("fn02_add", "part", *same("p_size + 3", "p_retailprice + p_size"),
   ("2147483600 + p_size", "((2147483600::BIGINT + p_size + 2147483648) % 4294967296 - 2147483648)::INTEGER"))
fn("fn03_subtract", "part", *same("p_size - 30", "p_retailprice - p_size"))
fn("fn04_multiply", "part", *same("p_size * p_size", "p_retailprice * p_size"))
fn("fn05_divide", "part", ("p_size / (p_size % 4)", "p_size / nullif(p_size % 4, 0)"), ("p_retailprice / 7", "p_retailprice / 7"))
fn("fn06_integral_div", "part", ("p_partkey div 7", "p_partkey // 7"), ("-p_size div 4", "((-p_size) // 4)::BIGINT"))
fn("fn07_remainder", "part", *same("p_partkey % 7", "-p_size % 7"))
fn("fn08_upper", "documents", *same("upper(lang)", "upper(source)"))
fn("fn09_lower", "part", *same("lower(p_brand)", "lower(p_type)"))
fn("fn10_substring", "part", *same("substring(p_name, 2, 4)", "substring(p_name, -3, 2)", "substring(p_name, 3)"),
   ("substring(p_name, 0, 2)", "substring(p_name, 1, 2)"))


@query("fn11_rand", "SELECT count(*) AS n, true AS in_range, true AS centred FROM orders")
def _(t):
    u = t.orders.select(F.rand(3).alias("u"))
    return u.agg(F.count("*").alias("n"), F.bool_and((c("u") >= 0) & (c("u") < 1)).alias("in_range"),
                 (F.abs(F.avg("u") - 0.5) < 6 * 0.2887 / F.sqrt(F.count("*"))).alias("centred"))


@query("fn12_explode", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("fn12_explode_map", "SELECT p_partkey, k, v FROM (SELECT p_partkey, 'brand' AS k, p_brand AS v FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part)")
def _(t):
    return t.part.select("p_partkey", F.explode(F.create_map(F.lit("brand"), c("p_brand"), F.lit("type"), c("p_type"))).alias("k", "v"))


@query("fn13_lateral_view_outer", "SELECT p_partkey, w AS word FROM part LEFT JOIN (SELECT p_partkey AS k, unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_size > 25) x ON k = p_partkey")
def _(t):
    return t.sql(
        """SELECT p_partkey, word FROM part
           LATERAL VIEW OUTER explode(CASE WHEN p_size > 25 THEN split(p_name, ' ') END) w AS word""",
        "part",
    )


@query("fn14_generate", "SELECT unnest(string_split(p_name, ' ')) AS word, p_partkey, p_size FROM part")
def _(t):
    return t.part.select("p_partkey", "p_size", F.explode(F.split("p_name", " ")).alias("word"))


# ---- registered functions: logic, bits and arithmetic --------------------
fn("hf001_bang", "part", ("!(p_size > 20)", "NOT (p_size > 20)"))
fn("hf002_modulo", "part", *same("p_partkey % 9", "(-p_partkey) % 9"))
fn("hf003_bit_and", "part", *same("p_size & 12"))
fn("hf004_bit_xor", "part", ("p_size ^ 21", "xor(p_size, 21)"))
fn("hf005_bit_not", "part", *same("~p_size"))
fn("hf006_bit_or", "part", *same("p_size | 9"))
fn("hf007_abs", "customer", *same("abs(c_acctbal)", "abs(c_nationkey - 12)"))
fn("hf008_acos", "part", r("acos(p_size / 100.0)"))
fn("hf009_array", "part", ("array_join(array(p_name, p_brand), '/')", "array_to_string([p_name, p_brand], '/')"))
fn("hf010_array_contains", "part", ("array_contains(split(p_name, ' '), 'red')", "list_contains(string_split(p_name, ' '), 'red')"))
fn("hf011_ascii", "part", *same("ascii(p_name)"))
fn("hf012_asin", "part", r("asin(p_size / 100.0)"))
fn("hf013_assert_true", "part", ("assert_true(p_size > 0) IS NULL", "p_size > 0"))
fn("hf014_atan", "part", r("atan(p_size)"))
agg("hf015_avg", "part", "p_type", "round(avg(p_retailprice), 6)", "round(avg(p_retailprice), 6)")
fn("hf016_base64", "part", ("base64(encode(p_name, 'UTF-8'))", "base64(encode(p_name))"))
fn("hf017_between", "part", *same("p_size BETWEEN 10 AND 20", "p_size NOT BETWEEN 10 AND 20"))
fn("hf018_bin", "part", *same("bin(p_partkey)"))
fn("hf019_case", "part", *same("CASE p_size % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END"))
fn("hf020_ceil", "customer", ("ceil(c_acctbal)", "ceil(c_acctbal)::BIGINT"))
fn("hf021_ceiling", "customer", ("ceiling(c_acctbal / 10)", "ceiling(c_acctbal / 10)::BIGINT"))
fn("hf022_coalesce", "part", *same("coalesce(nullif(p_size % 4, 0), nullif(p_size % 3, 0), -1)"))


@query(
    "hf023_collect_set",
    """SELECT c_mktsegment, (rn - 1) // 10 AS chunk, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) AS answer FROM (
         SELECT c_mktsegment, n, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n) AS rn
         FROM (SELECT DISTINCT c_mktsegment, c_nationkey AS n FROM customer)) GROUP BY 1, 2""",
)
def _(t):
    # Distinct first, then bounded pieces of the set.
    pairs = t.customer.select("c_mktsegment", "c_nationkey").distinct()
    sets = chunked_lists(pairs, ["c_mktsegment"], c("c_nationkey"), [c("c_nationkey")], "s", 10)
    return sets.select("c_mktsegment", "chunk", F.array_join(c("s").cast("array<string>"), ",").alias("answer"))


@query(
    "hf024_compute_stats",
    """SELECT 'c_custkey' AS column_name, count(*) AS n, 0::BIGINT AS nulls, min(c_custkey)::VARCHAR AS low, max(c_custkey)::VARCHAR AS high,
              round(avg(length(c_custkey::VARCHAR)), 6) AS mean_length, true AS ndv_near FROM customer
       UNION ALL SELECT 'c_mktsegment', count(*), 0, min(c_mktsegment), max(c_mktsegment), round(avg(length(c_mktsegment)), 6), true FROM customer""",
)
def _(t):
    stats = legacy.compute_stats(t.customer, ["c_custkey", "c_mktsegment"])
    exact = F.when(c("column_name") == "c_custkey", c("n")).otherwise(F.lit(5))
    return stats.select("column_name", "n", "nulls", "low", "high", F.round("mean_length", 6).alias("mean_length"),
                        (F.abs(c("ndv") - exact) <= 0.25 * exact).alias("ndv_near"))


fn("hf025_concat", "part", ("concat(p_name, '-', p_brand)", "p_name || '-' || p_brand"),
   ("concat(p_name, nullif(p_type, 'ECONOMY'))", "p_name || nullif(p_type, 'ECONOMY')"))
fn("hf026_concat_ws", "part", *same("concat_ws('|', p_name, nullif(p_type, 'ECONOMY'), p_brand)"))

_GRAMS = """WITH s AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
                 w AS (SELECT regexp_extract_all(lower(line), '[\\p{L}\\p{N}]+') AS w FROM s),
                 g AS (SELECT unnest(list_transform(range(1, greatest(len(w) - %d, 0) + 1), lambda i: w[i:i + %d])) AS g FROM w) """


@query("hf027_context_ngrams", _GRAMS % (2, 2) + "SELECT g[2] AS filler, count(*) AS freq FROM g WHERE g[1] = 'the' AND g[3] = 'of' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def _(t):
    return legacy.context_ngrams(t.documents.select("text"), legacy.line_sentences("text"), ["the", None, "of"], 15)


fn("hf028_conv", "part", ("conv(p_partkey, 10, 16)", "upper(to_base(p_partkey, 16))"), ("conv(p_size, 10, 2)", "to_base(p_size, 2)"))
agg("hf029_corr", "lineitem", "l_returnflag", "round(corr(l_quantity, l_extendedprice), 8)", "round(corr(l_quantity, l_extendedprice), 8)")
fn("hf030_cos", "part", r("cos(p_size)"))
agg("hf031_count", "part", "p_type", "count(nullif(p_size % 5, 0))", "count(nullif(p_size % 5, 0))")
agg("hf032_covar_pop", "lineitem", "l_returnflag", "round(covar_pop(l_quantity, l_discount), 8)", "round(covar_pop(l_quantity, l_discount), 8)")
agg("hf033_covar_samp", "lineitem", "l_returnflag", "round(covar_samp(l_quantity, l_discount), 8)", "round(covar_samp(l_quantity, l_discount), 8)")


@query("hf034_create_union", "SELECT p_partkey, (p_size % 2)::INTEGER AS tag, CASE WHEN p_size % 2 = 0 THEN p_size END AS number, CASE WHEN p_size % 2 = 1 THEN p_name END AS word FROM part")
def _(t):
    u = legacy.tagged_union(c("p_size") % 2, number=c("p_size"), word=c("p_name"))
    return t.part.select("p_partkey", u.alias("u")).select("p_partkey", "u.*")


fn("hf035_date_add", "orders", (lambda: legacy.date_add_text("o_orderdate", 40), "strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m-%d')"))
fn("hf036_date_sub", "orders", (lambda: legacy.date_sub_text("o_orderdate", 40), "strftime(o_orderdate - INTERVAL 40 DAY, '%Y-%m-%d')"))
fn("hf037_datediff", "orders", ("datediff(o_orderdate, DATE '1996-02-29')", "datediff('day', DATE '1996-02-29', o_orderdate)::INTEGER"))
fn("hf038_day", "orders", ("day(o_orderdate)", "day(o_orderdate)::INTEGER"))
fn("hf039_dayofmonth", "orders", ("dayofmonth(o_orderdate)", "dayofmonth(o_orderdate)::INTEGER"))
fn("hf040_decode", "benchmark", ("decode(encode(text, 'UTF-8'), 'UTF-8')", "decode(encode(text))"))
fn("hf041_degrees", "part", r("degrees(p_size)"))
fn("hf042_div", "part", ("p_partkey div 13", "p_partkey // 13"))
fn("hf043_e", "part", ("round(e() * p_size, 10)", "round(exp(1) * p_size, 10)"))
fn("hf044_elt", "part", ("elt(p_size % 3 + 1, p_name, p_brand, p_type)", "[p_name, p_brand, p_type][p_size % 3 + 1]"))
fn("hf045_encode", "benchmark", ("hex(encode(text, 'UTF-8'))", "hex(encode(text))"))

# Bitmaps hold one bit per customer number (from 1), one bounded bitmap per bucket of numbers.
_BITS = "bitmap_construct_agg(bitmap_bit_position(o_custkey + 1))"


def _status_bitmaps(t, keys):
    return t.orders.groupBy(*keys, F.expr("bitmap_bucket_number(o_custkey + 1)").alias("bucket")).agg(F.expr(_BITS).alias("bits"))


@query("hf046_bitmap", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS members FROM orders GROUP BY 1")
def _(t):
    return _status_bitmaps(t, ["o_orderstatus"]).groupBy("o_orderstatus").agg(F.sum(F.bitmap_count("bits")).alias("members"))


@query("hf047_bitmap_and", "SELECT count(*) AS members FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 3)")
def _(t):
    shared = _status_bitmaps(t, ["o_orderstatus"]).groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    return shared.where("n = 3").agg(F.sum(F.bitmap_count("bits")).alias("members"))


@query("hf048_bitmap_empty", "SELECT DISTINCT o_orderstatus, false AS empty FROM orders")
def _(t):
    return _status_bitmaps(t, ["o_orderstatus"]).groupBy("o_orderstatus").agg((F.sum(F.bitmap_count("bits")) == 0).alias("empty"))


@query("hf049_bitmap_or", "SELECT count(DISTINCT o_custkey) AS members FROM orders WHERE o_orderstatus <> 'F'")
def _(t):
    either = _status_bitmaps(t, ["o_orderstatus"]).where("o_orderstatus <> 'F'").groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return either.agg(F.sum(F.bitmap_count("bits")).alias("members"))


fn("hf050_exp", "part", ("round(exp(p_size / 10), 6)", "round(exp(p_size / 10), 6)"))


@query("hf051_explode", "SELECT event_id, unnest([event_type, user_id::VARCHAR]) AS item FROM events")
def _(t):
    return t.events.select("event_id", F.explode(F.array("event_type", c("user_id").cast("string"))).alias("item"))


fn("hf052_field", "part", (lambda: legacy.field(c("p_type"), F.lit("PROMO"), F.lit("ECONOMY"), F.lit("SMALL")), "coalesce(list_position(['PROMO', 'ECONOMY', 'SMALL'], p_type), 0)::INTEGER"))
fn("hf053_find_in_set", "part", ("find_in_set(p_type, 'PROMO,ECONOMY,SMALL')", "coalesce(list_position(['PROMO', 'ECONOMY', 'SMALL'], p_type), 0)::INTEGER"))
fn("hf054_floor", "customer", ("floor(c_acctbal / 3)", "floor(c_acctbal / 3)::BIGINT"))
fn("hf055_format_number", "orders", ("format_number(o_totalprice, 2)", "format('{:,.2f}', o_totalprice)"))
fn("hf056_from_unixtime", "events", ("from_unixtime(event_id * 86399)", "strftime(make_timestamp(event_id * 86399 * 1000000), '%Y-%m-%d %H:%M:%S')"))
_TS = "date_format({}, 'yyyy-MM-dd HH:mm:ss')"
fn("hf057_from_utc_timestamp", "events", (_TS.format("from_utc_timestamp(CAST(ts AS TIMESTAMP), 'Asia/Tokyo')"), "strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S')"))
fn("hf058_get_json_object", "events", ("get_json_object(props, '$.k')", "json_extract_string(props, '$.k')"), ("get_json_object(props, '$.none')", "json_extract_string(props, '$.none')"))
_WRAP = "((({}) + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648"
_TEXT_HASH = f"list_reduce(list_transform(string_split(p_name, ''), lambda x: ascii(x)::BIGINT), lambda a, b: {_WRAP.format('a * 31 + b')})"
fn("hf059_hash", "part", (lambda: legacy.text_hash(c("p_name")), f"{_TEXT_HASH}::INTEGER"),
   (lambda: legacy.combined_hash(c("p_size"), legacy.text_hash(c("p_name"))), f"({_WRAP.format('p_size::BIGINT * 31 + ' + _TEXT_HASH)})::INTEGER"),
   (lambda: legacy.long_hash(c("p_partkey") * 4294967296 + 5), "xor(p_partkey, 5)::INTEGER"))
fn("hf060_hex", "part", ("hex(p_partkey)", "upper(to_hex(p_partkey))"), ("hex(p_name)", "hex(encode(p_name))"))


@query("hf061_histogram_numeric", "SELECT p_type, count(*) AS n, true AS ordered FROM part GROUP BY 1")
def _(t):
    h = t.part.groupBy("p_type").agg(F.histogram_numeric("p_retailprice", F.lit(8)).alias("h"))
    total = F.aggregate("h", F.lit(0.0), lambda a, b: a + b["y"]).cast("long")
    xs = F.transform("h", lambda b: b["x"])
    return h.select("p_type", total.alias("n"), (xs == F.array_sort(xs)).alias("ordered"))


fn("hf062_hour", "events", ("hour(ts)", "hour(ts)::INTEGER"))
fn("hf063_if", "part", ("if(p_size > 25, p_name, p_brand)", "CASE WHEN p_size > 25 THEN p_name ELSE p_brand END"))
fn("hf064_in", "part", *same("p_type IN ('PROMO', 'SMALL')"))


@query("hf065_in_file", "SELECT p_partkey FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_partkey % 97 = 0)")
def _(t):
    # The file's lines become a table and membership a semi join.
    path = fresh_dir(t.spark, "brand-list")
    t.part.where("p_partkey % 97 = 0").select("p_brand").distinct().write.text(path)
    lines = t.spark.read.text(path).withColumnRenamed("value", "p_brand")
    return t.part.join(lines, "p_brand", "left_semi").select("p_partkey")


fn("hf066_index", "part", ("split(p_name, ' ')[1]", "string_split(p_name, ' ')[2]"), ("map('b', p_brand)['b']", "p_brand"))


@query("hf067_inline", "SELECT p_partkey, 1 AS pos, p_name AS v FROM part UNION ALL SELECT p_partkey, 2, p_brand FROM part")
def _(t):
    return t.part.selectExpr("p_partkey", "inline(array(struct(1 AS pos, p_name AS v), struct(2 AS pos, p_brand AS v)))")


fn("hf068_instr", "part", ("instr(p_name, 'd')", "instr(p_name, 'd')::INTEGER"))
fn("hf069_is_not_null", "part", ("isnotnull(nullif(p_size % 5, 0))", "nullif(p_size % 5, 0) IS NOT NULL"))
fn("hf070_is_null", "part", ("isnull(nullif(p_size % 5, 0))", "nullif(p_size % 5, 0) IS NULL"))
fn("hf071_java_method", "part", ("java_method('java.lang.Long', 'toHexString', p_partkey)", "lower(to_hex(p_partkey))"))


@query("hf072_json_tuple", "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS none FROM events")
def _(t):
    return t.events.select("event_id", F.json_tuple("props", "k", "none").alias("k", "none"))


fn("hf073_lcase", "part", *same("lcase(p_brand)"))
fn("hf074_length", "documents", ("length(text)", "length(text)::INTEGER"))
fn("hf075_like", "part", *same("p_name LIKE '%ed%'"))
fn("hf076_ln", "part", r("ln(p_size)"))
fn("hf077_locate", "part", ("locate('e', p_name, 3)", "(CASE WHEN instr(substring(p_name, 3), 'e') = 0 THEN 0 ELSE instr(substring(p_name, 3), 'e') + 2 END)::INTEGER"))
fn("hf078_log", "part", ("round(log(p_size), 10)", "round(ln(p_size), 10)"), ("round(log(3, p_size), 10)", "round(ln(p_size) / ln(3), 10)"))
fn("hf079_log10", "part", r("log10(p_size)"))
fn("hf080_log2", "part", r("log2(p_size)"))
fn("hf081_lower", "documents", *same("lower(lang)"))
fn("hf082_lpad", "part", *same("lpad(p_brand, 10, '*-')", "lpad(p_name, 5, '.')"))
fn("hf083_ltrim", "part", ("ltrim(concat('  ', p_name, ' '))", "ltrim('  ' || p_name || ' ')"))
fn("hf084_map", "part", ("map('n', p_name, 'b', p_brand)['b']", "p_brand"))
fn("hf085_map_keys", "part", ("array_join(map_keys(map('n', p_name, p_brand, p_type)), ',')", "'n,' || p_brand"))
fn("hf086_map_values", "part", ("array_join(map_values(map('n', p_name, p_brand, p_type)), ',')", "p_name || ',' || p_type"))
agg("hf087_max", "part", "p_type", "max(p_name)", "max(p_name)")
agg("hf088_min", "part", "p_type", "min(p_name)", "min(p_name)")
fn("hf089_minute", "events", ("minute(ts)", "minute(ts)::INTEGER"))
fn("hf090_month", "orders", ("month(o_orderdate)", "month(o_orderdate)::INTEGER"))
fn("hf091_named_struct", "part", ("named_struct('a', p_name, 'b', p_size).b", "p_size"))
fn("hf092_negative", "customer", ("negative(c_acctbal)", "-c_acctbal"))


@query("hf093_ngrams", _GRAMS % (1, 1) + "SELECT array_to_string(g, ' ') AS gram, count(*) AS freq FROM g GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _(t):
    return legacy.ngrams(t.documents.select("text"), legacy.line_sentences("text"), 2, 20)


fn("hf094_not", "part", *same("NOT (p_size < 9)"))
fn("hf095_nvl", "part", ("nvl(nullif(p_size % 5, 0), -7)", "coalesce(nullif(p_size % 5, 0), -7)"))
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"
fn("hf096_parse_url", "pages", ("parse_url(url, 'HOST')", _HOST), ("parse_url(url, 'PROTOCOL')", "regexp_extract(url, '^([a-z]+):', 1)"))


@query("hf097_parse_url_tuple", f"SELECT page_id, {_HOST} AS host, nullif(regexp_extract(url, '[?]([^#]+)', 1), '') AS query, nullif(regexp_extract(url, '#(.+)$', 1), '') AS ref FROM pages")
def _(t):
    part = lambda p: F.parse_url("url", F.lit(p))
    return t.pages.select("page_id", part("HOST").alias("host"), part("QUERY").alias("query"), part("REF").alias("ref"))


@query("hf098_percentile", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 6) AS answer FROM lineitem GROUP BY 1")
def _(t):
    p = exact_percentile(t.lineitem, ["l_returnflag"], "l_extendedprice", 0.9)
    return p.select("l_returnflag", F.round("percentile", 6).alias("answer"))


@query("hf098_percentile_global", "SELECT round(quantile_cont(o_totalprice, 0.25), 6) AS answer FROM orders")
def _(t):
    return exact_percentile(t.orders, [], "o_totalprice", 0.25).select(F.round("percentile", 6).alias("answer"))


@query("hf099_percentile_approx", "SELECT l_linestatus, true AS near FROM lineitem GROUP BY 1")
def _(t):
    est = t.lineitem.groupBy("l_linestatus").agg(F.percentile_approx("l_extendedprice", 0.5, 1000).alias("p"))
    below = t.lineitem.join(est, "l_linestatus").groupBy("l_linestatus").agg(F.avg((c("l_extendedprice") <= c("p")).cast("double")).alias("share"))
    return below.select("l_linestatus", (F.abs(c("share") - 0.5) < 0.005).alias("near"))


fn("hf100_pi", "part", r("pi() * p_size"))
fn("hf101_pmod", "part", ("pmod(-p_size, 7)", "((-p_size % 7) + 7) % 7"), ("pmod(p_size, 7)", "p_size % 7"))
fn("hf102_positive", "part", ("positive(p_size)", "p_size"))
fn("hf103_pow", "part", ("pow(p_size, 2)", "pow(p_size, 2)"))
fn("hf104_power", "part", *same("power(p_size, 3)"))
fn("hf105_printf", "part", ("printf('%05d-%s', p_size, p_brand)", "printf('%05d-%s', p_size, p_brand)"))
fn("hf106_radians", "part", r("radians(p_size)"))


@query("hf107_rand", "SELECT p_partkey, true AS in_range FROM part")
def _(t):
    u = F.rand(21)
    return t.part.select("p_partkey", u.alias("u")).select("p_partkey", ((c("u") >= 0) & (c("u") < 1)).alias("in_range"))


fn("hf108_reflect", "part", ("reflect('java.lang.Math', 'max', p_size, 20)", "greatest(p_size, 20)::VARCHAR"))


@F.pandas_udf(T.StringType())
def _call_title(values: pd.Series) -> pd.Series:
    return values.str.title()


fn("hf109_reflect2", "part", (lambda: _call_title("p_name"), "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"))
fn("hf110_regexp", "part", ("p_name REGEXP '^[a-m].*t$'", "regexp_matches(p_name, '^[a-m].*t$')"))
fn("hf111_regexp_extract", "part", *same("regexp_extract(p_name, '([a-z]+) ([a-z]+)', 2)"))
fn("hf112_regexp_replace", "part", ("regexp_replace(p_name, '[aeiou]+', '_')", "regexp_replace(p_name, '[aeiou]+', '_', 'g')"))
fn("hf113_repeat", "part", *same("repeat(p_brand, 3)"))
fn("hf114_reverse", "part", *same("reverse(p_name)"))
fn("hf115_rlike", "part", ("p_name RLIKE 'e.g?'", "regexp_matches(p_name, 'e.g?')"))
fn("hf116_round", "customer", *same("round(c_acctbal, 1)"), ("round(c_acctbal)", "round(c_acctbal)"))
fn("hf117_rpad", "part", *same("rpad(p_brand, 12, 'xy')", "rpad(p_name, 4, '.')"))
fn("hf118_rtrim", "part", ("rtrim(concat(p_name, '   '))", "rtrim(p_name || '   ')"))
fn("hf119_second", "events", ("second(ts)", "second(ts)::INTEGER"))
fn("hf120_sentences", "part", ("array_join(flatten(sentences(concat(p_name, '. ', p_name))), '+')", "replace(p_name || ' ' || p_name, ' ', '+')"))
fn("hf121_sign", "customer", ("sign(c_acctbal)", "sign(c_acctbal)::DOUBLE"))
fn("hf122_sin", "part", r("sin(p_size)"))
fn("hf123_size", "part", ("size(split(p_name, ' '))", "len(string_split(p_name, ' '))::INTEGER"),
   ("size(CASE WHEN p_size > 25 THEN split(p_name, ' ') END)", "(CASE WHEN p_size > 25 THEN len(string_split(p_name, ' ')) ELSE -1 END)::INTEGER"))
fn("hf124_sort_array", "part", ("array_join(sort_array(split(p_name, ' ')), ' ')", "array_to_string(list_sort(string_split(p_name, ' ')), ' ')"))
fn("hf125_space", "part", ("concat('[', space(p_size % 4), ']')", "'[' || repeat(' ', p_size % 4) || ']'"))
fn("hf126_split", "documents", ("size(split(text, '[.] '))", "len(string_split_regex(text, '[.] '))::INTEGER"))
fn("hf127_sqrt", "part", *same("sqrt(p_retailprice)"))


@query("hf128_stack", "SELECT p_partkey, p_name AS v FROM part UNION ALL SELECT p_partkey, p_brand FROM part UNION ALL SELECT p_partkey, p_type FROM part")
def _(t):
    return t.part.selectExpr("p_partkey", "stack(3, p_name, p_brand, p_type) AS v")


agg("hf129_std", "part", "p_type", lambda: F.round(legacy.std("p_retailprice"), 7), "round(stddev_pop(p_retailprice), 7)")
agg("hf130_stddev", "part", "p_type", lambda: F.round(legacy.stddev("p_size"), 7), "round(stddev_pop(p_size), 7)")
agg("hf131_stddev_pop", "part", "p_type", "round(stddev_pop(p_size), 7)", "round(stddev_pop(p_size), 7)")
agg("hf132_stddev_samp", "part", "p_type", "round(stddev_samp(p_size), 7)", "round(stddev_samp(p_size), 7)")
fn("hf133_str_to_map", "part", ("str_to_map(concat('n:', p_name, ',b:', p_brand))['b']", "p_brand"))
fn("hf134_struct", "part", ("struct(p_name, p_size).p_size", "p_size"))
fn("hf135_substr", "part", *same("substr(p_name, 3, 2)", "substr(p_name, -2)"))
fn("hf136_substring", "benchmark", *same("substring(text, 5, 11)", "substring(text, -4, 3)"))
agg("hf137_sum", "part", "p_type", "sum(p_size)", "sum(p_size)::BIGINT")
fn("hf138_tan", "part", ("round(tan(p_size), 8)", "round(tan(p_size), 8)"))
fn("hf139_to_date", "events", ("CAST(to_date(ts) AS STRING)", "strftime(ts, '%Y-%m-%d')"))
fn("hf140_to_unix_timestamp", "orders", ("to_unix_timestamp(CAST(o_orderdate AS TIMESTAMP))", "epoch(o_orderdate)::BIGINT"))
fn("hf141_to_utc_timestamp", "events", (_TS.format("to_utc_timestamp(CAST(ts AS TIMESTAMP), 'Asia/Tokyo')"), "strftime(ts - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S')"))
fn("hf142_translate", "part", *same("translate(p_name, 'aeg', 'AE')"))
fn("hf143_trim", "part", ("trim(concat('  ', p_name, '  '))", "trim('  ' || p_name || '  ')"))
fn("hf144_ucase", "part", *same("ucase(p_name)"))
fn("hf145_unbase64", "benchmark", ("decode(unbase64(base64(encode(text, 'UTF-8'))), 'UTF-8')", "decode(from_base64(base64(encode(text))))"))
fn("hf146_unhex", "part", ("decode(unhex(hex(p_name)), 'UTF-8')", "decode(unhex(hex(encode(p_name))))"))
fn("hf147_unix_timestamp", "events", ("unix_timestamp(CAST(ts AS TIMESTAMP))", "floor(epoch(ts))::BIGINT"))
fn("hf148_upper", "part", *same("upper(p_name)"))
agg("hf149_var_pop", "part", "p_type", "round(var_pop(p_size), 7)", "round(var_pop(p_size), 7)")
agg("hf150_var_samp", "part", "p_type", "round(var_samp(p_size), 7)", "round(var_samp(p_size), 7)")
agg("hf151_variance", "part", "p_type", lambda: F.round(legacy.variance("p_size"), 7), "round(var_pop(p_size), 7)")
fn("hf152_weekofyear", "orders", ("weekofyear(o_orderdate)", "weekofyear(o_orderdate)::INTEGER"))
fn("hf153_when", "part", *same("CASE WHEN p_size > 30 THEN 'big' WHEN p_size > 10 THEN 'mid' END"))
_XML = "concat('<p><b>', p_brand, '</b><s>', p_size, '</s><w>', p_name, '</w></p>')"
fn("hf154_xpath", "part", (f"array_join(xpath({_XML}, '/p/*/text()'), '|')", "p_brand || '|' || p_size::VARCHAR || '|' || p_name"))
fn("hf155_xpath_boolean", "part", (f"xpath_boolean({_XML}, '/p/s > 25')", "p_size > 25"))
fn("hf156_xpath_double", "part", (f"xpath_double({_XML}, '/p/s * 2')", "p_size * 2.0::DOUBLE"))
fn("hf157_xpath_float", "part", (f"xpath_float({_XML}, '/p/s')", "p_size::FLOAT"))
fn("hf158_xpath_int", "part", (f"xpath_int({_XML}, '/p/s')", "p_size"))
fn("hf159_xpath_long", "part", (f"xpath_long({_XML}, '/p/s')", "p_size::BIGINT"))
fn("hf160_xpath_number", "part", (f"xpath_number({_XML}, 'sum(/p/s)')", "p_size::DOUBLE"))
fn("hf161_xpath_short", "part", (f"xpath_short({_XML}, '/p/s')", "p_size::SMALLINT"))
fn("hf162_xpath_string", "part", (f"xpath_string({_XML}, '/p/w')", "p_name"))
fn("hf163_year", "orders", ("year(o_orderdate)", "year(o_orderdate)::INTEGER"))
