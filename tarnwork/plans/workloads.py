"""Whole workloads built from the operators, on the driver tables."""

from __future__ import annotations

from pyspark.ml import recommendation
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tarnwork.catalog import query
from tarnwork.graph.algorithms import pagerank
from tarnwork.graph.model import Graph
from tarnwork.ml import draws, lbfgs, metrics
from tarnwork.ml.gradient import descend
from tarnwork.operators.ordering import index_rows
from tarnwork.operators.sampling import folds
from tarnwork.session import fresh_dir, materialize, spread
from tarnwork.sources import text
from tarnwork.streaming.inputs import event_time, parquet_stream
from tarnwork.streaming.sinks import run
from tarnwork.streaming.windows import windowed_table

c = F.col


@query("wrk01_word_count", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1")
def _(t):
    words = spread(t.documents.select("text")).select(F.explode(F.split("text", r"\s+")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n"))


_LOG = r'^(\d+) (\w+) \[([^\]]*)\] "(\w+)" (\d+)$'


@query(
    "wrk02_log_statistics",
    """SELECT CASE WHEN event_type <> 'error' THEN user_id::VARCHAR END AS who, CASE WHEN event_type <> 'error' THEN event_type END AS what,
              count(*) AS n, sum(CASE WHEN event_type <> 'error' THEN floor(value)::BIGINT ELSE 0 END)::BIGINT AS bytes FROM events GROUP BY 1, 2""",
)
def _(t):
    # Log lines are made from events; unreadable ones fall under the null key.
    line = F.when(c("event_type") == "error", F.lit("garbled")).otherwise(
        F.format_string('%d %s [%s] "GET" %d', "user_id", "event_type", c("ts").cast("string"), F.floor("value"))
    )
    lines = t.events.select(line.alias("line"))
    ok = c("line").rlike(_LOG)
    part = lambda i: F.when(ok, F.regexp_extract("line", _LOG, i))
    return lines.groupBy(part(1).alias("who"), part(2).alias("what")).agg(
        F.count("*").alias("n"), F.sum(F.coalesce(part(5).cast("long"), F.lit(0))).alias("bytes")
    )


@query("wrk03_rank_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def _(t):
    return t.sql("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000", "orders")


@query("wrk04_prefix_aggregate", "SELECT substr(c_name, 1, 16) AS prefix, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def _(t):
    return t.sql(
        "SELECT substr(c_name, 1, 16) AS prefix, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY substr(c_name, 1, 16)",
        "orders", "customer",
    )


_REVENUE = """SELECT o_custkey, round(sum(l_extendedprice), 2) AS revenue, round(avg(o_totalprice), 4) AS mean_price
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey
              WHERE o_orderdate >= {d} '1996-01-01{z}' AND o_orderdate < {d} '1998-01-01{z}'
              GROUP BY o_custkey ORDER BY revenue DESC, o_custkey LIMIT 10"""


@query("wrk05_revenue_join", _REVENUE.format(d="TIMESTAMP", z=""))
def _(t):
    # The date range is pushed to the orders scan; the join shuffles only what is left.
    orders = t.orders.where("o_orderdate >= timestamp_ntz '1996-01-01 00:00:00' AND o_orderdate < timestamp_ntz '1998-01-01 00:00:00'")
    joined = orders.select("o_orderkey", "o_custkey", "o_totalprice").join(
        t.lineitem.select("l_orderkey", "l_extendedprice"), c("o_orderkey") == c("l_orderkey"))
    grouped = joined.groupBy("o_custkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"))
    return grouped.orderBy(F.desc("revenue"), "o_custkey").limit(10)


_LINKS = "(SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS target FROM pages)"


def _links(t):
    return t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("target"))


@query("wrk06_link_counts", f"SELECT target, count(*) AS n FROM {_LINKS} GROUP BY 1")
def _(t):
    # Partial counts per page first, then the total, as in the two-step original.
    partial = _links(t).groupBy("page_id", "target").agg(F.count("*").alias("n"))
    return partial.groupBy("target").agg(F.sum("n").alias("n"))


def _rank_by_joins(rounds: int) -> str:
    text_ = """WITH L AS MATERIALIZED (SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
               D AS MATERIALIZED (SELECT src, count(*) AS d FROM L GROUP BY 1), r0 AS (SELECT src AS id, 1.0::DOUBLE AS rank FROM D)"""
    for i in range(1, rounds + 1):
        text_ += f""", r{i} AS MATERIALIZED (SELECT dst AS id, 0.15 + 0.85 * sum(rank / d) AS rank FROM L JOIN r{i - 1} ON id = L.src JOIN D ON D.src = L.src GROUP BY 1)"""
    return text_ + f" SELECT id, round(rank, 7) AS rank FROM r{rounds}"


@query("wrk07_rank_by_joins", _rank_by_joins(3))
def _(t):
    # Only ids that receive something keep a rank after a round.
    links = t.orders.join(t.lineitem, c("o_orderkey") == c("l_orderkey")).select(c("o_custkey").alias("src"), c("l_suppkey").alias("dst")).distinct()
    degree = materialize(links.groupBy("src").agg(F.count("*").alias("d")), "link-degrees")
    weighted = materialize(links.join(degree, "src").select("src", "dst", (1.0 / c("d")).alias("w")), "links")
    ranks = weighted.select(c("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    for _i in range(3):
        sent = weighted.join(ranks.withColumnRenamed("id", "src"), "src")
        ranks = materialize(sent.groupBy(c("dst").alias("id")).agg((0.15 + 0.85 * F.sum(c("rank") * c("w"))).alias("rank")), "ranks")
    return ranks.select("id", F.round("rank", 7).alias("rank"))


def named_page_rank(links, rounds: int):
    """(name, rank) of every name that links (a, b) or is linked to, after some rounds of page rank from 1; a link counts once."""
    links = materialize(links.select("a", "b").distinct(), "named-links")
    names = links.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    # Names become ids by a distributed numbering.
    ids = materialize(index_rows(names, [c("name")], "id"), "names")
    edges = links.join(ids.select(c("name").alias("a"), c("id").alias("src")), "a").join(ids.select(c("name").alias("b"), c("id").alias("dst")), "b").select("src", "dst")
    ranks = pagerank(Graph(ids.select("id"), edges), rounds)
    return ids.join(ranks, "id").select("name", F.round("rank", 7).alias("rank"))


def _page_rank_sql(rounds: int) -> str:
    text_ = f"""WITH L AS MATERIALIZED (SELECT DISTINCT 'page:' || page_id::VARCHAR AS src, target AS dst FROM {_LINKS}), V AS MATERIALIZED (SELECT src AS id FROM L UNION SELECT dst FROM L),
        W AS MATERIALIZED (SELECT L.src, dst, 1.0 / d AS w FROM L JOIN (SELECT src, count(*) AS d FROM L GROUP BY 1) D ON D.src = L.src), r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM V)"""
    for i in range(1, rounds + 1):
        text_ += f", r{i} AS MATERIALIZED (SELECT V.id, 0.15 + 0.85 * coalesce(sum(rank * w), 0) AS rank FROM V LEFT JOIN (SELECT dst, rank, w FROM W JOIN r{i - 1} r ON r.id = W.src) s ON s.dst = V.id GROUP BY 1)"
    return text_ + f" SELECT id AS name, round(rank, 7)::DOUBLE AS rank FROM r{rounds}"


@query("wrk08_page_link_rank", _page_rank_sql(5))
def _(t):
    # Links come from the page markup.
    return named_page_rank(_links(t).select(F.concat(F.lit("page:"), c("page_id").cast("string")).alias("a"), c("target").alias("b")), 5)


@query("wrk09_rows_and_sql", "SELECT (SELECT count(*) FROM customer) AS all_rows, c_custkey, c_name FROM customer WHERE c_custkey < 10")
def _(t):
    path = fresh_dir(t.spark, "people")
    t.customer.createOrReplaceTempView("tw_records")
    t.spark.sql("SELECT c_custkey, c_name FROM tw_records").write.parquet(path)
    t.spark.read.parquet(path).createOrReplaceTempView("tw_saved_records")
    return t.spark.sql("SELECT (SELECT count(*) FROM tw_saved_records) AS all_rows, c_custkey, c_name FROM tw_saved_records WHERE c_custkey < 10 ORDER BY c_custkey")


@query("wrk10_key_value_join", "SELECT s_suppkey AS key, s_name AS value, n_name AS nation FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def _(t):
    path = fresh_dir(t.spark, "key-values")
    t.supplier.select(F.concat_ws("\x01", c("s_suppkey").cast("string"), "s_name")).write.text(path)
    pairs = text.read_delimited(t.spark, path, t.supplier.select(c("s_suppkey").alias("key"), c("s_name").alias("value")).schema, fields="\x01")
    home = t.supplier.join(t.nation, c("n_nationkey") == c("s_nationkey")).select(c("s_suppkey").alias("key"), c("n_name").alias("nation"))
    return pairs.join(home, "key")


@query("wrk11_sort_numbers_from_text", "SELECT n, row_number() OVER (ORDER BY n, event_id) - 1 AS place, event_id FROM (SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS n FROM events)")
def _(t):
    path = fresh_dir(t.spark, "numbers")
    t.events.select(F.concat_ws(" ", c("event_id").cast("string"), F.get_json_object("props", "$.k"))).write.text(path)
    parts = F.split("value", " ")
    numbers = t.spark.read.text(path).select(parts[0].cast("long").alias("event_id"), parts[1].cast("long").alias("n"))
    return index_rows(numbers, [c("n"), c("event_id")], "place")


@query("wrk12_stream_grep", "SELECT (epoch_us(ts) // 1000000) // 86400 * 86400 AS start, count(*) AS n FROM events WHERE contains(event_type, 'i') GROUP BY 1")
def _(t):
    kinds = ("view", "signup", "purchase", "click", "error")
    streams = [event_time(parquet_stream(t.spark, t.dir, "event*.parquet", t.events.schema)).where(c("event_type") == k) for k in kinds[:2]]
    rest = event_time(parquet_stream(t.spark, t.dir, "event*.parquet", t.events.schema)).where(~c("event_type").isin(*kinds[:2]))
    merged = streams[0].union(streams[1]).union(rest)
    return windowed_table(merged.where(c("event_type").contains("i")), "1 day", None, [], {"n": F.count("*")})


@query("wrk13_recoverable_word_count", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1")
def _(t):
    # Two runs over one checkpoint: the second counts only what arrived after the first.
    inbox, state, out = (fresh_dir(t.spark, x) for x in ("inbox", "recovery-state", "recovery-out"))
    docs = t.documents.select("doc_id", "text")

    def count_words():
        stream = parquet_stream(t.spark, inbox, "*", docs.schema)
        words = stream.select(F.explode(F.split("text", r"\s+")).alias("word")).where("word <> ''")
        side = lambda b, i: b.groupBy("word").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={i}")
        run(words, "append", side, checkpoint=state)

    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    for i, name in enumerate("ab"):
        docs.where(half == i).write.parquet(f"{inbox}/{name}")
        count_words()
    counts = t.spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


@query("wrk14_recommendation_pipeline", "SELECT true AS better_than_mean, true AS all_scored FROM lineitem LIMIT 1")
def _(t):
    path = fresh_dir(t.spark, "ratings")
    pairs = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.lit(1).alias("one"))
    drawn = draws.factor_ratings(pairs, "l_suppkey", "l_partkey", 3, 0.05)
    drawn.select(F.concat_ws("::", c("l_suppkey").cast("string"), c("l_partkey").cast("string"), c("rating").cast("string"))).write.text(path)
    parts = F.split("value", "::")
    ratings = t.spark.read.text(path).select(parts[0].cast("int").alias("user"), parts[1].cast("int").alias("item"), parts[2].cast("float").alias("rating"))
    marked = folds(ratings, ["user", "item"], 5).persist()
    train, held = marked.where("fold <> 0"), marked.where("fold = 0")
    model = recommendation.ALS(rank=6, maxIter=8, regParam=0.01, seed=4, userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop").fit(train)
    scored = model.transform(held)
    mean = train.agg(F.avg("rating")).scalar()
    error = metrics.rmse(scored).scalar()
    base = metrics.rmse(held.withColumn("prediction", mean)).scalar()
    return scored.agg((error < base).alias("better_than_mean"), (F.count_if(F.isnan("prediction")) == 0).alias("all_scored"))


def _held_out_sql(regs: tuple[float, ...], rounds: int, step: float, shrink: float, steps: int) -> str:
    """Fits on four fifths of the orders by Newton steps, or by descent for the hinge loss; what each says of the last fifth."""
    text_ = """WITH a AS MATERIALIZED (SELECT o_orderkey % 5 AS fold, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y, o_totalprice / 100000 AS x FROM orders),
        p AS MATERIALIZED (SELECT y, x FROM a WHERE fold <> 0)"""
    models = []
    for k, reg in enumerate(regs):
        text_ += f", m{k}_0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"
        for i in range(1, rounds + 1):
            text_ += f""", s{k}_{i} AS MATERIALIZED (SELECT any_value(a) AS a, any_value(b) AS b, avg(q - y) + {reg} * any_value(a) AS g0, avg((q - y) * x) + {reg} * any_value(b) AS g1,
                avg(q * (1 - q)) + {reg} AS h0, avg(q * (1 - q) * x) AS h1, avg(q * (1 - q) * x * x) + {reg} AS h2 FROM (SELECT *, 1 / (1 + exp(-(a + b * x))) AS q FROM p, m{k}_{i - 1})),
                m{k}_{i} AS (SELECT a - (h2 * g0 - h1 * g1) / (h0 * h2 - h1 * h1) AS a, b - (h0 * g1 - h1 * g0) / (h0 * h2 - h1 * h1) AS b FROM s{k}_{i})"""
        models.append((f"logistic {reg}", f"m{k}_{rounds}"))
    text_ += ", h0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"
    for i in range(1, steps + 1):
        rate = step / i**0.5
        down = lambda w, x: f"any_value({w}) * (1 - {rate!r} * {shrink}) + {rate!r} * avg(CASE WHEN (2 * y - 1) * (a + b * x) < 1 THEN (2 * y - 1){x} ELSE 0 END) AS {w}"
        text_ += f", h{i} AS MATERIALIZED (SELECT {down('a', '')}, {down('b', ' * x')} FROM p, h{i - 1})"
    models.append(("hinge", f"h{steps}"))
    return text_ + " UNION ALL ".join(
        f" SELECT '{name}' AS model, count(*) AS held, count(*) FILTER (WHERE (b + w * x > 0) = (y > 0)) AS agreed, round(any_value(b), 4) AS intercept, round(any_value(w), 4) AS slope"
        f" FROM (SELECT y, x FROM a WHERE fold = 0), (SELECT a AS b, b AS w FROM {table})" for name, table in models
    )


@query("wrk15_binary_classification_pipeline", _held_out_sql((0.0, 0.05), 8, 0.7, 0.05, 6))
def _(t):
    # Orders become libsvm lines and are read back; two losses, with and without a penalty, are fitted on four fifths of them.
    path = fresh_dir(t.spark, "points-libsvm")
    points = t.orders.select(
        (c("o_orderkey") % 5 == 0).alias("held"), (c("o_orderstatus") == "F").cast("double").alias("label"),
        array_to_vector(F.array(F.lit(1.0), c("o_totalprice") / 100000)).alias("features"),
    )
    sides = []
    for held in (False, True):
        points.where(c("held") == held).select("label", "features").write.format("libsvm").save(f"{path}/{held}")
        read = t.spark.read.format("libsvm").option("numFeatures", 2).load(f"{path}/{held}")
        sides.append(materialize(read.select("label", vector_to_array("features").alias("features")), "points"))
    train, test = sides
    fits = {f"logistic {reg}": lbfgs.fit(train, [0.0, 0.0], "logistic", "l2", reg, tolerance=1e-14).weights for reg in (0.0, 0.05)}
    fits["hinge"] = descend(train, [0.0, 0.0], "hinge", "l2", 0.05, 0.7, 6)

    def said(name, w):
        agrees = (F.lit(w[0]) + F.lit(w[1]) * c("features")[1] > 0) == (c("label") > 0)
        return test.agg(F.lit(name).alias("model"), F.count("*").alias("held"), F.count_if(agrees).alias("agreed")).select(
            "*", F.lit(round(w[0], 4)).alias("intercept"), F.lit(round(w[1], 4)).alias("slope")
        )

    first, *others = [said(name, w) for name, w in fits.items()]
    for other in others:
        first = first.unionByName(other)
    return first
