"""Streaming queries over events, re-aimed from batch time to event time.

Each runs the stream to the end of the available input and returns the sink
table, so its twin is the same question asked of the whole events table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tarnwork.catalog import query
from tarnwork.session import fresh_dir, materialize
from tarnwork.sources.text import labelled_lines, parse_labelled
from tarnwork.streaming import sketches
from tarnwork.streaming.inputs import event_time, parquet_stream, queued
from tarnwork.streaming.keyed import EveryBatch, State, keyed_table
from tarnwork.streaming.outer import END, apart, is_ending, outer_join_table
from tarnwork.streaming.panes import least, rows, sliding_table, total
from tarnwork.streaming.sinks import append_table, batch_table, run, upsert_table
from tarnwork.streaming.state import running_maximum, update_state_by_key
from tarnwork.streaming.windows import grouped_lists, window_start, windowed_table, with_empty_windows

c = F.col
HOUR, DAY = 3600, 86400
_SEC = "(epoch_us(ts) // 1000000)"


def _tumble(seconds: int) -> str:
    return f"{_SEC} // {seconds} * {seconds}"


def _slides(length: int, slide: int, where: str = "true") -> str:
    """FROM clause giving every event once per window it lies in, with the window start."""
    return (f"(SELECT {_SEC} // {slide} * {slide} - i * {slide} AS start, * "
            f"FROM events, range({length // slide}) r(i) WHERE {where})")


def _events(t):
    return parquet_stream(t.spark, t.dir, "event*.parquet", t.events.schema)


def _timed(t):
    return event_time(_events(t), "ts")


def _third(column: str = "ts"):
    """0 before the 11th of January 2024, 1 before the 21st, else 2; events without a time come last."""
    before = lambda day: c(column) < F.expr(f"timestamp_ntz '2024-01-{day} 00:00:00'")
    return F.when(before(11), 0).when(before(21), 1).otherwise(2)


def _thirds(t):
    """The whole events table as a stream of three consecutive micro-batches."""
    return queued([t.events.where(_third() == i) for i in range(3)])


@query("str01_map", "SELECT event_id, value * 2 AS v FROM events")
def _(t):
    return append_table(_events(t).select("event_id", (c("value") * 2).alias("v")))


@query("str02_flat_map", "SELECT event_id, unnest([event_type, user_id::VARCHAR]) AS item FROM events")
def _(t):
    return append_table(_events(t).select("event_id", F.explode(F.array("event_type", c("user_id").cast("string"))).alias("item")))


@query("str03_filter", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND value > 50")
def _(t):
    return append_table(_events(t).where("event_type = 'purchase' AND value > 50").select("event_id", "user_id"))


@query("str04_map_partitions", "SELECT event_id, upper(event_type) AS kind FROM events")
def _(t):
    def shout(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"event_id": pdf.event_id, "kind": pdf.event_type.str.upper()})

    return append_table(_events(t).select("event_id", "event_type").mapInPandas(shout, "event_id long, kind string"))


@query("str05_repartition", "SELECT event_id, true AS placed FROM events")
def _(t):
    spread = _events(t).select("event_id").repartition(4, "event_id")
    return append_table(spread.withColumn("placed", F.spark_partition_id() < 4))


@query("str06_union", "SELECT event_id, 'big' AS side FROM events WHERE value > 100 UNION ALL SELECT event_id, 'error' FROM events WHERE event_type = 'error'")
def _(t):
    big = _events(t).where("value > 100").select("event_id", F.lit("big").alias("side"))
    return append_table(big.union(_events(t).where("event_type = 'error'").select("event_id", F.lit("error").alias("side"))))


@query("str07_reduce", f"SELECT {_tumble(DAY)} AS start, max(value) AS top FROM events GROUP BY 1")
def _(t):
    return windowed_table(_timed(t), "1 day", None, [], {"top": F.max("value")})


@query(
    "str08_count",
    f"""WITH n AS (SELECT {_tumble(HOUR)} AS start, count(*) AS n FROM events GROUP BY 1)
        SELECT s.start AS start, coalesce(n, 0) AS n FROM (SELECT unnest(range((SELECT min(start) FROM n), (SELECT max(start) FROM n) + 1, {HOUR})) AS start) s
        LEFT JOIN n ON n.start = s.start""",
)
def _(t):
    return with_empty_windows(windowed_table(_timed(t), "1 hour", None, [], {"n": F.count("*")}), HOUR, "n")


@query("str09_count_by_value", f"SELECT {_tumble(DAY)} AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    return windowed_table(_timed(t), "1 day", None, ["event_type"], {"n": F.count("*")})


@query("str10_foreach_batch", "SELECT count(*) AS n, sum(user_id)::BIGINT AS users FROM events")
def _(t):
    totals = batch_table(_events(t).select("user_id"), "totals", lambda b: b.agg(F.count("*").alias("n"), F.sum("user_id").alias("users")))
    return totals.agg(F.sum("n").alias("n"), F.sum("users").alias("users"))


@query("str11_transform", "SELECT user_id, count(*) AS n FROM events WHERE value > 20 GROUP BY 1")
def _(t):
    busy = lambda df: df.where("value > 20").groupBy("user_id").agg(F.count("*").alias("n"))
    parts = batch_table(_events(t), "transformed", busy)
    return parts.groupBy("user_id").agg(F.sum("n").alias("n"))


@query(
    "str12_transform_with",
    f"""SELECT coalesce(a.start, b.start) AS start, coalesce(a.n, 0) AS views, coalesce(b.n, 0) AS errors
        FROM (SELECT {_tumble(DAY)} AS start, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1) a
        FULL JOIN (SELECT {_tumble(DAY)} AS start, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) b ON a.start = b.start""",
)
def _(t):
    # Two streams tagged and merged, then one aligned aggregate per window.
    views = _timed(t).where("event_type = 'view'").withColumn("side", F.lit(0))
    errors = _timed(t).where("event_type = 'error'").withColumn("side", F.lit(1))
    return windowed_table(views.union(errors), "1 day", None, [], {"views": F.count_if(c("side") == 0), "errors": F.count_if(c("side") == 1)})


@query("str13_print_first_rows", "SELECT least(count(*), 10) AS shown FROM events")
def _(t):
    first = batch_table(_events(t).select("event_id"), "printed", lambda b: b.limit(10))
    return first.agg(F.count("*").alias("shown"))


@query("str14_window", f"SELECT start, event_id FROM {_slides(6 * HOUR, 2 * HOUR)}")
def _(t):
    return append_table(_timed(t).select(F.window("ts", "6 hours", "2 hours").alias("window"), "event_id").select(window_start(), "event_id"))


@query("str15_reduce_by_window", f"SELECT start, round(sum(value), 2) AS total FROM {_slides(12 * HOUR, 4 * HOUR)} GROUP BY 1")
def _(t):
    w = sliding_table(_timed(t), 12 * HOUR, 4 * HOUR, [], {"total": total("value")})
    return w.select("start", F.round("total", 2).alias("total"))


@query("str16_count_by_window", f"SELECT start, count(*) AS n FROM {_slides(6 * HOUR, 3 * HOUR)} GROUP BY 1")
def _(t):
    return sliding_table(_timed(t), 6 * HOUR, 3 * HOUR, [], {"n": rows()}, inverse=True)


@query("str17_count_by_value_and_window", f"SELECT start, event_type, count(*) AS n FROM {_slides(24 * HOUR, 12 * HOUR)} GROUP BY 1, 2")
def _(t):
    return sliding_table(_timed(t), 24 * HOUR, 12 * HOUR, ["event_type"], {"n": rows()}, inverse=True)


@query("str18_slice", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-06 12:00:00'")
def _(t):
    kept = append_table(_events(t).select("event_id", "ts"))
    return kept.where("ts BETWEEN timestamp_ntz '2024-01-05 00:00:00' AND timestamp_ntz '2024-01-06 12:00:00'").select("event_id")


@query("str19_save_text", "SELECT event_id::VARCHAR || ',' || event_type AS line FROM events")
def _(t):
    path = fresh_dir(t.spark, "stream-text")

    def write(batch, number):
        batch.write.mode("overwrite").text(f"{path}/batch={number}")

    run(_events(t).select(F.concat_ws(",", c("event_id").cast("string"), "event_type").alias("value")), "append", write)
    return t.spark.read.text(f"{path}/batch=*").withColumnRenamed("value", "line")


def _flat(lists):
    """Lists back to counts and sums, so that the pieces of a key add up."""
    return lists.groupBy("start", "user_id").agg(
        F.sum(F.size("values")).alias("n"), F.sum(F.aggregate("values", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids")
    )


@query("str20_group_by_key", f"SELECT {_tumble(DAY)} AS start, user_id, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1, 2")
def _(t):
    return _flat(grouped_lists(_timed(t), "1 day", None, ["user_id"], "event_id", 50))


@query("str21_reduce_by_key", f"SELECT {_tumble(DAY)} AS start, user_id, max(value) AS top FROM events GROUP BY 1, 2")
def _(t):
    return windowed_table(_timed(t), "1 day", None, ["user_id"], {"top": F.max("value")})


@query("str22_combine_by_key", f"SELECT {_tumble(DAY)} AS start, user_id, count(*) AS n, min(value) AS low, max(value) AS high FROM events GROUP BY 1, 2")
def _(t):
    return windowed_table(_timed(t), "1 day", None, ["user_id"], {"n": F.count("*"), "low": F.min("value"), "high": F.max("value")})


@query("str23_group_by_key_and_window", f"SELECT start, user_id, count(*) AS n, sum(event_id)::BIGINT AS ids FROM {_slides(2 * DAY, DAY)} GROUP BY 1, 2")
def _(t):
    return _flat(grouped_lists(_timed(t), "2 days", "1 day", ["user_id"], "event_id", 50))


@query("str24_reduce_by_key_and_window", f"SELECT start, event_type, min(value) AS low FROM {_slides(8 * HOUR, 4 * HOUR)} GROUP BY 1, 2")
def _(t):
    return sliding_table(_timed(t), 8 * HOUR, 4 * HOUR, ["event_type"], {"low": least("value")})


@query("str25_reduce_with_key_filter", f"SELECT start, user_id, count(*) AS n FROM {_slides(2 * DAY, DAY)} GROUP BY 1, 2 HAVING count(*) > 3")
def _(t):
    return sliding_table(_timed(t), 2 * DAY, DAY, ["user_id"], {"n": rows()}, inverse=True, keep=c("n") > 3)


@query(
    "str25_inverse_day_by_hour",
    f"SELECT start, event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, count(*) FILTER (WHERE value > 20) AS dear FROM {_slides(DAY, HOUR)} GROUP BY 1, 2",
)
def _(t):
    # 24 windows hold each event; it is aggregated once and makes no more than two rows of its pane.
    reduces = {"n": rows(), "ids": total("event_id"), "dear": rows(c("value") > 20)}
    return sliding_table(_timed(t), DAY, HOUR, ["event_type"], reduces, inverse=True)


@query("str25_panes_of_unequal_steps", f"SELECT start, event_type, min(value) AS low, count(*) AS n FROM (SELECT {_SEC} // 7200 * 7200 - i * 7200 AS start, * FROM events, range(3) r(i)) w WHERE {_SEC} >= start AND {_SEC} < start + 18000 GROUP BY 1, 2")
def _(t):
    # Five hours every two hours: panes of one hour.
    return sliding_table(_timed(t), 5 * HOUR, 2 * HOUR, ["event_type"], {"low": least("value"), "n": rows()})


@query(
    "str26_update_state_by_key",
    """WITH b AS (SELECT user_id, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch FROM events),
            n AS (SELECT user_id, count(*) AS n, min(batch) AS first_batch FROM b GROUP BY 1)
       SELECT user_id, n, 3 - first_batch AS calls FROM n WHERE n > 5""",
)
def _(t):
    # calls counts the batches since the key was first seen: idle keys are updated too.
    state = update_state_by_key(
        _thirds(t), "user_id", {"new": F.count("*")},
        {"n": F.coalesce("old_n", F.lit(0)).cast("long") + F.coalesce("new", F.lit(0)), "calls": F.coalesce("old_calls", F.lit(0)).cast("int") + 1},
    )
    return state.where("n > 5").select("user_id", "n", "calls")


@query("str27_update_state_iterators", "SELECT user_id, count(*) AS n, max(value) AS top FROM events GROUP BY 1")
def _(t):
    stream = _thirds(t).select("user_id", "value")
    return upsert_table(running_maximum(stream, "user_id", "value", "long"), ["user_id"])


class _Visits(EveryBatch):
    """Rows, types and batches of a user in a row; a batch without any forgets the user."""

    values, lists, maps = {"n": "n long"}, {"sizes": "size long"}, {"types": ("type string", "n long")}

    def touch(self, key: tuple, rows: Iterator[pd.DataFrame], state: State) -> tuple[pd.DataFrame | None, bool]:
        size = 0
        for pdf in rows:
            size += len(pdf)
            for kind, n in pdf["event_type"].value_counts().items():
                state.set("types", (kind,), int(n) + state.look("types", (kind,), (0,))[0])
        n = state.get("n", (0,))[0] + size
        state.put("n", n)
        state.append("sizes", size)
        sizes = [x for (x,) in state.items("sizes")]
        out = {"user_id": key[0], "n": n, "batches": len(sizes), "largest": max(sizes), "types": len(list(state.items("types"))), "here": size > 0}
        return pd.DataFrame([out]), size > 0


@query(
    "str27_keyed_state_idle_keys",
    """WITH p AS (SELECT user_id, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch, event_type FROM events),
            s AS (SELECT user_id, batch, count(*) AS size FROM p GROUP BY 1, 2),
            f AS (SELECT user_id, batch, size, batch - row_number() OVER (PARTITION BY user_id ORDER BY batch) AS run FROM s),
            r AS (SELECT user_id, run, min(batch) AS a, max(batch) AS z, sum(size)::BIGINT AS n, count(*) AS batches, max(size) AS largest FROM f GROUP BY 1, 2),
            k AS (SELECT r.user_id, r.a, count(DISTINCT p.event_type) AS types FROM r JOIN p ON p.user_id = r.user_id AND p.batch BETWEEN a AND z GROUP BY 1, 2)
       SELECT r.user_id, z::INTEGER AS last_batch, n, batches, largest, types FROM r JOIN k ON k.user_id = r.user_id AND k.a = r.a
       UNION ALL SELECT r.user_id, z + 1, n, batches + 1, largest, types FROM r JOIN k ON k.user_id = r.user_id AND k.a = r.a WHERE z < 2""",
)
def _(t):
    # The last word on every run of batches: in its last batch, and in the batch after it that found the user idle.
    stream = _thirds(t).select("user_id", "event_type")
    told = keyed_table(stream, ["user_id"], _Visits(), "user_id long, n long, batches long, largest long, types long, here boolean")
    return materialize(told, "visits").transform(_last_words)


def _last_words(told):
    after = told.where("here").select("user_id", (c("batch") - 1).alias("batch"))
    return told.join(after, ["user_id", "batch"], "left_anti").select("user_id", c("batch").alias("last_batch"), "n", "batches", "largest", "types")


@query("str28_map_values", "SELECT user_id AS k, unnest([value, -value]) AS v FROM events")
def _(t):
    pairs = _events(t).select(c("user_id").alias("k"), c("value").alias("v"))
    return append_table(pairs.select("k", F.explode(F.array(c("v"), -c("v"))).alias("v")))


@query(
    "str29_cogroup",
    f"""SELECT {_tumble(DAY)} AS start, user_id, count(*) FILTER (WHERE event_type = 'view') AS views,
               coalesce(sum(event_id) FILTER (WHERE event_type = 'click'), 0)::BIGINT AS click_ids
        FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2""",
)
def _(t):
    # Lists of both streams per window and key, side by side as a tag column.
    views = _timed(t).where("event_type = 'view'").withColumn("side", F.lit("v"))
    clicks = _timed(t).where("event_type = 'click'").withColumn("side", F.lit("c"))
    lists = grouped_lists(views.union(clicks), "1 day", None, ["user_id", "side"], "event_id", 50)
    ids = F.aggregate("values", F.lit(0).cast("long"), lambda a, x: a + x)
    return lists.groupBy("start", "user_id").agg(
        F.sum(F.when(c("side") == "v", F.size("values")).otherwise(0)).alias("views"),
        F.sum(F.when(c("side") == "c", ids).otherwise(0)).alias("click_ids"),
    )


_SIDES = f"""l AS (SELECT {_tumble(DAY)} AS start, user_id, event_id AS view_id FROM events WHERE event_type = 'view'),
             r AS (SELECT {_tumble(DAY)} AS start, user_id, event_id AS buy_id FROM events WHERE event_type = 'purchase')"""


def _sides(t):
    def side(kind, name):
        s = _timed(t).where(c("event_type") == kind)
        return s.select(F.window("ts", "1 day").alias("w"), "user_id", c("event_id").alias(name))

    return side("view", "view_id"), side("purchase", "buy_id")


def _join(t):
    left, right = _sides(t)
    return append_table(left.join(right, ["w", "user_id"]).select(window_start("w"), "user_id", "view_id", "buy_id"))


def _outer(t, how):
    def side(stream, kind, name):
        kept = stream.where((c("event_type") == kind) | is_ending("ts"))
        return kept.select(F.window("ts", "1 day").alias("w"), "user_id", apart("user_id", kind).alias("apart"), c("event_id").alias(name))

    def join(left, right):
        return side(left, "view", "view_id").join(side(right, "purchase", "buy_id"), ["w", "user_id", "apart"], how).select(window_start("w"), "user_id", "view_id", "buy_id")

    return outer_join_table(_timed(t), _timed(t), join, c("start") >= F.unix_timestamp(F.lit(END)))


@query("str30_join", f"WITH {_SIDES} SELECT l.start AS start, l.user_id AS user_id, view_id, buy_id FROM l JOIN r ON l.start = r.start AND l.user_id = r.user_id")
def _(t):
    return _join(t)


@query("str31_left_outer_join", f"WITH {_SIDES} SELECT l.start AS start, l.user_id AS user_id, view_id, buy_id FROM l LEFT JOIN r ON l.start = r.start AND l.user_id = r.user_id")
def _(t):
    return _outer(t, "left")


@query("str32_right_outer_join", f"WITH {_SIDES} SELECT r.start AS start, r.user_id AS user_id, view_id, buy_id FROM l RIGHT JOIN r ON l.start = r.start AND l.user_id = r.user_id")
def _(t):
    return _outer(t, "right")


@query("str32_full_outer_join", f"WITH {_SIDES} SELECT coalesce(l.start, r.start) AS start, coalesce(l.user_id, r.user_id) AS user_id, view_id, buy_id FROM l FULL JOIN r ON l.start = r.start AND l.user_id = r.user_id")
def _(t):
    return _outer(t, "full")


@query("str33_stream_static_join", "SELECT event_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey")
def _(t):
    known = t.customer.select(c("c_custkey").alias("user_id"), "c_mktsegment")
    return append_table(_events(t).join(known, "user_id").select("event_id", "c_mktsegment"))


@query("str34_save_key_value_files", "SELECT user_id AS k, value AS v FROM events")
def _(t):
    saved = batch_table(_events(t), "pairs", lambda b: b.select(c("user_id").alias("k"), c("value").alias("v")))
    return saved.select("k", "v")


@query("str35_text_file_stream", "SELECT doc_id::VARCHAR || '|' || lang AS line FROM documents")
def _(t):
    path = fresh_dir(t.spark, "incoming")
    t.documents.select(F.concat_ws("|", c("doc_id").cast("string"), "lang")).write.text(path)
    return append_table(t.spark.readStream.text(path).withColumnRenamed("value", "line"))


@query("str36_queue_stream", "SELECT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return batch_table(_thirds(t), "queue-counts", lambda b: b.agg(F.count("*").alias("n")))


@query("str37_constant_input", "SELECT b.i::INTEGER AS batch, c_mktsegment, count(*) AS n FROM customer, range(3) b(i) GROUP BY 1, 2")
def _(t):
    # Every batch sees the same fixed table.
    segments = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return batch_table(_thirds(t), "constant", lambda _b: segments)


@query("str38_checkpoint_recovery", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t):
    # The first run stops after half of the files; the second picks up its checkpoint.
    inbox, state, out = (fresh_dir(t.spark, x) for x in ("inbox", "recovery-state", "recovery-out"))

    def go():
        source = parquet_stream(t.spark, inbox, "*", t.events.schema)
        counts = source.groupBy("user_id").agg(F.count("*").alias("n"))
        run(counts, "update", lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), checkpoint=state)

    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for i, name in enumerate("ab"):
        t.events.where(half == i).write.parquet(f"{inbox}/{name}")
        go()
    changes = t.spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    return changes.groupBy("user_id").agg(F.max_by("n", "batch").alias("n"))


def _regression_sql(step: float, rounds: int) -> str:
    text = f"""WITH p AS MATERIALIZED (SELECT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch, value / 100 AS y,
        hour(ts) / 24 AS x1, (props->>'$.k')::DOUBLE / 100 AS x2 FROM events), s0_0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c)"""
    for batch in range(3):
        if batch:
            text += f", s{batch}_0 AS (SELECT * FROM s{batch - 1}_{rounds})"
        for i in range(1, rounds + 1):
            down = lambda w, x: f"any_value({w}) - {step / i**0.5!r} * sum(2 * (a + b * x1 + c * x2 - y){x}) / count(*) AS {w}"
            text += f", s{batch}_{i} AS MATERIALIZED (SELECT {down('a', '')}, {down('b', ' * x1')}, {down('c', ' * x2')} FROM p, s{batch}_{i - 1} WHERE batch = {batch})"
    return text + " UNION ALL ".join(f" SELECT {b} AS batch, round(a, 6) AS w0, round(b, 6) AS w1, round(c, 6) AS w2 FROM s{b}_{rounds}" for b in range(3))


@query("str39_streaming_linear_regression", _regression_sql(0.3, 10))
def _(t):
    from tarnwork.ml.streaming_regression import StreamingLinearRegression

    points = _thirds(t).select((c("value") / 100).alias("label"), F.array(F.lit(1.0), F.hour("ts") / 24, F.get_json_object("props", "$.k").cast("double") / 100).alias("features"))
    history = StreamingLinearRegression(dims=3, step=0.3, iterations=10).train_on(points).weight_history()
    return history.select("batch", *[F.round(F.split("weights", ",")[i].cast("double"), 6).alias(f"w{i}") for i in range(3)])


@query("str40_labelled_point_stream", "SELECT label::DOUBLE AS label, len(embedding)::INTEGER AS dims, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 9) AS total FROM embeddings")
def _(t):
    path = fresh_dir(t.spark, "labelled-inbox")
    labelled_lines(t.embeddings.select("label", c("embedding").cast("array<double>").alias("f")), "label", "f").write.text(path)
    points = parse_labelled(t.spark.readStream.text(path), "value").select("label", "features")
    rows = append_table(points)
    return rows.select("label", F.size("features").alias("dims"), F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 9).alias("total"))


@query(
    "str41_popular_items",
    " UNION ALL ".join(
        f"""SELECT {length}::BIGINT AS length, start, user_id, n FROM (SELECT start, user_id, count(*) AS n, row_number() OVER (PARTITION BY start ORDER BY count(*) DESC, user_id) AS place
            FROM {_slides(length, DAY)} GROUP BY 1, 2) WHERE place <= 5""" for length in (6 * DAY, DAY)
    ),
)
def _(t):
    from pyspark.sql import Window

    def top(seconds):
        counts = sliding_table(_timed(t), seconds, DAY, ["user_id"], {"n": rows()}, inverse=True)
        place = F.row_number().over(Window.partitionBy("start").orderBy(F.desc("n"), "user_id"))
        # place <= 5 is pushed below the shuffle as a group limit.
        return counts.withColumn("place", place).where("place <= 5").select(F.lit(seconds).cast("long").alias("length"), "start", "user_id", "n")

    return top(6 * DAY).union(top(DAY))


@query("str42_page_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return upsert_table(_events(t).groupBy("event_type").agg(F.count("*").alias("n")), ["event_type"])


@query("str42_sliding_page_counts", f"SELECT start, event_type, count(*) AS n FROM {_slides(10 * HOUR, 2 * HOUR)} GROUP BY 1, 2")
def _(t):
    return sliding_table(_timed(t), 10 * HOUR, 2 * HOUR, ["event_type"], {"n": rows()}, inverse=True)


@query("str42_error_rate", f"SELECT start, user_id % 10 AS zip, count(*) AS n, round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS rate FROM {_slides(3 * DAY, DAY)} GROUP BY 1, 2")
def _(t):
    zipped = _timed(t).withColumn("zip", c("user_id") % 10)
    w = sliding_table(zipped, 3 * DAY, DAY, ["zip"], {"n": rows(), "bad": rows(c("event_type") == "error")}, inverse=True)
    return w.select("start", "zip", "n", F.round(c("bad") / c("n"), 6).alias("rate"))


@query("str42_active_users", f"SELECT {_tumble(DAY)} AS start, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t):
    # One state row per (window, user); counting them is a second, small aggregate.
    seen = windowed_table(_timed(t), "1 day", None, ["user_id"], {"n": F.count("*")})
    return seen.groupBy("start").agg(F.count("*").alias("users"))


@query("str42_known_users_seen", "SELECT event_id, c_name FROM events JOIN customer ON c_custkey = user_id WHERE c_acctbal > 0")
def _(t):
    known = t.customer.where("c_acctbal > 0").select(c("c_custkey").alias("user_id"), "c_name")
    return append_table(_events(t).join(known, "user_id").select("event_id", "c_name"))


@query("str43_heavy_hitters", "SELECT user_id, count(*) AS exact, true AS near FROM events GROUP BY 1")
def _(t):
    parts = batch_table(_thirds(t), "cms", lambda b: sketches.sketch(b, "user_id"))
    table = materialize(sketches.merged(parts), "cms-merged")
    exact = t.events.groupBy("user_id").agg(F.count("*").alias("exact"))
    est = sketches.estimates(exact.select("user_id"), "user_id", table)
    # Count-min never undercounts; the overcount bound is e / width of all rows, per line.
    total = t.events.agg(F.count("*")).scalar()
    bound = c("exact") + F.ceil(total * 2.71829 / 4096) + 1
    return exact.join(est, "user_id").select("user_id", "exact", c("estimate").between(c("exact"), bound).alias("near"))


@query("str44_distinct_users", "SELECT count(DISTINCT user_id) AS exact, true AS near FROM events")
def _(t):
    parts = batch_table(_thirds(t).select("user_id"), "hll", lambda b: b.agg(F.hll_sketch_agg("user_id", F.lit(12)).alias("s")))
    est = parts.agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("e"))
    exact = t.events.agg(F.count_distinct("user_id")).scalar()
    return est.select(exact.alias("exact"), (F.abs(c("e") - exact) <= F.greatest(F.lit(1.0), 0.1 * exact)).alias("near"))


@query("str45_stateful_word_count", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1")
def _(t):
    docs = parquet_stream(t.spark, t.dir, "document*.parquet", t.documents.schema)
    words = docs.select(F.explode(F.split("text", r"\s+")).alias("word")).where("word <> ''")
    return upsert_table(words.groupBy("word").agg(F.count("*").alias("n")), ["word"])
