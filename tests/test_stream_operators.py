"""Panes, keyed handlers and outer stream joins against the same question asked of a table."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnwork.session import fresh_dir
from tarnwork.streaming.inputs import event_time, parquet_stream, queued
from tarnwork.streaming.keyed import EveryBatch, KeyHandler, keyed_table
from tarnwork.streaming.outer import END, apart, is_ending, outer_join_table
from tarnwork.streaming.panes import added, least, pane_stream, rows, sliding_table, slid, total
from tarnwork.streaming.windows import window_start

MINUTE = 60


def timed(spark, data, schema):
    return spark.createDataFrame(data, f"ts string, {schema}").withColumn("ts", F.col("ts").cast("timestamp"))


def events(spark, n=120):
    data = [(f"1970-01-0{1 + i % 3} {i * 7 % 24:02d}:{i * 13 % 60:02d}:00", "hot" if i % 3 else f"k{i % 5}", i) for i in range(n)]
    return timed(spark, [*data, (None, "hot", 5)], "k string, v long")


@pytest.mark.parametrize("length,slide", [(60, 60), (120, 60), (90, 60), (1440, 60), (50, 70), (7, 3)])
def test_panes_equal_windows(spark, length, slide):
    df = events(spark).where("ts is not null")
    reduces = {"n": rows(), "v": total("v"), "few": rows(F.col("v") > 50)}
    panes = pane_stream(df, length * MINUTE, slide * MINUTE, ["k"], reduces | {"low": least("v")})
    at, step, span = F.unix_timestamp("ts"), slide * MINUTE, length * MINUTE
    starts = F.sequence(F.lit(-2 * span // step * step), F.lit(4 * 86400), F.lit(step))
    placed = df.withColumn("start", F.explode(starts)).where((at >= F.col("start")) & (at < F.col("start") + span))
    want = placed.groupBy("start", "k").agg(F.count("*").alias("n"), F.sum("v").alias("v"), F.count_if(F.col("v") > 50).alias("few"), F.min("v").alias("low"))
    plain = sorted(map(tuple, want.select("start", "k", "n", "v", "few", "low").collect()))
    by_adding = added(panes, span, step, ["k"], reduces | {"low": least("v")}).select("start", "k", "n", "v", "few", "low")
    assert sorted(map(tuple, by_adding.collect())) == plain
    by_inverse = slid(panes, span, step, ["k"], reduces).select("start", "k", "n", "v", "few")
    assert sorted(map(tuple, by_inverse.collect())) == [x[:5] for x in plain]


def test_panes_over_a_stream_copy_no_event(spark):
    df = events(spark)
    stream = event_time(queued([df.where("v < 40"), df.where("v >= 40")]))
    plan = pane_stream(df, 86400, 3600, [], {"n": rows()})._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan
    got = sliding_table(stream, 86400, 3600, [], {"n": rows()}, inverse=True, keep=F.col("n") > 30)
    want = df.groupBy(F.window("ts", "24 hours", "1 hour")).count().where("count > 30").select(window_start(), "count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        sliding_table(stream, 60, 60, [], {"low": least("v")}, inverse=True)


class Sessions(KeyHandler):
    """Closes a key ten minutes after its last event, by a timer of event time."""

    values, lists, maps, time = {"last": "at long"}, {"all": "v long"}, {"seen": ("v long", "n long")}, "event"

    def on_rows(self, key, rows, state, now_ms):
        last = state.get("last", (0,))[0]
        for pdf in rows:
            for v in pdf["v"].tolist():
                state.append("all", v)
                state.set("seen", (v,), state.look("seen", (v,), (0,))[0] + 1)
            last = max(last, int(pdf["ts"].max().timestamp() * 1000))
        state.put("last", last)
        state.wake(last + 600_000)
        return iter(())

    def on_timer(self, key, state, now_ms):
        values = sorted(v for (v,) in state.items("all"))
        distinct = len(list(state.items("seen")))
        state.drop()
        yield pd.DataFrame({"k": [key[0]], "told": [f"{values} {distinct}"]})


def test_timers_of_event_time_close_keys(spark):
    first = timed(spark, [("2024-01-01 00:00:00", "a", 1), ("2024-01-01 00:05:00", "a", 1), ("2024-01-01 00:04:00", "b", 9)], "k string, v long")
    later = timed(spark, [("2024-01-01 01:00:00", "b", 7)], "k string, v long")
    last = timed(spark, [("2024-01-01 02:00:00", "c", 3)], "k string, v long")
    stream = event_time(queued([first, later, last]), "ts", "1 second")
    told = keyed_table(stream, ["k"], Sessions(), "k string, told string").collect()
    assert sorted((r.k, r.told) for r in told) == [("a", "[1, 1] 1"), ("b", "[7, 9] 2")]


class Calls(EveryBatch):
    """Rows and calls of a key; two batches without rows drop it."""

    values = {"kept": "n long, calls long, idle long"}

    def touch(self, key, rows, state):
        size = sum(map(len, rows))
        n, calls, idle = state.get("kept", (0, 0, 0))
        idle = 0 if size else idle + 1
        state.put("kept", n + size, calls + 1, idle)
        return pd.DataFrame({"k": [key[0]], "n": [n + size], "calls": [calls + 1]}), idle < 2


def test_idle_keys_are_touched_dropped_and_live_on_in_a_checkpoint(spark):
    batch = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    inbox, checkpoint, path = (fresh_dir(spark, x) for x in ("keyed-in", "keyed-state", "keyed-out"))
    told = None
    for i, df in enumerate([batch("x", "x", "y"), batch("x", "z"), batch("z"), batch("y", "z")]):
        df.coalesce(1).write.parquet(f"{inbox}/part={i}")
        stream = parquet_stream(spark, inbox, "part=*", df.schema)
        told = keyed_table(stream, ["k"], Calls(), "k string, n long, calls long", checkpoint=checkpoint, path=path)  # a new run each time
    got = sorted((r.batch, r.k, r.n, r.calls) for r in told.collect())
    assert got == [
        (0, "x", 2, 1), (0, "y", 1, 1), (1, "x", 3, 2), (1, "y", 1, 2), (1, "z", 1, 1), (2, "x", 3, 3), (2, "y", 1, 3), (2, "z", 2, 2),
        (3, "x", 3, 4), (3, "y", 1, 1), (3, "z", 3, 3),
    ]


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_stream_joins_down_to_the_last_row(spark, how):
    left = timed(spark, [("2024-01-01 00:00:00", 1, 10), ("2024-01-02 00:00:00", 1, 11), ("2024-01-05 00:00:00", 2, 12), ("2024-01-05 01:00:00", None, 13), ("2024-01-01 03:00:00", 3, 14)], "k long, a long")
    right = timed(spark, [("2024-01-01 01:00:00", 1, 20), ("2024-01-01 02:00:00", 1, 21), ("2024-01-05 00:00:00", 9, 22), ("2024-01-05 01:00:00", None, 23)], "k long, b long")

    def join(x, y):
        x, y = (s.select(F.window("ts", "1 day").alias("w"), "k", apart("k", name).alias("apart"), name) for s, name in ((x, "a"), (y, "b")))
        return x.join(y, ["w", "k", "apart"], how).select(window_start("w"), "k", "a", "b")

    streams = [queued([df.where(f"day(ts) {cond}") for cond in ("= 5", "= 2", "= 1")]) for df in (left, right)]
    got = outer_join_table(*streams, join, F.col("start") >= F.unix_timestamp(F.lit(END)))
    day = lambda s, name: s.select(F.window("ts", "1 day").alias("w"), "k", name)
    want = day(left, "a").join(day(right, "b"), ["w", "k"], how).select(window_start("w"), "k", "a", "b")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_late_rows_of_a_join_are_dropped_only_with_a_delay(spark):
    left = queued([timed(spark, [(f"2024-01-0{d} 00:00:00", 1, d)], "k long, a long") for d in (1, 8, 9, 2)])
    right = queued([timed(spark, [(f"2024-01-0{d} 00:00:00", 1, d)], "k long, b long") for d in (1, 8, 9, 2)])

    def join(x, y):
        x, y = (s.where(F.col(name).isNotNull() | is_ending()).select(F.window("ts", "1 day").alias("w"), "k", name) for s, name in ((x, "a"), (y, "b")))
        return x.join(y, ["w", "k"], "left").select(window_start("w"), "k", "a", "b")

    ended = F.col("start") >= F.unix_timestamp(F.lit(END))
    assert sorted(r.a for r in outer_join_table(left, right, join, ended).collect()) == [1, 2, 8, 9]
    assert sorted(r.a for r in outer_join_table(left, right, join, ended, "1 hour").collect()) == [1, 8, 9]


def test_a_queue_writes_as_many_files_as_its_tables_need(spark):
    many = spark.range(1000, numPartitions=5).withColumnRenamed("id", "x")
    stream = queued([many, many.limit(1), many.limit(0), many])
    from tarnwork.streaming.sinks import batch_table

    counts = batch_table(stream, "queue", lambda b: b.groupBy().agg(F.count("*").alias("n")))
    assert sorted((r.batch, r.n) for r in counts.collect()) == [(0, 1000), (1, 1), (2, 0), (3, 1000)]
