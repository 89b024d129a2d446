"""Streams in several micro-batches give what one batch gives."""

from pyspark.sql import functions as F

from tarnwork.ml.streaming_regression import StreamingLinearRegression
from tarnwork.session import fresh_dir
from tarnwork.streaming import sketches
from tarnwork.streaming.inputs import event_time, parquet_stream, queued
from tarnwork.streaming.sinks import batch_table, upsert_table
from tarnwork.streaming.state import update_state_by_key
from tarnwork.streaming.windows import windowed_table, with_empty_windows


def events(spark, rows):
    df = spark.createDataFrame(rows, "ts string, k string, v double")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


ROWS = [(f"2024-01-01 00:{m:02d}:00", "hot" if m % 3 else "b", float(m)) for m in range(0, 40, 2)]


def test_windows_over_batches_equal_one_batch(spark):
    df = events(spark, ROWS)
    parts = [df.where(f"minute(ts) {cond}") for cond in ("< 14", "BETWEEN 14 AND 27", "> 27")]
    stream = event_time(queued(parts), "ts", "5 minutes")
    got = windowed_table(stream, "10 minutes", "5 minutes", ["k"], {"n": F.count("*"), "s": F.sum("v")})
    want = df.groupBy(F.window("ts", "10 minutes", "5 minutes"), "k").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    want = want.select(F.unix_timestamp("window.start").alias("start"), "k", "n", "s")
    assert sorted(map(tuple, got.select("start", "k", "n", "s").collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_dropped_after_the_watermark(spark):
    first = events(spark, [("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 02:00:00", "a", 1.0)])
    # The watermark reached in one batch closes its windows at the end of the next.
    between = events(spark, [("2024-01-01 02:02:00", "a", 1.0)])
    late = events(spark, [("2024-01-01 00:01:00", "a", 1.0), ("2024-01-01 02:01:00", "a", 1.0)])
    got = windowed_table(event_time(queued([first, between, late]), "ts", "10 minutes"), "1 hour", None, [], {"n": F.count("*")})
    assert sorted(r.n for r in got.collect()) == [1, 3]


def test_nothing_is_dropped_without_a_delay(spark):
    df = events(spark, [(f"2024-01-{d:02d} {h:02d}:00:00", "a", 1.0) for d in range(1, 9) for h in range(0, 24, 3)])
    parts = [df.where(f"day(ts) {cond}") for cond in ("> 5", "< 3", "BETWEEN 3 AND 5")]
    got = windowed_table(event_time(queued(parts)), "1 day", None, [], {"n": F.count("*")})
    assert sorted(r.n for r in got.collect()) == [8] * 8


def test_streams_without_files_give_empty_tables(spark):
    path = fresh_dir(spark, "nothing")
    spark.createDataFrame([], "ts timestamp, k string, v double").write.parquet(path)
    stream = parquet_stream(spark, path, "part-none*", spark.read.parquet(path).schema)
    assert windowed_table(event_time(stream), "1 day", None, ["k"], {"n": F.count("*")}).collect() == []
    assert batch_table(stream, "none", lambda b: b.agg(F.count("*").alias("n"))).collect() == []
    state = update_state_by_key(stream, "k", {"new": F.count("*")}, {"n": F.coalesce("old_n", F.lit(0)).cast("long") + F.coalesce("new", F.lit(0))})
    assert state.collect() == [] and state.columns == ["k", "n"]


def test_empty_windows(spark):
    df = spark.createDataFrame([(0, 2), (180, 1)], "start long, n long")
    assert [tuple(r) for r in with_empty_windows(df, 60, "n").orderBy("start").collect()] == [(0, 2), (60, 0), (120, 0), (180, 1)]


def test_state_touches_idle_keys_and_drops_them(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 5)], "k string, v long")
    b = spark.createDataFrame([("x", 10), ("z", 1)], "k string, v long")
    nothing = spark.createDataFrame([("z", 0)], "k string, v long")
    state = update_state_by_key(
        queued([a, b, nothing]), "k", {"new": F.sum("v")},
        {"total": F.coalesce("old_total", F.lit(0)).cast("long") + F.coalesce("new", F.lit(0)),
         "idle": F.when(F.col("new").isNull(), F.coalesce("old_idle", F.lit(0)).cast("int") + 1).otherwise(0)},
        keep=F.col("idle") < 2,
    )
    assert sorted(map(tuple, state.select("k", "total", "idle").collect())) == [("x", 13, 1), ("z", 1, 0)]


def test_upsert_continues_from_a_checkpoint(spark):
    state = fresh_dir(spark, "cp")
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "k string, v long")
    stream = queued([df.where("v = 1"), df.where("v = 2")])
    counts = stream.groupBy("k").agg(F.count("*").alias("n"))
    assert dict(map(tuple, upsert_table(counts, ["k"], checkpoint=state).collect())) == {"a": 2, "b": 1}


def test_count_min_never_undercounts(spark):
    df = spark.createDataFrame([(f"u{i % 37}",) for i in range(1000)], "u string")
    parts = batch_table(queued([df.limit(500), df.subtract(df.limit(0)).union(df)]), "cms", lambda b: sketches.sketch(b, "u", 4, 64))
    table = sketches.merged(parts)
    seen = batch_table(queued([df]), "x", lambda b: b).count()
    assert seen == 1000
    total = table.groupBy("line").agg(F.sum("hits").alias("h")).collect()
    assert len({r.h for r in total}) == 1


def test_streaming_regression_learns_a_line(spark):
    df = spark.range(200).select((F.col("id") / 200).alias("x")).select((2.0 * F.col("x") + 1.0).alias("label"), F.array(F.lit(1.0), F.col("x")).alias("features"))
    model = StreamingLinearRegression(2, step=0.5, iterations=25).train_on(queued([df, df, df]))
    assert model.weight_history().count() == 3
    error = model.predict_on(df).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).head()[0]
    assert error < 0.3
