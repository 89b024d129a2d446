"""Event-time windows over streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.ordering import chunked_lists
from tarnwork.streaming.sinks import batch_table, upsert_table


def window_start(name: str = "window") -> Column:
    return F.unix_timestamp(F.col(f"{name}.start")).alias("start")


def windowed(stream: DataFrame, length: str, slide: str | None, keys: list, aggs: dict[str, Column]) -> DataFrame:
    """Aggregate per window (and key) on the stream: (start, keys, aggs)."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    names = [k for k in keys if isinstance(k, str)]
    grouped = stream.groupBy(F.window("ts", length, slide or length), *key_cols).agg(
        *[a.alias(n) for n, a in aggs.items()]
    )
    return grouped.select(window_start(), *names, *aggs)


def windowed_table(stream: DataFrame, length: str, slide: str | None, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """The same, run to the end of the input, late rows merged into their windows."""
    return upsert_table(windowed(stream, length, slide, keys, aggs), ["start", *keys], "windows")


def with_empty_windows(counts: DataFrame, step: int, value: str) -> DataFrame:
    """Add the windows in which nothing arrived, with zero."""
    span = counts.agg(F.min("start").alias("a"), F.max("start").alias("z"))
    every = span.select(F.explode(F.sequence("a", "z", F.lit(step).cast("long"))).alias("start"))
    return every.join(counts, "start", "left").select("start", F.coalesce(value, F.lit(0)).cast("long").alias(value))


def grouped_lists(
    stream: DataFrame, length: str, slide: str | None, keys: list[str], value: str, size: int = 10_000
) -> DataFrame:
    """(start, keys, batch, chunk, values): values per window and key as sorted lists of at most ``size``.

    Each micro-batch adds its own lists, so no list lives in the state store
    and a hot key is many bounded rows.
    """
    rows = stream.select(F.window("ts", length, slide or length).alias("window"), *keys, value).select(window_start(), *keys, value)
    cut = lambda batch: chunked_lists(batch, ["start", *keys], F.col(value), [F.col(value)], "values", size)
    return batch_table(rows, "window-lists", cut)
