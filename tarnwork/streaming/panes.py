"""Sliding windows from panes: every event is aggregated once, whatever the overlap."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.streaming.sinks import upsert_table

c = F.col


@dataclass(frozen=True)
class Reduce:
    """How a value is reduced: events to a pane, panes to a window and, if that can be undone, what takes a pane off again."""

    of: Column
    merge: Callable[[Column], Column]
    inverse: Callable[[Column], Column] | None = None


def total(value: Column | str) -> Reduce:
    return Reduce(F.sum(value), F.sum, lambda v: -v)


def rows(condition: Column | None = None) -> Reduce:
    return Reduce(F.count("*") if condition is None else F.count_if(condition), F.sum, lambda v: -v)


def least(value: Column | str) -> Reduce:
    return Reduce(F.min(value), F.min)


def most(value: Column | str) -> Reduce:
    return Reduce(F.max(value), F.max)


def pane_stream(stream: DataFrame, length: int, slide: int, keys: list[str], reduces: dict[str, Reduce], column: str = "ts") -> DataFrame:
    """(pane, keys, _rows, values): events reduced once, to panes of the greatest common divisor of length and slide (seconds)."""
    size = gcd(length, slide)
    grouped = stream.groupBy(F.window(column, f"{size} seconds").alias("_pane"), *keys)
    panes = grouped.agg(F.count("*").alias("_rows"), *[r.of.alias(n) for n, r in reduces.items()])
    return panes.select(F.unix_timestamp("_pane.start").alias("pane"), *keys, "_rows", *reduces)


def _first_and_last(length: int, slide: int) -> tuple[Column, Column]:
    """Starts of the first and the last window that hold a pane whole."""
    size = gcd(length, slide)
    low = c("pane") + F.lit(size - length)
    return -F.floor(-low / slide) * slide, F.floor(c("pane") / slide) * slide


def added(panes: DataFrame, length: int, slide: int, keys: list[str], reduces: dict[str, Reduce]) -> DataFrame:
    """(start, keys, values) of every window that holds a row: each window adds up its panes."""
    first, last = _first_and_last(length, slide)
    placed = panes.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    each = placed.withColumn("start", F.explode(F.sequence("_first", "_last", F.lit(slide).cast("long"))))
    return each.groupBy("start", *keys).agg(*[r.merge(c(n)).alias(n) for n, r in reduces.items()])


def slid(panes: DataFrame, length: int, slide: int, keys: list[str], reduces: dict[str, Reduce]) -> DataFrame:
    """The same by an inverse: a pane is added where it enters and taken off where it leaves, two rows for each pane.

    A key's windows are totalled in their order by one task; they are as many
    as the slides of the time spanned, not as the events.
    """
    if missing := [n for n, r in reduces.items() if r.inverse is None]:
        raise ValueError(f"no inverse for {missing}")
    first, last = _first_and_last(length, slide)
    kept = {"_rows": rows()} | reduces
    placed = panes.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    enter = placed.select(*keys, c("_first").alias("start"), *kept)
    leave = placed.select(*keys, (c("_last") + slide).alias("start"), *[r.inverse(c(n)).alias(n) for n, r in kept.items()])
    steps = enter.unionByName(leave).groupBy(*keys, "start").agg(*[r.merge(c(n)).alias(n) for n, r in kept.items()])
    of_key = Window.partitionBy(*keys or [F.lit(0)]).orderBy("start")
    so_far = of_key.rowsBetween(Window.unboundedPreceding, 0)
    held = steps.select(*keys, "start", F.lead("start").over(of_key).alias("_next"), *[r.merge(c(n)).over(so_far).alias(n) for n, r in kept.items()])
    # Between two changes the windows hold the same panes; one without rows is no window.
    every = F.explode(F.sequence("start", c("_next") - slide, F.lit(slide).cast("long")))
    return held.where("_rows > 0").select(*keys, every.alias("start"), *reduces).select("start", *keys, *reduces)


def sliding_table(stream: DataFrame, length: int, slide: int, keys: list[str], reduces: dict[str, Reduce], inverse: bool = False,
                  keep: Column | None = None, checkpoint: str | None = None) -> DataFrame:
    """(start, keys, values) of every sliding window with a row, run to the end of the input.

    ``length`` and ``slide`` are seconds.  The stream keeps one state row for
    each pane and key and writes the panes that a batch changed; windows are
    put together from panes, with ``inverse`` by adding the pane that enters
    and taking off the one that leaves.  ``keep`` filters finished windows.

    Rows without an event time are in no window.  A slide longer than the
    length leaves gaps, and events in them are in no window either.  Sums of
    doubles taken by the inverse may differ in their last bits.
    """
    if length <= 0 or slide <= 0:
        raise ValueError("length and slide are seconds above 0")
    panes = upsert_table(pane_stream(stream, length, slide, keys, reduces), ["pane", *keys], "panes", checkpoint)
    windows = (slid if inverse else added)(panes, length, slide, keys, reduces)
    return windows.where(keep) if keep is not None else windows
