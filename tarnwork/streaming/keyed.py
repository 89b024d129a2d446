"""Keyed state with the caller's own handler: values, lists, maps and a timer for each key."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tarnwork.streaming.sinks import batch_table

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIMES = {"none": "None", "processing": "ProcessingTime", "event": "EventTime"}


@contextmanager
def state_store(spark: SparkSession):
    """Queries started inside keep their state where values, lists, maps and timers can be kept."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class State:
    """What is kept for the key at hand."""

    def __init__(self, handle: StatefulProcessorHandle, handler: KeyHandler):
        self._handle, self._timed = handle, handler.time != "none"
        self._values = {n: handle.getValueState(n, s) for n, s in handler.values.items()}
        self._lists = {n: handle.getListState(n, s) for n, s in handler.lists.items()}
        self._maps = {n: handle.getMapState(n, *s) for n, s in handler.maps.items()}

    def get(self, name: str, default: tuple | None = None) -> tuple | None:
        value = self._values[name]
        return tuple(value.get()) if value.exists() else default

    def put(self, name: str, *value) -> None:
        self._values[name].update(value)

    def append(self, name: str, *value) -> None:
        self._lists[name].appendValue(value)

    def items(self, name: str) -> Iterator[tuple]:
        """Values of a list in their order, or (key, value) pairs of a map."""
        if name in self._lists:
            return (tuple(x) for x in self._lists[name].get())
        return ((tuple(k), tuple(v)) for k, v in self._maps[name].iterator())

    def look(self, name: str, key: tuple, default: tuple | None = None) -> tuple | None:
        one = self._maps[name]
        return tuple(one.getValue(key)) if one.containsKey(key) else default

    def set(self, name: str, key: tuple, *value) -> None:
        self._maps[name].updateValue(key, value)

    def remove(self, name: str, key: tuple) -> None:
        self._maps[name].removeKey(key)

    def wake(self, at_ms: int | None) -> None:
        """Call ``on_timer`` at this time, and at no other; None for never."""
        for t in list(self._handle.listTimers()):
            self._handle.deleteTimer(t)
        if at_ms is not None:
            self._handle.registerTimer(at_ms)

    def drop(self) -> None:
        """Forget the key; its next row starts anew."""
        for kept in (*self._values.values(), *self._lists.values(), *self._maps.values()):
            kept.clear()
        if self._timed:
            self.wake(None)


class KeyHandler:
    """What is kept for a key and what its rows and its timer do.

    ``values`` and ``lists`` give a schema for each name, ``maps`` one for
    keys and one for values.  ``time`` is none, processing or event.  Both
    methods yield frames of the output's columns, under any keys.
    """

    values: dict[str, str] = {}
    lists: dict[str, str] = {}
    maps: dict[str, tuple[str, str]] = {}
    time = "none"

    def on_rows(self, key: tuple, rows: Iterator[pd.DataFrame], state: State, now_ms: int) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def on_timer(self, key: tuple, state: State, now_ms: int) -> Iterator[pd.DataFrame]:
        return iter(())


class _Processor(StatefulProcessor):
    def __init__(self, handler: KeyHandler):
        self._handler = handler

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = State(handle, self._handler)

    def _now(self, times) -> int:
        if self._handler.time == "none":
            return 0
        return times.getCurrentWatermarkInMs() if self._handler.time == "event" else times.getCurrentProcessingTimeInMs()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._handler.on_rows(tuple(key), rows, self._state, self._now(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._handler.on_timer(tuple(key), self._state, self._now(timerValues))

    def close(self) -> None:
        pass


class EveryBatch(KeyHandler):
    """A handler that is also called, without rows, for every known key that a batch has none of.

    ``touch`` gets the key's rows, or none for an idle key, and says whether
    the key stays known.
    """

    time = "processing"

    def touch(self, key: tuple, rows: Iterator[pd.DataFrame], state: State) -> tuple[pd.DataFrame | None, bool]:
        raise NotImplementedError

    def on_rows(self, key: tuple, rows: Iterator[pd.DataFrame], state: State, now_ms: int) -> Iterator[pd.DataFrame]:
        out, stays = self.touch(key, rows, state)
        if stays:
            state.wake(now_ms + 1)  # the next batch starts later
        else:
            state.drop()
        if out is not None:
            yield out

    def on_timer(self, key: tuple, state: State, now_ms: int) -> Iterator[pd.DataFrame]:
        yield from self.on_rows(key, iter(()), state, now_ms)


def keyed(stream: DataFrame, keys: list[str], handler: KeyHandler, output: str, mode: str = "Update") -> DataFrame:
    """The frames that the handler yields for every key of every batch; start it inside ``state_store``.

    A key's rows arrive as a stream of frames and are never held whole.  They
    are handled by one task, as their order may matter; where it does not,
    reduce the batch first (``update_state_by_key``).
    """
    return stream.groupBy(*keys).transformWithStateInPandas(_Processor(handler), output, mode, _TIMES[handler.time])


def keyed_table(stream: DataFrame, keys: list[str], handler: KeyHandler, output: str, label: str = "keyed",
                transform: Callable[[DataFrame], DataFrame] = lambda b: b, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """What the handler yields, run to the end of the input, with the number of the batch in ``batch``.

    Timers of event time that the last watermark passes still fire; those of
    processing time fire in batches that have data.
    """
    with state_store(stream.sparkSession):
        return batch_table(keyed(stream, keys, handler, output), label, transform, checkpoint, path, idle=handler.time == "event")
