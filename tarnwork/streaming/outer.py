"""Outer joins of two streams as one query, down to the last rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.session import fresh_dir
from tarnwork.streaming.inputs import parquet_stream
from tarnwork.streaming.sinks import append_table

#: An instant after all events.  It closes every window and state when it comes as the last row of both sides.
END = datetime(9999, 1, 1)
FOREVER = "36500 days"


def is_ending(column: str = "ts") -> Column:
    """Whether a row is the last of its side, which the filters in a join have to let through."""
    return F.col(column) >= F.lit(END)


def apart(key: str, side: str) -> Column:
    """A further key that keeps null keys of two sides from meeting.

    The state of a full outer join of streams takes two nulls for equal.
    """
    return F.when(F.col(key).isNull(), side).otherwise("")


class Ending:
    """Adds a last row to streams: END as event time, and no nulls, which the planner would filter out of keys."""

    def __init__(self, spark: SparkSession, column: str = "ts"):
        self._spark, self._column, self._path, self._schemas = spark, column, fresh_dir(spark, "ending"), {}

    def added(self, stream: DataFrame) -> DataFrame:
        """The stream, and after ``come`` its last row."""
        name = f"side-{len(self._schemas)}"
        self._schemas[name] = stream.schema
        stream.sparkSession.createDataFrame([], stream.schema).write.parquet(f"{self._path}/{name}/none")
        return stream.unionByName(parquet_stream(self._spark, self._path, f"{name}/*", stream.schema))

    def come(self) -> None:
        for name, schema in self._schemas.items():
            plain = {"timestamp": F.lit(END), "boolean": F.lit(False)}
            last = self._spark.range(1).select(*[
                (F.lit(END) if f.name == self._column else plain.get(f.dataType.simpleString(), F.lit(0))).cast(f.dataType).alias(f.name) for f in schema
            ])
            last.write.mode("append").parquet(f"{self._path}/{name}/last")


def outer_join_table(
    left: DataFrame, right: DataFrame, join: Callable[[DataFrame, DataFrame], DataFrame], ended: Column, delay: str = FOREVER, column: str = "ts",
    checkpoint: str | None = None,
) -> DataFrame:
    """The rows of a join of two streams, unmatched ones included, run to the end of the input.

    ``join`` gets both sides with their watermarks, and a last row at the end
    of time (``is_ending``), and returns a join on equal windows of ``column``
    or on a range of times; ``ended`` says which of its rows come of the last
    rows and are left out.  The sides' columns are plain, not nested.  Both sides are kept as state; the watermark, ``delay``
    behind the newest event of the slower side, evicts rows, and those that
    met no other are emitted then.  At the end of the input a last row on
    both sides moves the watermark past everything, in a second run of the
    same query from its checkpoint.

    Rows later than ``delay`` are dropped; by default none is, and state is
    kept to the end.  Rows without an event time meet nothing and, as no
    watermark passes them, are not emitted: filter or fill them before.
    """
    spark = left.sparkSession
    ending = Ending(spark, column)
    sides = [ending.added(side).withWatermark(column, delay) for side in (left, right)]
    checkpoint, path = checkpoint or fresh_dir(spark, "outer-state"), fresh_dir(spark, "outer")
    joined = join(*sides).where(~F.coalesce(ended, F.lit(False)))
    append_table(joined, checkpoint=checkpoint, path=path)
    ending.come()
    return append_table(joined, checkpoint=checkpoint, path=path)
