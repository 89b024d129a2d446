"""User-defined folds with map-side combine, over Arrow batches.

Values reach the user's functions as plain Python values: integers stay exact
at any size, a null is None, and NaN is a number of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_NAN = float("nan")  # one object, so that it equals itself as a key
_BATCH = 10_000


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _keys(column: pa.Array) -> list:
    """Python values in which all NaN are one key; nulls are None and so another."""
    return [_NAN if isinstance(k, float) and k != k else k for k in column.to_pylist()]


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def combine_by_key(
    df: DataFrame,
    key: str,
    value: str,
    create: Callable,
    merge_value: Callable,
    merge_combiners: Callable,
    schema: str,
    flush_keys: int = 200_000,
) -> DataFrame:
    """Per key: create a combiner, merge values, merge combiners.

    ``schema`` is "<key> type, <combiner> type".  Each input partition sends
    one combiner per key (more only when its table of keys is flushed), so a
    hot key shuffles about one row per partition.  After the shuffle partials
    arrive sorted by key and are merged as a stream, one key in memory at a
    time and without a function call per group.
    """
    arrow = _arrow(schema)
    key_name = arrow.names[0]

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict = {}
        for batch in batches:
            for k, v in zip(_keys(batch.column(0)), batch.column(1).to_pylist()):
                table[k] = merge_value(table[k], v) if k in table else create(v)
            if len(table) >= flush_keys:
                yield from _batches(table.items(), arrow)
                table = {}
        yield from _batches(table.items(), arrow)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> Iterator[tuple]:
            started, current, total = False, None, None
            for batch in batches:
                for k, comb in zip(_keys(batch.column(0)), batch.column(1).to_pylist()):
                    if started and (k is current or k == current):
                        total = merge_combiners(total, comb)
                        continue
                    if started:
                        yield current, total
                    started, current, total = True, k, comb
            if started:
                yield current, total

        yield from _batches(merged(), arrow)

    partial = df.select(key, value).mapInArrow(partials, schema)
    return partial.repartition(key_name).sortWithinPartitions(key_name).mapInArrow(merge, schema)


def tree_aggregate(
    df: DataFrame,
    value: str,
    zero: Callable,
    seq: Callable,
    comb: Callable,
    schema: str,
    fan_in: int = 64,
    depth: int = 2,
) -> DataFrame:
    """Fold all rows: one partial per partition, ``depth`` - 1 fan-in rounds, then one merge.

    ``schema`` is "<name> type" of the accumulator.
    """
    arrow = _arrow(schema)

    def fold(step: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = zero()
            for batch in batches:
                for v in batch.column(0).to_pylist():
                    acc = step(acc, v)
            yield from _batches([(acc,)], arrow)

        return run

    level = df.select(value).mapInArrow(fold(seq), schema)
    for step in range(depth - 1, -1, -1):
        # One partial from each task that made one; fan_in ** step slots, then one.
        level = level.repartition(fan_in**step).mapInArrow(fold(comb), schema)
    return level


def salted_totals(
    df: DataFrame, keys: list[str], unit: list[str], sums: dict[str, str], salts: int = 32
) -> DataFrame:
    """Per-key row count, sums and distinct units in two levels.

    The first level groups by (key, salt), so a key with a third of all rows
    is shared by ``salts`` tasks; the salt hashes the unit, so distinct units
    of different salts never overlap and their counts simply add up.
    """
    salt = F.pmod(F.xxhash64(*unit), F.lit(salts)).alias("_salt")
    first = df.groupBy(*keys, salt).agg(
        F.count("*").alias("_n"),
        F.count_distinct(*unit).alias("_d"),
        *[F.sum(c).alias(f"_s_{name}") for name, c in sums.items()],
    )
    return first.groupBy(*keys).agg(
        F.sum("_n").alias("rows"),
        F.sum("_d").alias("units"),
        *[F.sum(f"_s_{name}").alias(name) for name in sums],
    )
