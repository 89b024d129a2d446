"""Mergeable sketches as plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cells(key: str, depth: int, width: int) -> Column:
    """One (line, cell) pair per hash line of a count-min sketch."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("line"), F.pmod(F.xxhash64(F.lit(i), key), F.lit(width)).alias("cell"))
            for i in range(depth)
        ]
    )


def sketch(df: DataFrame, key: str, depth: int = 5, width: int = 4096) -> DataFrame:
    """Count-min sketch as at most depth * width rows (line, cell, hits); sketches merge by adding hits."""
    return (
        df.select(F.explode(cells(key, depth, width)).alias("_c"))
        .groupBy("_c.line", "_c.cell").agg(F.count("*").alias("hits"))
    )


def merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("line", "cell").agg(F.sum("hits").alias("hits"))


def estimates(keys: DataFrame, key: str, table: DataFrame, depth: int = 5, width: int = 4096) -> DataFrame:
    """(key, estimate): the least count over the key's cells; never below the truth."""
    wanted = keys.select(key, F.explode(cells(key, depth, width)).alias("_c")).select(key, "_c.line", "_c.cell")
    # The sketch has a fixed number of rows whatever the stream holds.
    return wanted.join(F.broadcast(table), ["line", "cell"]).groupBy(key).agg(F.min("hits").alias("estimate"))
