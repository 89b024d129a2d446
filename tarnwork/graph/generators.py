"""Graphs drawn over a given vertex or row table, reproducible for any partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
_GRAIN = 1 << 30


def _uniform(seed: int, *cols) -> Column:
    """A number in (0, 1) that depends only on the seed and the columns."""
    return (F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(_GRAIN)) + 0.5) / _GRAIN


def _normal(seed: int, *cols) -> Column:
    return F.sqrt(-2 * F.log(_uniform(seed, *cols))) * F.cos(2 * math.pi * _uniform(seed + 1, *cols))


def log_normal(ids: DataFrame, mu: float = 4.0, sigma: float = 1.3, seed: int = 1) -> DataFrame:
    """(src, dst, attr): out-degree log-normal, at most the number of vertices; targets uniform by position.

    ``ids`` is (id, place) with places 0..n-1; targets are places, joined back to ids.
    """
    n = ids.agg(F.count("*")).scalar()
    degree = F.least(n, F.exp(_normal(seed, "id") * sigma + mu).cast("long"))
    drawn = ids.select("id", degree.alias("_d")).where("_d > 0").select(
        c("id").alias("src"), F.explode(F.sequence(F.lit(0).cast("long"), c("_d") - 1)).alias("attr")
    )
    placed = drawn.withColumn("place", F.floor(_uniform(seed + 2, "src", "attr") * n).cast("long"))
    return placed.join(ids.select(c("id").alias("dst"), "place"), "place").select("src", "dst", "attr")


def rmat(
    rows: DataFrame, unit: str, vertices: int, seed: int = 1, a: float = 0.45, b: float = 0.15, q: float = 0.15
) -> DataFrame:
    """(src, dst): one draw per row, each bit choosing a quadrant; distinct edges over 2^k vertices.

    Quadrant weights are fixed values: top left 0.45, top right and bottom left 0.15, bottom right the rest.
    """
    bits = max(1, math.ceil(math.log2(vertices)))
    src = dst = F.lit(0).cast("long")
    for i in range(bits):
        u = _uniform(seed + i, unit)
        down = F.when(u >= a + b, 1).otherwise(0)
        right = F.when((u >= a) & (u < a + b), 1).when(u >= a + b + q, 1).otherwise(0)
        src, dst = src * 2 + down, dst * 2 + right
    return rows.select(src.alias("src"), dst.alias("dst")).distinct()


def grid(ids: DataFrame, columns: int) -> DataFrame:
    """Edges right and down over places 0..n-1 laid out row by row."""
    n = ids.agg(F.count("*")).scalar()
    cells = ids.select("place")
    right = cells.where((c("place") + 1) % columns != 0).select(c("place").alias("src"), (c("place") + 1).alias("dst"))
    down = cells.select(c("place").alias("src"), (c("place") + columns).alias("dst"))
    return right.union(down).where(c("dst") < n)


def star(ids: DataFrame) -> DataFrame:
    """Every place but 0 points at place 0."""
    return ids.where("place > 0").select(c("place").alias("src"), F.lit(0).cast("long").alias("dst"))
