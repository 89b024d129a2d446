"""Seeded random columns and labelled data around a known model, one row per input row."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GRAIN = 1 << 40


def uniform(unit, seed: int) -> Column:
    """In (0, 1), fixed by the row's unit and the seed whatever the partitioning."""
    return (F.pmod(F.xxhash64(F.lit(seed), unit), F.lit(_GRAIN)) + 0.5) / _GRAIN


def normal(unit, seed: int) -> Column:
    return F.sqrt(-2 * F.log(uniform(unit, seed))) * F.cos(2 * math.pi * uniform(unit, seed + 7919))


def poisson(unit, seed: int, mean: float) -> Column:
    """Inverse distribution function: how many cumulative probabilities lie below the draw."""
    steps, p, total = [], math.exp(-mean), 0.0
    k = 0
    while total < 1 - 1e-15 and k < mean + 40 * math.sqrt(mean) + 40:
        total += p
        steps.append(F.lit(total))
        k += 1
        p *= mean / k
    u = uniform(unit, seed)
    return F.size(F.filter(F.array(*steps), lambda t: t < u))


def vector(kind, unit, seed: int, width: int) -> Column:
    return F.array(*[kind(unit, seed + 104729 * (i + 1)) for i in range(width)])


def linear_points(df: DataFrame, unit: str, weights: list[float], noise: float, seed: int = 1) -> DataFrame:
    xs = vector(uniform, unit, seed, len(weights))
    signal = sum((xs[i] * w for i, w in enumerate(weights)), F.lit(0.0))
    return df.select(unit, xs.alias("features"), (signal + noise * normal(unit, seed + 1)).alias("label"))


def logistic_points(df: DataFrame, unit: str, weights: list[float], intercept: float, seed: int = 1) -> DataFrame:
    xs = vector(normal, unit, seed, len(weights))
    margin = sum((xs[i] * w for i, w in enumerate(weights)), F.lit(intercept))
    hit = uniform(unit, seed + 3) < 1 / (1 + F.exp(-margin))
    return df.select(unit, xs.alias("features"), hit.cast("double").alias("label"))


def margin_points(df: DataFrame, unit: str, weights: list[float], noise: float, seed: int = 1) -> DataFrame:
    """Labels 0/1 by the sign of a noisy linear score."""
    xs = vector(uniform, unit, seed, len(weights))
    score = sum(((xs[i] * 2 - 1) * w for i, w in enumerate(weights)), F.lit(0.0)) + noise * normal(unit, seed + 5)
    return df.select(unit, xs.alias("features"), (score >= 0).cast("double").alias("label"))


def cluster_points(df: DataFrame, unit: str, k: int, width: int, spread: float, seed: int = 1) -> DataFrame:
    """Points around k centres; the centre of a row is fixed by its unit."""
    home = F.pmod(F.xxhash64(F.lit(seed), unit), F.lit(k))
    xs = F.array(*[F.pmod(home * (i + 3) * 37, F.lit(100)) + spread * normal(unit, seed + 11 + i) for i in range(width)])
    return df.select(unit, home.cast("int").alias("home"), xs.alias("features"))


def factor_ratings(df: DataFrame, user: str, item: str, rank: int, noise: float, seed: int = 1) -> DataFrame:
    """Ratings of the given pairs as dot products of hidden factors plus noise."""
    hidden = sum((uniform(user, seed + i) * uniform(item, seed + 100 + i) for i in range(rank)), F.lit(0.0))
    pair = F.concat_ws("|", F.col(user).cast("string"), F.col(item).cast("string"))
    return df.select(user, item, (hidden + noise * normal(pair, seed + 13)).alias("rating"))
