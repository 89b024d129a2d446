"""Mini-batch gradient descent: one aggregate per step, weights on the driver."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSSES = ("least_squares", "logistic", "hinge")
PENALTIES = ("none", "l1", "l2")


def _margin(weights: list[float]) -> Column:
    pairs = F.zip_with(F.col("features"), F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)


def _slope(loss: str, weights: list[float]) -> Column:
    """d loss / d margin for one row."""
    m, y = _margin(weights), F.col("label")
    if loss == "least_squares":
        return 2.0 * (m - y)
    if loss == "logistic":
        return 1.0 / (1.0 + F.exp(-m)) - y
    if loss == "hinge":
        sign = 2.0 * y - 1.0
        return F.when(sign * m < 1.0, -sign).otherwise(0.0)
    raise ValueError(f"loss must be one of {LOSSES}")


def _loss(loss: str, weights: list[float]) -> Column:
    m, y = _margin(weights), F.col("label")
    if loss == "least_squares":
        return (m - y) * (m - y)
    if loss == "logistic":
        return F.log1p(F.exp(-m)) + F.when(y > 0, 0.0).otherwise(m)
    return F.greatest(F.lit(0.0), 1.0 - (2.0 * y - 1.0) * m)


def gradient(df: DataFrame, weights: list[float], loss: str) -> tuple[list[float], int, float]:
    """Sum of gradients, row count and sum of losses, by one partial-then-final aggregate of plain sums."""
    rows = df.select("features", _slope(loss, weights).alias("s"), _loss(loss, weights).alias("l"))
    sums = [F.sum(F.col("s") * F.col("features")[i]).alias(f"g{i}") for i in range(len(weights))]
    row = rows.agg(F.count("*").alias("n"), F.sum("l").alias("loss"), *sums).head()
    return [row[f"g{i}"] or 0.0 for i in range(len(weights))], row["n"], row["loss"] or 0.0


def _shrink(w: float, penalty: str, reg: float, rate: float) -> float:
    if penalty == "l2":
        return w * (1.0 - rate * reg)
    return w


def _soft(w: float, penalty: str, reg: float, rate: float) -> float:
    if penalty == "l1":
        return math.copysign(max(0.0, abs(w) - reg * rate), w)
    return w


def _penalty_value(weights: list[float], penalty: str, reg: float) -> float:
    if penalty == "l1":
        return reg * sum(abs(w) for w in weights)
    if penalty == "l2":
        return reg / 2 * sum(w * w for w in weights)
    return 0.0


def descend(
    df: DataFrame,
    weights: list[float],
    loss: str,
    penalty: str = "none",
    reg: float = 0.0,
    step: float = 1.0,
    iterations: int = 100,
    fraction: float = 1.0,
    seed: int = 42,
    history: list[float] | None = None,
) -> list[float]:
    """Weights after ``iterations`` steps of size step / sqrt(t) on a sample of the rows.

    ``df`` has label double and features array<double>; only the weight
    vector returns to the driver.  Gradients are scaled by the expected
    sample size; the objective before each step is appended to ``history``.
    """
    if penalty not in PENALTIES:
        raise ValueError(f"penalty must be one of {PENALTIES}")
    expected = df.count() * fraction
    if expected == 0:
        return list(weights)
    for t in range(1, iterations + 1):
        batch = df if fraction >= 1.0 else df.sample(False, fraction, seed + t)
        total, _n, loss_sum = gradient(batch, weights, loss)
        if history is not None:
            history.append(loss_sum / expected + _penalty_value(weights, penalty, reg))
        rate = step / math.sqrt(t)
        weights = [
            _soft(_shrink(w, penalty, reg, rate) - rate * g / expected, penalty, reg, rate)
            for w, g in zip(weights, total)
        ]
    return weights
