"""Samples, splits and stratified draws."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.ordering import rank_within

_DOUBT = 1e-6  # chance, for each stratum, that the wait list does not hold the border


def thresholds(take: int, size: int, doubt: float = _DOUBT) -> tuple[float, float]:
    """Shares of the seeded order below which a row is drawn for sure, and beyond which it is not, but for ``doubt``.

    Bounds of the number of uniform draws below a share (Meng, Scalable
    Simple Random Sampling and Stratified Sampling, 2013).
    """
    if take >= size:
        return 1.0, 1.0
    share, low, high = take / size, -math.log(doubt) / size, -2 * math.log(doubt) / (3 * size)
    accept = share + high - math.sqrt(high * high + 3 * high * share)
    return max(0.0, accept), min(1.0, share + low + math.sqrt(low * low + 2 * low * share))


def _least(rows: DataFrame, key: str, unit: list[str], takes: dict[object, tuple[int, int]]) -> tuple[DataFrame, dict[object, int]]:
    """The first ``take`` rows by (_h, unit) of every stratum of ``size`` rows, and how many rows were sorted for each.

    One pass counts the rows below both thresholds; only those between them
    are sorted.  Where the counts show that the border lies elsewhere, all
    rows of the stratum are.
    """
    bounds = {k: thresholds(*v) for k, v in takes.items() if v[0]}
    if not bounds:
        return rows.limit(0), {}
    share = F.col("_h").cast("double") / 2.0**64 + 0.5
    low, high = (F.create_map(*[F.lit(x) for k, v in bounds.items() for x in (k, v[i])])[F.col(key)] for i in (0, 1))
    placed = rows.where(F.col(key).isin(*bounds)).withColumn("_sure", share < low).withColumn("_maybe", share < high)
    counts = {r[0]: (r[1], r[2]) for r in placed.groupBy(key).agg(F.count_if("_sure"), F.count_if("_maybe")).collect()}  # a row for each stratum
    full = {k for k, v in takes.items() if k in counts and v[0] >= v[1]}
    held = {k for k, (sure, maybe) in counts.items() if k in full or sure <= takes[k][0] <= maybe}
    sure = {k: (0 if k not in held else counts[k][0]) for k in counts}
    waits = F.when(F.col(key).isin(*held), ~F.col("_sure") & F.col("_maybe")).otherwise(True) if held else F.lit(True)
    left = F.create_map(*[F.lit(x) for k in counts for x in (k, takes[k][0] - sure[k])])[F.col(key)]
    certain = placed.where(F.col(key).isin(*held) & (F.col("_sure") | F.col(key).isin(*full))) if held else placed.limit(0)
    open_ = placed.where(waits & (~F.col(key).isin(*full) if full else F.lit(True)))
    ranked = rank_within(open_, [key], [F.col("_h"), *[F.col(u) for u in unit]], "_rank").where(F.col("_rank") <= left)
    names = rows.columns
    return certain.select(names).unionByName(ranked.select(names)), {k: 0 if k in full else (c[1] - c[0] if k in held else takes[k][1]) for k, c in counts.items()}


def _hash(seed: int, unit: list[str]) -> Column:
    return F.xxhash64(F.lit(seed), *unit)


def exact_sample(df: DataFrame, unit: list[str], n: int, seed: int = 1) -> DataFrame:
    """Exactly n rows (or all): those of the n smallest seeded hashes, of which only the ones near the border are sorted."""
    rows = df.withColumn("_h", _hash(seed, unit)).withColumn("_all", F.lit(0))
    return _least(rows, "_all", unit, {0: (n, df.count())})[0].drop("_h", "_all")


def stratified_with_sizes(df: DataFrame, key: str, unit: list[str], fractions: dict, seed: int = 1) -> tuple[DataFrame, dict[object, int]]:
    """ceil(fraction * size) rows of every listed stratum, drawn by seeded hash order; and how many rows were sorted for each.

    The strata are those of ``fractions``; rows of others, or with a null
    key, are left out.  A size, two counts and two thresholds for each
    stratum are on the driver.
    """
    rows = df.where(F.col(key).isin(*fractions)).withColumn("_h", _hash(seed, unit))
    sizes = {r[0]: r[1] for r in rows.groupBy(key).count().collect()}
    found, sorted_ = _least(rows, key, unit, {k: (math.ceil(n * fractions[k]), n) for k, n in sizes.items()})
    return found.drop("_h"), sorted_


def exact_stratified(df: DataFrame, key: str, unit: list[str], fractions: dict, seed: int = 1) -> DataFrame:
    """ceil(fraction * size) rows of every listed stratum, drawn by seeded hash order."""
    return stratified_with_sizes(df, key, unit, fractions, seed)[0]


def bucket_sample(df: DataFrame, unit: list[str], bucket: int, out_of: int) -> DataFrame:
    """Bucket x of y by hash of the unit, the same rows on every run."""
    return df.where(F.pmod(F.hash(*unit), F.lit(out_of)) == bucket - 1)


def folds(df: DataFrame, unit: list[str], k: int, seed: int = 1) -> DataFrame:
    """Assign every row to one of k folds; fold i validates, the rest trains."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), *unit), F.lit(k)).cast("int"))
