"""Estimates with confidence bounds from a sample, and bucketed counts."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOTS = 1_000_000


def hash_sample(df: DataFrame, unit: list[str], fraction: float, seed: int = 1) -> DataFrame:
    """Keep rows whose hashed unit falls under the fraction: same rows for any partitioning."""
    slot = F.pmod(F.xxhash64(F.lit(seed), *unit), F.lit(_SLOTS))
    return df.where(slot < int(fraction * _SLOTS))


def _z(confidence: float) -> float:
    return NormalDist().inv_cdf(0.5 + confidence / 2)


def approximate_counts(
    df: DataFrame, keys: list[str], unit: list[str], fraction: float, confidence: float = 0.95
) -> DataFrame:
    """(keys, estimate, low, high): row counts from a sampled scan with normal bounds."""
    z = _z(confidence)
    grouped = hash_sample(df, unit, fraction).groupBy(*keys).agg(F.count("*").alias("_n"))
    centre = F.col("_n") / fraction
    spread = z * F.sqrt(F.col("_n") * (1 - fraction)) / fraction
    return grouped.select(
        *keys, centre.alias("estimate"), (centre - spread).alias("low"), (centre + spread).alias("high")
    )


def approximate_mean_and_sum(
    df: DataFrame, value: Column, unit: list[str], fraction: float, confidence: float = 0.95
) -> DataFrame:
    """One row of mean and sum estimates with bounds, from a sampled scan."""
    z = _z(confidence)
    s = hash_sample(df.withColumn("_x", value), unit, fraction).agg(
        F.count("_x").alias("n"), F.avg("_x").alias("m"), F.stddev_samp("_x").alias("sd")
    )
    half = z * F.col("sd") / F.sqrt("n")
    total = F.col("n") * F.col("m") / fraction
    total_half = z * F.sqrt(
        F.col("n") * (F.pow("sd", F.lit(2.0)) + (1 - fraction) * F.pow("m", F.lit(2.0)))
    ) / fraction
    return s.select(
        F.col("m").alias("mean"), (F.col("m") - half).alias("mean_low"), (F.col("m") + half).alias("mean_high"),
        total.alias("total"), (total - total_half).alias("total_low"), (total + total_half).alias("total_high"),
    )


def histogram_edges(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """(bucket, low, high, n): [a,b) buckets, the last one closed, empty ones listed as 0."""
    spark = df.sparkSession
    frame = spark.createDataFrame(
        [(i, float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)],
        "bucket int, low double, high double",
    )
    inside = df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").between(edges[0], edges[-1]))
    if len(edges) > 2:
        inside = Bucketizer(splits=[float(e) for e in edges], inputCol="_v", outputCol="_b").transform(inside)
    else:
        inside = inside.withColumn("_b", F.lit(0))
    counted = inside.groupBy(F.col("_b").cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    return frame.join(counted, "bucket", "left").select(
        "bucket", "low", "high", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def histogram_even(df: DataFrame, value: str, buckets: int) -> DataFrame:
    """Even buckets from min to max; arithmetic bucket number, no edge search per row."""
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    width = (high - low) / buckets
    number = F.least(F.floor((F.col(value) - low) / width).cast("int"), F.lit(buckets - 1))
    counted = df.groupBy(number.alias("bucket")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    return frame.join(counted, "bucket", "left").select(
        "bucket",
        (low + F.col("bucket") * width).alias("low"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )
