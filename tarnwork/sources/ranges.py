"""Range-partitioned reads from a database table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def split_range(lower: int, upper: int, parts: int) -> list[tuple[int, int]]:
    """``parts`` inclusive ranges that cover [lower, upper] exactly, sizes differing by at most one."""
    length = upper - lower + 1
    starts = [lower + i * length // parts for i in range(parts + 1)]
    return [(a, b - 1) for a, b in zip(starts, starts[1:])]


def range_predicates(column: str, lower: int, upper: int, parts: int) -> list[str]:
    return [f"{column} BETWEEN {a} AND {b}" for a, b in split_range(lower, upper, parts) if a <= b]


def read_database(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, **properties: str
) -> DataFrame:
    """One query per range, each a Spark partition; needs the database's driver on the class path.

    Unlike the reader's own lowerBound/upperBound, rows outside the range are not read.
    """
    return spark.read.jdbc(url, table, predicates=range_predicates(column, lower, upper, parts), properties=properties)
