"""Rank correlation without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.ml.matrix import correlation
from tarnwork.operators.ordering import running_totals
from tarnwork.session import materialize

c = F.col


def average_ranks(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the 1-based rank of the value, ties sharing their mean rank."""
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    upto = running_totals(counts, [], [c(column)], {"_upto": c("_n")})
    ranks = upto.select(column, (c("_upto") - (c("_n") - 1) / 2).alias(name))
    return df.join(ranks, column)


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    ranked = average_ranks(average_ranks(df.select(x, y), x, "_rx"), y, "_ry")
    return ranked.agg(F.corr("_rx", "_ry").alias("spearman"))


def spearman_matrix(df: DataFrame, row: str, features: str = "features") -> DataFrame:
    """(i, j, v): rank correlation of every pair of columns of the vectors in ``features``.

    All columns are ranked together in long form, (column, value), with ties
    sharing their mean rank; the ranks go back to their rows, and the matrix
    is the correlation of those.
    """
    long = df.select(c(row).alias("_row"), F.posexplode(features).alias("_column", "_value"))
    counts = materialize(long.groupBy("_column", "_value").agg(F.count("*").alias("_n")), "column-values")
    upto = running_totals(counts, ["_column"], [c("_value")], {"_upto": c("_n")})
    ranks = materialize(upto.select("_column", "_value", (c("_upto") - (c("_n") - 1) / 2).alias("_rank")), "column-ranks")
    ranked = long.join(ranks, ["_column", "_value"]).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_column", "_rank"))).alias("_pairs"))
    return correlation(ranked.select(F.transform("_pairs", lambda p: p["_rank"]).alias("features")))
