"""Exact order statistics from distributed running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.ordering import running_totals
from tarnwork.session import materialize


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float) -> DataFrame:
    """(keys, percentile): linear interpolation between the two closest ranks.

    Rows are first reduced to (key, value, count), then ranked by running
    counts, so neither a hot key nor a long value list meets in one task.
    """
    counted = materialize(
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c")), "value-counts"
    )
    ranked = running_totals(counted, keys, [F.col(value)], {"_upto": F.col("_c")})
    sizes = counted.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    joined = ranked.join(materialize(sizes, "group-sizes"), keys) if keys else ranked.withColumn("_n", sizes.scalar())
    target = (F.col("_n") - 1) * F.lit(p)
    first_index = F.col("_upto") - F.col("_c")
    low, high = F.floor(target), F.ceil(target)
    holds = lambda rank: (rank >= first_index) & (rank < F.col("_upto"))
    picked = joined.where(holds(low) | holds(high)).groupBy(*keys).agg(
        F.max(F.when(holds(low), F.col(value))).alias("_lo"),
        F.max(F.when(holds(high), F.col(value))).alias("_hi"),
        F.max(target - low).alias("_w"),
    )
    return picked.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias("percentile"))
