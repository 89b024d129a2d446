"""Ordered operators without a single-task window.

Everything here rests on one layout: range-partition by (keys, order), sort
inside partitions, write the stage once, and stitch partitions together with
a table of at most two rows per partition.  A key holding a third of the rows
is then spread over a third of the partitions instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def _ordered_stage(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    by = [F.col(k).asc() for k in keys] + order
    laid_out = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return materialize(
        laid_out.withColumn("_part", F.shiftright("_mid", _POSITION_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_mid"),
        "ordered",
    )


def running_totals(
    df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column]
) -> DataFrame:
    """Inclusive running sums per key in the given order, as extra columns.

    ``order`` must be total inside a key for a deterministic answer.
    """
    columns = df.columns
    named = {name: f"_v{i}" for i, name in enumerate(totals)}
    stage = _ordered_stage(
        df.select("*", *[expr.alias(named[name]) for name, expr in totals.items()]), keys, order
    )
    key = F.struct(*keys) if keys else F.lit(0)
    stage = stage.withColumn("_key", key)
    # First and last key of every partition: one row per partition.
    edges = stage.groupBy("_part").agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi"))
    edge_sums = (
        stage.join(F.broadcast(edges), "_part")
        .where(F.col("_key").eqNullSafe(F.col("_lo")) | F.col("_key").eqNullSafe(F.col("_hi")))
        .groupBy("_part", "_key")
        .agg(*[F.sum(v).alias(v) for v in named.values()])
    )
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = edge_sums.select(
        F.col("_part").alias("_cpart"),
        F.col("_key").alias("_ckey"),
        *[F.sum(v).over(before).alias(f"_c{v}") for v in named.values()],
    )
    inside = Window.partitionBy("_part", "_key").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, 0
    )
    # At most two carry rows per partition, so the broadcast never grows with the data.
    joined = stage.join(
        F.broadcast(carry),
        (F.col("_part") == F.col("_cpart")) & F.col("_key").eqNullSafe(F.col("_ckey")),
        "left",
    )
    return joined.select(
        *columns,
        *[
            (F.sum(v).over(inside) + F.coalesce(F.col(f"_c{v}"), F.lit(0))).alias(name)
            for name, v in named.items()
        ],
    )


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """1-based row number inside each key."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("long")})


def index_rows(df: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """0-based global position of every row in the given total order.

    A row's place in its written partition plus the rows of the partitions
    before it: one number for each partition is broadcast, and nothing is
    shuffled or sorted again after the stage.
    """
    columns = df.columns
    stage = _ordered_stage(df, [], order)
    sizes = stage.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = stage.join(F.broadcast(offsets), "_part")
    return placed.select(*columns, (F.col("_before") + F.col("_pos")).alias(name))


def chunked_lists(
    df: DataFrame,
    keys: list[str],
    value: Column,
    order: list[Column],
    name: str = "values",
    size: int = 100_000,
) -> DataFrame:
    """All values of every key as consecutive lists of at most ``size`` items.

    (keys, chunk, values): a small key is one row, a hot key is many, and no
    task ever holds a whole hot group.
    """
    ranked = rank_within(df.select(*keys, value.alias("_value"), *_sort_inputs(df, order, keys)),
                         keys, order, "_rank")
    return (
        ranked.withColumn("chunk", F.expr(f"(_rank - 1) div {int(size)}"))
        .groupBy(*keys, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "_value"))).alias("_pairs"))
        .select(*keys, "chunk", F.transform("_pairs", lambda p: p["_value"]).alias(name))
    )


def _sort_inputs(df: DataFrame, order: list[Column], keys: list[str]) -> list[str]:
    """Columns the order may refer to: every input column that is not already a key."""
    return [c for c in df.columns if c not in keys]


def sliding(
    df: DataFrame, order: list[Column], value: Column, n: int, block: int = 1 << 16
) -> DataFrame:
    """(start, values): every window of ``n`` consecutive values in the order.

    Rows are cut into blocks of consecutive positions; only the first n-1 rows
    of a block are copied, to the block before, to complete its last windows.
    """
    block = max(block, n)
    rows = index_rows(df.select("*", value.alias("_value")), order, "_idx").select("_idx", "_value")
    home = rows.withColumn("_block", F.expr(f"_idx div {block}"))
    halo = home.where((F.expr(f"_idx % {block}") < n - 1) & (F.col("_block") > 0)).withColumn(
        "_block", F.col("_block") - 1
    )
    w = Window.partitionBy("_block").orderBy("_idx").rowsBetween(0, n - 1)
    return (
        home.unionByName(halo)
        .select(
            "_block",
            F.col("_idx").alias("start"),
            F.collect_list("_value").over(w).alias("values"),
        )
        .where((F.size("values") == n) & (F.expr(f"start div {block}") == F.col("_block")))
        .select("start", "values")
    )
