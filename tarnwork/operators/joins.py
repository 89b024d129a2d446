"""Join shapes that need more than a join call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.session import materialize

BLOCK_ROWS = 20_000  # rows of a side that meet in one cell of a block join
MOST_PAIRS = 5e7  # pairs of one key that a task may make in an outer join
MOST_CELLS = 1 << 14  # cells up to which each is a partition of its own


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Size check that reads no more than ``rows`` + 1 rows."""
    return df.limit(rows + 1).count() <= rows


def small_side_join(left: DataFrame, right: DataFrame, on, how: str = "inner", max_rows: int = 1000) -> DataFrame:
    """Join on a condition without equal keys, or on none, with a right side that is checked to be small.

    Every left row meets every right row, so a larger right side is refused:
    an equi join, which the optimizer plans by size, or ``band_join`` is what
    scales.
    """
    if not has_at_most(right, max_rows):
        raise ValueError(f"the right side of this join has more than {max_rows} rows; join on equal keys or bands instead")
    return left.join(F.broadcast(right), on, how)


def _hot_pairs(left: DataFrame, right: DataFrame, keys: list[str], many: DataFrame, most_pairs: float) -> DataFrame:
    """Inner join of the keys listed with their (_n, _m) rows of each side, every pair of pieces a cell."""
    side = most_pairs**0.5
    # A side under the square root stays whole and leaves the rest of the cell to the other.
    a = F.ceil(F.col("_n") / F.greatest(F.lit(side), most_pairs / F.col("_m"))).cast("int")
    b = F.ceil(F.col("_m") / F.greatest(F.lit(side), most_pairs / F.col("_n"))).cast("int")
    pieces = materialize(many.select(*keys, a.alias("_a"), b.alias("_b")), "pieces")
    cells = int(min(pieces.agg(F.sum(F.col("_a").cast("long") * F.col("_b"))).head()[0], MOST_CELLS))

    def dealt(df: DataFrame, own: str, other: str, row: str, column: str, label: str) -> DataFrame:
        # Hashed ids, as the ids of a key may go by the step of the pieces.
        kept = materialize(df.join(pieces, keys).withColumn("_id", F.monotonically_increasing_id()), label)
        placed = kept.withColumn(row, F.pmod(F.xxhash64("_id"), F.col(own)).cast("int")).withColumn(column, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return placed.drop("_id", "_a", "_b").repartition(cells, *keys, "_row", "_column")

    x, y = dealt(left, "_a", "_b", "_row", "_column", "hot-left"), dealt(right, "_b", "_a", "_column", "_row", "hot-right")
    return x.join(y.hint("merge"), [*keys, "_row", "_column"]).drop("_row", "_column")


def full_outer(left: DataFrame, right: DataFrame, keys: list[str], most_pairs: float | None = MOST_PAIRS) -> DataFrame:
    """Full outer join as left join plus unmatched right rows.

    Both halves are join types whose hot partitions adaptive execution may
    split; a direct full outer join would keep a hot key in one task.  Few
    rows can still make many pairs: of a key with more than ``most_pairs``,
    both sides are cut into pieces, and each piece of one meets each of the
    other in a cell of its own, of about that many pairs at most.  With
    ``most_pairs`` None, for sides of unique keys, nothing is counted.
    """
    matched = left.join(right, keys, "left")
    # No distinct: an aggregate on the keys would lend the join its partitioning, which cannot be split.
    whole = matched.unionByName(right.join(left.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    if most_pairs is None:
        return whole
    sizes = left.groupBy(*keys).agg(F.count("*").alias("_n")).join(right.groupBy(*keys).agg(F.count("*").alias("_m")), keys)
    many = materialize(sizes.where(F.col("_n").cast("double") * F.col("_m") > most_pairs), "hot-keys")
    if many.isEmpty():
        return whole
    rest = full_outer(left.join(many, keys, "left_anti"), right.join(many, keys, "left_anti"), keys, None)
    return _hot_pairs(left, right, keys, many, most_pairs).unionByName(rest, allowMissingColumns=True)


def exists_less_than(left: DataFrame, right: DataFrame, left_value: str, right_value: str) -> DataFrame:
    """Left rows for which some right row has right_value < left_value.

    Such a row exists exactly when the minimum does, so the nested loop
    becomes one aggregate and a one-row join.
    """
    bound = right.agg(F.min(right_value).alias("_bound"))
    return left.join(F.broadcast(bound), F.col("_bound") < F.col(left_value), "left_semi")


def band_join(
    left: DataFrame,
    right: DataFrame,
    value: str,
    low: str,
    high: str,
    width: float,
    how: str = "inner",
) -> DataFrame:
    """left.value in [right.low, right.high): equi join on the cells an interval covers.

    Each interval is copied to its own cells only, each left row goes to one
    cell, so the pairs compared stay near the pairs returned.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    cells = right.withColumn("_cell", F.explode(F.sequence(cell(low), cell(high))))
    probe = left.withColumn("_cell", cell(value))
    condition = (
        (probe["_cell"] == cells["_cell"])
        & (F.col(value) >= F.col(low))
        & (F.col(value) < F.col(high))
    )
    return probe.join(cells, condition, how).drop("_cell")


def keep_unmatched_bag(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows that do not occur on the right; left duplicates stay."""
    columns = left.columns
    other = right.toDF(*[f"_r{i}" for i in range(len(columns))]).distinct()
    condition: Column = F.lit(True)
    for i, c in enumerate(columns):
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r{i}"))
    return left.join(other, condition, "left_anti")


def _numbered(df: DataFrame, rows: int, label: str) -> tuple[DataFrame, int]:
    """The rows written once with an ``_id`` and a ``_block`` of about ``rows`` rows, and the number of blocks."""
    kept = materialize(df.withColumn("_id", F.monotonically_increasing_id()), label)
    blocks = max(1, -(-kept.count() // rows))
    # Ids run on from 0 in every partition; the partition's number staggers where it begins.
    at = F.col("_id") + F.shiftright("_id", 33)
    return kept.withColumn("_block", F.pmod(at, F.lit(blocks)).cast("int")), blocks


def _lane_join(left: DataFrame, right: DataFrame, on, how: str, lane: Column, first: Column, last: Column) -> DataFrame:
    """The block join of rows that share a lane: a left row is in one, a right row is copied to each of its own."""
    outer = how in ("right", "full")
    if outer:
        right = materialize(right.withColumn("_right", F.monotonically_increasing_id()), "right-lanes")
    dealt_a = left.withColumn("_lane", lane.cast("long")).alias("a").hint("merge")
    low, high = first.cast("long"), last.cast("long")
    dealt_b = right.withColumn("_lane", F.explode(F.when(low <= high, F.sequence(low, high)))).alias("b").hint("merge")
    meets = (F.col("a._lane") == F.col("b._lane")) & on(lambda name: F.col(f"a.`{name}`"), lambda name: F.col(f"b.`{name}`"))
    # A left row is in one lane, so what meets nothing there meets nothing at all.
    out = dealt_a.join(dealt_b, meets, "left" if how in ("left", "full") else "inner").drop("_lane", "_right")
    if outer:
        met = dealt_b.join(dealt_a, meets, "left_semi").select("_right")
        out = out.unionByName(right.join(met, "_right", "left_anti").drop("_right"), allowMissingColumns=True)
    return out


def block_join(
    left: DataFrame, right: DataFrame, on: Callable[[Callable[[str], Column], Callable[[str], Column]], Column], how: str = "inner",
    rows: int = BLOCK_ROWS, lanes: tuple[Column, Column, Column] | None = None,
) -> DataFrame:
    """Join of two large sides on any condition: inner, left, right or full; the sides' column names differ.

    ``on`` is called with two functions that give a column of the left and of
    the right side by name.  The rows of both sides are cut into blocks of
    about ``rows`` rows, and every pair of blocks is a cell, so each left row
    is copied once for each right block and each right row once for each
    left block.  A cell is sorted and joined by itself, at most ``rows``
    squared comparisons and no more than ``rows`` rows of a side in memory;
    neither side is broadcast, nor has to be small.

    For the outer types each cell's pairs flag the rows that met another; a
    row that no cell has flagged is added with nulls.  A condition that is
    null counts as false.  All pairs are compared: with equal keys or bands
    use an equi join or ``band_join``, which compare fewer.

    Where ``on`` bounds a left value by two of the right row, ``lanes`` leaves
    out the cells without a pair: a lane number of left rows, and the first and
    last lane that a right row can meet.  Every pair that ``on`` holds for must
    lie in these; a row whose lane is null meets none.  Then rows meet within a
    lane only, and no pair is written.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how is inner, left, right or full")
    if clash := set(map(str.lower, left.columns)) & set(map(str.lower, right.columns)):
        raise ValueError(f"both sides have {sorted(clash)}")
    if lanes:
        return _lane_join(left, right, on, how, *lanes)
    a, n = _numbered(left, rows, "left-blocks")
    b, m = _numbered(right, rows, "right-blocks")
    cells = min(n * m, MOST_CELLS)
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    a = a.withColumnsRenamed({"_id": "_left", "_block": "_row"}).withColumn("_column", every(m))
    b = b.withColumnsRenamed({"_id": "_right", "_block": "_column"}).withColumn("_row", every(n))
    dealt_a, dealt_b = (side.repartition(cells, "_row", "_column").alias(name) for side, name in ((a, "a"), (b, "b")))
    same = (F.col("a._row") == F.col("b._row")) & (F.col("a._column") == F.col("b._column"))
    met = dealt_a.join(dealt_b.hint("merge"), same & on(lambda name: F.col(f"a.`{name}`"), lambda name: F.col(f"b.`{name}`")))
    pairs = met.select("_left", "_right", *[f"a.`{x}`" for x in left.columns], *[f"b.`{x}`" for x in right.columns])
    if how == "inner":
        return pairs.drop("_left", "_right")
    pairs = materialize(pairs, "cells")
    out = pairs.drop("_left", "_right")
    for side, key, numbered in (("left", "_left", a), ("right", "_right", b)):
        if how in (side, "full"):
            once = numbered.where(F.col("_column" if side == "left" else "_row") == 0).drop("_row", "_column")
            # No distinct: one left flag is enough for an anti join, and a hot row's flags may be split.
            alone = once.join(pairs.select(key), key, "left_anti").drop(key)
            out = out.unionByName(alone, allowMissingColumns=True)
    return out
