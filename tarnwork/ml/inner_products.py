"""The items of largest inner product for every user."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.session import materialize

USERS, ITEMS = 2048, 4096  # vectors of a block
USER_BLOCKS, MOST_USERS = 128, 1 << 16  # blocks of users after which they become longer, up to this length
SLICE = 256  # users multiplied with a block of items at once
_BLOCK = "ids binary, vectors binary, norm double"


def _blocks(df: DataFrame, rows: int, by_norm: bool, label: str) -> DataFrame:
    """Vectors in blocks of at most ``rows``: (ids, vectors, norm = the largest of the block), by falling norm if asked for."""
    size = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    plain, number = ("float", "<f4") if df.schema["features"].dataType.simpleString() == "array<float>" else ("double", "<f8")
    kept = df.select(F.col("id").cast("long"), F.col("features").cast(f"array<{plain}>").alias("features"), size.alias("norm"))
    if by_norm:
        kept = kept.repartitionByRange(F.desc("norm")).sortWithinPartitions(F.desc("norm"), "id")  # blocks of like norms
    schema = pa.schema([("ids", pa.binary()), ("vectors", pa.binary()), ("norm", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def told(some: pa.RecordBatch) -> pa.RecordBatch:
            flat = some.column(1).flatten().to_numpy()
            columns = [[some.column(0).to_numpy().astype("<i8").tobytes()], [flat.astype(number).tobytes()], [float(np.max(some.column(2).to_numpy()))]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                held.append(batch.slice(at, rows))
                if sum(b.num_rows for b in held) >= rows:
                    every = pa.concat_batches(held)
                    yield told(every.slice(0, rows))
                    held = [every.slice(rows)] if every.num_rows > rows else []
        if held and (every := pa.concat_batches(held)).num_rows:
            yield told(every)

    return materialize(kept.mapInArrow(run, _BLOCK), label)


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n largest scores of each row, largest first, of equals the smaller id; -1 where there are fewer."""
    out = np.full((len(scores), n), -1)
    k = min(n, scores.shape[1])
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if k else np.zeros(len(scores))
    for i, row in enumerate(scores):
        near = np.flatnonzero(row >= least[i])
        order = near[np.lexsort((ids[i][near], -row[near]))][:n]
        out[i, : len(order)] = order
    return out


def largest_products(users: DataFrame, items: DataFrame, n: int, user_rows: int | None = None, item_rows: int = ITEMS, places: int = 9) -> DataFrame:
    """(user, place, item, score): the ``n`` items of largest inner product of every user, largest first, ties by id.

    Both sides are (id, features) of one length.  Items are cut into blocks
    by falling norm; every block of users is one task's unit, which streams
    the blocks of items and keeps n a user.  No product exceeds the product of the
    norms, so once that of a block is under the n-th score of all the block's
    users, the rest is not multiplied.  One block of each side is held at a
    time, and items are sent once for each block of users.  So that this grows
    with the items and not with both sides, blocks get longer with more users,
    unless ``user_rows`` is given.  Floats are sent as floats and multiplied in
    double precision.  Null vectors are left out; no users or no items give no rows.
    """
    there = F.col("features").isNotNull() & F.col("id").isNotNull()
    if user_rows is None:
        user_rows = min(max(USERS, -(-users.count() // USER_BLOCKS)), MOST_USERS)
    own_number, item_number = ("<f4" if x.schema["features"].dataType.simpleString() == "array<float>" else "<f8" for x in (users, items))
    of_users = _blocks(users.where(there), user_rows, False, "user-blocks").withColumn("block", F.monotonically_increasing_id())
    of_items = _blocks(items.where(there), item_rows, True, "item-blocks")
    numbers = of_users.select("block")
    # Block numbers meet all item blocks: a row for some thousand by thousand products.
    sent = numbers.join(of_items.hint("shuffle_replicate_nl"), how="cross")
    both = of_users.select("block", F.lit(0).alias("side"), "ids", "vectors", "norm").unionByName(sent.withColumn("side", F.lit(1)))
    schema = pa.schema([("user", pa.int64()), ("place", pa.int32()), ("item", pa.int64()), ("score", pa.float64())])

    def told(ids: np.ndarray, scores: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        row, place = np.nonzero(np.isfinite(scores))
        columns = (ids[row], (place + 1).astype(np.int32), found[row, place], scores[row, place])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = None
        for batch in batches:
            for at in range(batch.num_rows):
                side, raw_ids, raw, norm = (batch.column(i)[at] for i in range(1, 5))
                side, norm = side.as_py(), norm.as_py()
                these = np.frombuffer(raw_ids.as_buffer(), "<i8")
                vectors = np.frombuffer(raw.as_buffer(), item_number if side else own_number).astype("<f8").reshape(len(these), -1)
                if side == 0:
                    if ids is not None:
                        yield told(ids, scores, found)
                    ids, own, sizes, done = these.copy(), vectors, np.sqrt((vectors * vectors).sum(axis=1)), False
                    scores, found = np.full((len(ids), n), -np.inf), np.full((len(ids), n), -1)
                    continue
                # A little above the product of norms, as scores are rounded.
                done = done or bool((sizes * norm * (1 + 1e-9) + 10.0**-places < scores[:, -1]).all())
                if done:
                    continue
                for first in range(0, len(ids), SLICE):
                    some = slice(first, first + SLICE)
                    every = np.concatenate([scores[some], np.round(own[some] @ vectors.T, places)], axis=1)
                    names = np.concatenate([found[some], np.broadcast_to(these, (len(every), len(these)))], axis=1)
                    best = _best(every, names, n)
                    for x, of, fill in ((every, scores, -np.inf), (names, found, -1)):
                        of[some] = np.where(best >= 0, np.take_along_axis(x, np.maximum(best, 0), 1), fill)
        if ids is not None:
            yield told(ids, scores, found)

    laid = both.select("block", "side", "ids", "vectors", "norm").repartition("block").sortWithinPartitions("block", "side", F.desc("norm"))
    return laid.mapInArrow(run, "user long, place int, item long, score double")
