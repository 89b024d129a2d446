"""Embedding near-duplicates from a forest of random-projection trees."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import batched, materialize, pick, table
from tarnwork.llm.components import components

c = F.col

TREES, LEAF, SAMPLE, BLOCK = 4, 256, 20_000, 1024
OVERLAP = 1.0  # half the spill, in standard deviations of a projected difference at the threshold


@dataclass(frozen=True)
class Tree:
    directions: np.ndarray  # levels x dimensions
    cuts: np.ndarray  # of each node in heap order from 1; nan: a leaf


@dataclass(frozen=True)
class Forest:
    """Trees of each vector length found in the sample; vectors of another length are one leaf."""

    trees: dict[int, list[Tree]]
    spill: dict[int, float]


def fit(sample: list[np.ndarray], depth: int, trees: int, threshold: float, overlap: float, seed: int, least: int = 32) -> Forest:
    """Random directions, one for each level of a tree, and the sample's median at every node.

    A node with fewer than ``least`` sampled vectors is not split.
    """
    by_size: dict[int, list[np.ndarray]] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(v)
    out, spill = {}, {}
    for size, vectors in by_size.items():
        points = np.stack(vectors)
        out[size], spill[size] = [], overlap * math.sqrt(2 - 2 * threshold) / math.sqrt(size)
        for number in range(trees):
            rng = np.random.default_rng((seed, size, number))
            directions = rng.normal(size=(max(depth, 1), size))
            directions /= np.linalg.norm(directions, axis=1, keepdims=True)
            along, node = points @ directions.T, np.ones(len(points), np.int64)
            cuts = np.full(1 << (depth + 1), np.nan)
            for level in range(depth):
                order = np.argsort(node, kind="stable")
                first = np.flatnonzero(np.diff(node[order], prepend=-1))
                for s, e in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
                    if e - s >= least and node[order[s]] >> level == 1:
                        cuts[node[order[s]]] = np.median(along[order[s:e], level])
                split = ~np.isnan(cuts[node])
                split &= node >> level == 1
                node = np.where(split, 2 * node + (along[:, level] > cuts[node]), node)
            out[size].append(Tree(directions, cuts))
    return Forest(out, spill)


def leaves(forest: Forest, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of vectors of one length, by row and leaf; a vector near a cut goes to both sides."""
    size = vectors.shape[1]
    rows, found = [], []
    for number, tree in enumerate(forest.trees.get(size, [])):
        along, spill = vectors @ tree.directions.T, forest.spill[size]
        row, node = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
        for level in range(len(tree.directions)):
            cut = tree.cuts[node]
            done = np.isnan(cut)
            rows.append(row[done])
            found.append(node[done] | np.int64(number + 1) << 40)
            row, node, cut = row[~done], node[~done], cut[~done]
            p = along[row, level]
            low, high = p <= cut + spill, p > cut - spill
            row, node = np.concatenate([row[low], row[high]]), np.concatenate([2 * node[low], 2 * node[high] + 1])
        rows.append(row)
        found.append(node | np.int64(number + 1) << 40)
    if not rows:
        rows, found = [np.arange(len(vectors))], [np.zeros(len(vectors), np.int64)]
    row, leaf = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((leaf, row))
    return row[order], leaf[order]


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of an Arrow column without nulls."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield values[s:e]


def _can_link() -> Column:
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return F.coalesce(c("label").isNotNull() & ~broken & F.exists("v", lambda x: x != 0), F.lit(False))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = TaskContext.get().partitionId() << 33
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + b.num_rows)), *b.columns], names=["id", *b.schema.names])
        at += b.num_rows


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max()  # no overflow in the squares
    return v / np.sqrt((v * v).sum())


_PLACED = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("block", pa.int64()), ("other", pa.int64()),
                     ("leaf", pa.int64()), ("leaves", pa.list_(pa.int64())), ("u", pa.list_(pa.float64()))])
_PLACED_SQL = "key long, id long, n long, block long, other long, leaf long, leaves array<long>, u array<double>"
_FOUND = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])
_LINKED, _COUNT, _BIG = 0, 1, 2


def _place(shared):
    """Rows of classes (id, n, label_hash, v) into a row for each leaf they are in; the key is of label, length and leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids, n, label = (batch.column(i).to_numpy() for i in range(3))
                units = [_unit(v) for v in _lists(batch.column(3))]
                sizes = np.array([len(u) for u in units])
                for size in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == size)
                    vectors = np.stack([units[i] for i in own])
                    row, leaf = leaves(shared.value, vectors)
                    first = np.r_[np.flatnonzero(np.diff(row, prepend=-1)), len(row)]
                    lists = [leaf[first[r] : first[r + 1]].tolist() for r in range(len(own))]
                    key = (label[own[row]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (leaf.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) ^ np.uint64(size * 0x165667B19E3779F9 % 2**64)
                    zero = np.zeros(len(row), np.int64)
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(row) * size + 1, size).astype(np.int32)), pa.array(vectors[row].ravel()))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)), pa.array(ids[own[row]]), pa.array(n[own[row]]), pa.array(zero), pa.array(zero),
                        pa.array(leaf), pa.array([lists[r] for r in row], pa.list_(pa.int64())), flat], schema=_PLACED)

    return run


def _tree_links(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all links connect."""
    left, out = np.ones(len(near), bool), []
    for root in range(len(near)):
        if left[root]:
            left[root], todo = False, [root]
            while todo:
                at = todo.pop()
                more = np.flatnonzero(near[at] & left)
                left[more] = False
                out += [(i, at) for i in more]
                todo += more.tolist()
    return out


def _compare(threshold: float, limit: int | None):
    """Over rows sorted by key: links and link counts inside each key; the keys of longer groups come back alone.

    A pair counts in the first leaf that both are in, and between blocks only
    in the piece of both.
    """

    def group(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        u = np.stack([r[7] for r in rows])
        near = u @ u.T >= threshold
        np.fill_diagonal(near, False)
        if not near.any():
            return
        mine = rows[0][5]
        earlier = {leaf: i for i, leaf in enumerate(sorted({x for r in rows for x in r[6] if x < mine}))}
        counted = near
        if earlier:
            inside = np.zeros((len(rows), len(earlier)), np.float32)
            for i, r in enumerate(rows):
                inside[i, [earlier[x] for x in r[6] if x < mine]] = 1
            counted = near & (inside @ inside.T == 0)
        block = np.array([r[3] for r in rows])
        if (block != block[0]).any():
            counted = counted & (block[:, None] != block[None, :])
        links = counted @ np.array([r[2] for r in rows], np.int64)
        for i in np.flatnonzero(links):
            yield _COUNT, rows[i][1], int(links[i])
        for i, j in _tree_links(near):
            yield _LINKED, rows[i][1], rows[j][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple[int, int, int]]:
            key, held, big = None, [], False
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(7)]
                for row in zip(*columns, _lists(batch.column(7))):
                    if row[0] != key:
                        if len(held) > 1:
                            yield from group(held)
                        key, held, big = row[0], [], False
                    if big:
                        continue
                    held.append(row)
                    if limit and len(held) > limit:
                        yield _BIG, key, 0
                        held, big = [], True
            if len(held) > 1:
                yield from group(held)

        yield from batched(results(), _FOUND)

    return run


def _found(rows: DataFrame, threshold: float, limit: int | None) -> DataFrame:
    laid_out = rows.repartition("key").sortWithinPartitions("key")
    return laid_out.mapInArrow(_compare(threshold, limit), "kind int, a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE,
                    overlap: float = OVERLAP, block: int = BLOCK, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    Two vectors link if their labels are equal and not null, their lengths
    too, and their cosine in double precision is at least ``threshold``.
    Vectors that are null, all zero, or hold a null or a non-finite number
    link with nothing, and are their own component.  Equal vectors of one
    label are one class with a count, which links inside itself.

    Each tree halves the classes by random directions, one for each level, at
    the medians of a sample of about ``sample`` classes (a bound; the index
    itself holds every class); what lies near a cut goes to both sides.
    Classes are compared with all others of their leaf.  The chance that a
    pair at the threshold shares no leaf is some 1e-8 with four trees; tests
    measure recall against all pairs.  A leaf of more than ``block`` classes
    is compared in pieces of two blocks.  Pairs are never written: a task
    writes links of a spanning forest and, for each class, how many vectors
    it found, each pair in the first leaf that it shares.

    Rows with equal ids are vectors of their own; null ids come last; no rows
    give no rows.
    """
    spark = vectors.sparkSession
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    rows = pick(vectors, vec_id="long", embedding="array<float>" if single else "array<double>", label="string").withColumnRenamed("embedding", "v")
    valid = rows.where(_can_link())
    classes = valid.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    kind = "array<float>" if single else "array<double>"
    classes = materialize(classes.mapInArrow(_numbered, f"id long, label string, v {kind}, least long, n long"), "vector-classes")
    largest, total = classes.groupBy("label", F.size("v")).agg(F.count("*").alias("k")).agg(F.max("k"), F.sum("k")).first()
    depth = max(0, math.ceil(math.log2((largest or 1) / leaf)))
    taken = classes.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, sample / (total or 1)) * (1 << 30))).select("v") if depth else None
    points = [_unit(v) for v in _lists(pa.concat_arrays(taken.toArrow().column("v").chunks))] if depth else []
    forest = fit(points, depth, trees, threshold, overlap, seed) if depth else Forest({}, {})
    placed = classes.select("id", "n", F.xxhash64("label").alias("label"), "v").mapInArrow(_place(spark.sparkContext.broadcast(forest)), _PLACED_SQL)
    found = materialize(_found(placed, threshold, block), "vector-links")
    big = found.where(c("kind") == _BIG).select(c("a").alias("key"))
    if not big.isEmpty():
        crowded = materialize(placed.join(big, "key", "left_semi"), "vector-crowded")
        blocks = materialize(crowded.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks")), "vector-blocks")
        own = crowded.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
        pieces = own.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).withColumn(
            "key", F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")))
        found = found.union(materialize(_found(pieces.select(*_PLACED.names), threshold, None), "vector-more-links"))
    counts = found.where(c("kind") == _COUNT).groupBy(c("a").alias("id")).agg(F.sum("b").alias("links"))
    linked = components(found.where(c("kind") == _LINKED).select("a", "b"))
    named = materialize(classes.select("id", "label", "v", "least", "n").join(linked, "id", "left").join(counts, "id", "left").select(
        "label", "v", "n", "least", F.coalesce("component", "id").alias("root"), F.coalesce("links", F.lit(0).cast("long")).alias("links")), "vector-named")
    least = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "vector-components")
    known = materialize(named.join(least, "root").select("label", "v", (c("n") - 1 + c("links")).alias("n_links"), "component_id"), "vector-known")
    joined = valid.join(known, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~_can_link())
    every = joined.union(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), c("vec_id").alias("component_id")))
    return every.withColumn("kept", c("vec_id").eqNullSafe(c("component_id")))


def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
