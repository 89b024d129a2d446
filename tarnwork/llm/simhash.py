"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import DOCUMENT, materialize, pick, release, table
from tarnwork.llm.components import components

c = F.col

SEED = 42
BLOCK = 2048  # fingerprints compared with each other in one piece of work
PARTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits); two of the three make a key
_U = np.uint64
_KEYS = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
_LINKS = pa.schema([("big", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, words: int = 4) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, as an unsigned number."""
    tokens = text.lower().split()  # bytes: A-Z only; splits at 0x20 and 0x09-0x0D
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = list(accumulate(map(len, tokens)))
    ends = [e + i for i, e in enumerate(ends)]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    last = ends[words - 1 :] or ends[-1:]
    digest, ones, total = xxhash.xxh64_digest, np.zeros(64, np.int64), len(last)
    for i in range(0, total, 1 << 15):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[i : i + (1 << 15)], last[i : i + (1 << 15)])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, row, fp) of every row: ``row`` is the hash of its text, fp a signed long; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or b"", words) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "row", "fp"])
        release()

    read = pick(docs, doc_id="long", text="string").select("doc_id", F.xxhash64("text").alias("row"), c("text").cast("binary").alias("text"))
    return read.mapInArrow(run, "doc_id long, row long, fp long")


def _masks() -> list[tuple[int, int, np.ndarray]]:
    """For each left-out part: the bits to keep, a mark in its place, the flips of up to one kept bit."""
    out = []
    for j, (at, width) in enumerate(PARTS):
        hole = ((1 << width) - 1) << at
        flips = [0] + [1 << b for b in range(64) if not hole >> b & 1]
        out.append((~hole & (1 << 64) - 1, (j + 1) << at, np.array(flips, np.uint64)))
    return out


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = _masks()
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(fps), 1 << 12):
            part = fps[i : i + (1 << 12)]
            for keep, mark, flips in masks:
                keys = ((part & _U(keep))[:, None] ^ flips[None, :]) | _U(mark)
                same = np.repeat(part, len(flips))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(same.view(np.int64))], schema=_KEYS)


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (i, j), each within the radius, that connect what such links connect inside one group."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    left, out = np.ones(len(fps), bool), []
    for root in range(len(fps)):
        if left[root]:
            left[root], todo = False, [root]
            while todo:
                near_to = todo.pop()
                more = np.flatnonzero(near[near_to] & left)
                left[more] = False
                out += [(i, near_to) for i in more]
                todo += more.tolist()
    return out


def _compare(radius: int, limit: int | None):
    """Over rows sorted by (key, fp): links inside each key; the rows of longer groups come back as (big, key, fp)."""

    def out(big: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), big)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=_LINKS
        )

    def closed(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        two = starts[sizes == 2]
        a, b = fps[two], fps[two + 1]
        near = (np.bitwise_count(a ^ b) <= radius) & (a != b)
        if near.any():
            yield out(False, a[near], b[near])
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            if limit and n > limit:
                yield out(True, keys[s : s + n], fps[s : s + n])
                continue
            group = np.unique(fps[s : s + n])
            if links := np.array(_forest(group, radius)).reshape(-1, 2).T.tolist():
                yield out(False, group[links[0]], group[links[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, big = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            if big is not None:  # the rest of a group that was too long before it ended
                n = int(np.searchsorted(keys, big, "right"))
                if n:
                    yield out(True, keys[:n], fps[:n])
                keys, fps = keys[n:], fps[n:]
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1], "left"))
            yield from closed(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
            big = None
            if limit and len(keys) > limit:
                big = keys[0]
                yield out(True, keys, fps)
                keys, fps = keys[:0], fps[:0]
        yield from closed(keys, fps)
        release()

    return run


def _links_within(rows: DataFrame, radius: int, limit: int | None) -> DataFrame:
    """Links among the rows (key, fp) of each key."""
    laid_out = rows.repartition("key").sortWithinPartitions("key", "fp")
    return laid_out.mapInArrow(_compare(radius, limit), "big boolean, a long, b long")


def links(fps: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect exactly what chains of fingerprints within ``radius`` (4 at most) connect.

    ``fps`` has one column, distinct fingerprints.  Of three parts of the 64
    bits, two hold at most two of four differing bits, so both fingerprints
    reach one value by flipping at most one bit of those two parts each: every
    fingerprint emits 130 such values, rows meet on the value and are compared
    in full.  A value shared by more than ``block`` rows is compared in pieces
    of two blocks, each a task's work of its own; only links of a spanning
    forest of each piece are written, never all pairs.
    """
    if not 0 <= radius <= 4:
        raise ValueError("radius is 0 to 4")
    balls = fps.toDF("fp").mapInArrow(_balls, "key long, fp long")
    met = materialize(_links_within(balls, radius, block), "simhash-met")
    big = met.where("big").select(c("a").alias("key"), c("b").alias("fp"))
    found = met.where("not big").select("a", "b")
    if not big.isEmpty():
        blocks = materialize(big.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks")), "simhash-blocks")
        own = big.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("fp"), "blocks"))
        pieces = own.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp"
        )
        found = found.union(_links_within(pieces, radius, None).select("a", "b"))
    return found.distinct()


def _named(docs: DataFrame, words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """The written rows (doc_id, row, fp), and (fp, root, component_id) of every fingerprint."""
    rows = materialize(fingerprints(docs, words), "simhash")
    least = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = components(links(least.select("fp"), radius))
    joined = materialize(linked.join(least, c("id") == c("fp")).select("fp", "component", "least"), "simhash-linked")
    of_component = materialize(joined.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-components")
    chained = joined.join(of_component, "component").select("fp", c("component").alias("root"), "component_id")
    alone = least.join(chained.select("fp"), "fp", "left_anti").select("fp", c("fp").alias("root"), c("least").alias("component_id"))
    return rows, materialize(chained.union(alone), "simhash-named")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text).

    Null and empty texts have fingerprint zero and are linked like any other.
    Rows with equal ids are documents of their own; a null doc_id takes part,
    and a component takes its least id that is not null.  Other columns are
    not looked at; no rows give no rows.
    """
    rows, named = _named(docs, words, radius)
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` (columns of documents) that come first in their component: by id, null last, then by text hash.

    Of repeated rows one stays.
    """
    rows, named = _named(docs, words, radius)
    of_row = rows.join(named, "fp").select("root", F.struct(c("doc_id").isNull().alias("late"), "doc_id", "row").alias("place"))
    first = materialize(of_row.groupBy("root").agg(F.min("place").alias("place")).select("place.doc_id", "place.row"), "simhash-first")
    whole = pick(docs, **DOCUMENT).withColumn("row", F.xxhash64("text"))
    at = first.select(c("doc_id").alias("first_id"), c("row").alias("first_row"))
    stay = whole.join(at, c("doc_id").eqNullSafe(c("first_id")) & (c("row") == c("first_row")), "left_semi")
    return stay.dropDuplicates(["doc_id", "row"]).select(*DOCUMENT)


def op4_simhash_ball_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
