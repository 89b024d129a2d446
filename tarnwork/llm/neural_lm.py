"""Log-probabilities of whole documents under a gated recurrent language model."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import batched, materialize, pick, table
from tarnwork.llm.language import fold
from tarnwork.llm.recurrent import Network, Shape

c = F.col

END = b""  # no word is empty
LONG_WORD = 64  # bytes
DIRECTORY = 1 << 18  # the most frequent words, whose counts every task holds; all others are joined
HEAD, TAILS, HIDDEN = 1024, 48, 16
WINDOW, LANES, CHUNK = 16, 512, 4_000_000
ROUNDS, RATE, REPLICAS = 4, 0.1, 1024
_PIECE = 8192  # weights in one row of a replica
_RARE = pa.list_(pa.struct([("h", pa.int64()), ("k", pa.int32())]))
_CODED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base", pa.float64()), ("tail", pa.float64()), ("units", pa.binary()), ("rare", _RARE)])
_CODED_SQL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, tail double, units binary, rare array<struct<h: long, k: int>>"
_SCORED = pa.schema([f for f in _CODED if f.name not in ("units", "rare")] + [pa.field("score", pa.float64())])
_SCORED_SQL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, tail double, score double"


def words(text: bytes) -> list[bytes]:
    """Lower-cased (A to Z) words of a UTF-8 text, cut at 0x20 and 0x09 to 0x0D.

    A word of over LONG_WORD bytes is given as its digest and its ending, so
    that what is counted, sent and collected has a bounded size.
    """
    found = text.lower().split()
    if max(map(len, found), default=0) > LONG_WORD:
        return [w if len(w) <= LONG_WORD else b"\xff" + hashlib.sha256(w).digest() + w[-2:] for w in found]
    return found


def word_counts(docs: DataFrame, most: int = 500_000) -> DataFrame:
    """(word, n) over the rows of ``docs`` (text), with one end for each row; a task holds ``most`` words at a time."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(words(text.as_py() or b""))
                seen[END] += 1
                if len(seen) > most:
                    yield from batched(seen.items(), schema, 1 << 15)
                    seen.clear()
        yield from batched(seen.items(), schema, 1 << 15)

    return pick(docs, text="binary").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Lexicon:
    """What every task knows of the training words; its size is bounded by DIRECTORY and two-byte endings."""

    words: list[bytes] = field(repr=False)  # the directory, most frequent first, the end in front
    n: np.ndarray
    tokens: int  # N
    kinds: int  # V
    head: int
    class_of: dict[bytes, int] = field(repr=False)  # of an ending; 0 is all other endings
    mass: np.ndarray  # of each tail class: its tokens, half a token for each of its words and for one unknown

    @property
    def base_mass(self) -> float:
        return self.tokens + 0.5 * (self.kinds + 1)


def lexicon(counts: DataFrame, directory: int = DIRECTORY, head: int = HEAD, tails: int = TAILS) -> tuple[Lexicon, int]:
    """The lexicon of written counts (word, n), and the least count in its directory.

    Frequent words are units of their own.  All others fall into ``tails``
    classes by their last two bytes, the heaviest endings having their own.
    """
    by_n = sorted(((r["n"], r["k"]) for r in counts.where(c("word") != F.lit(END)).groupBy("n").agg(F.count("*").alias("k")).collect()), reverse=True)
    least, held = (by_n[0][0] + 1 if by_n else 1), 0
    for n, k in by_n:
        if held + k > directory:
            break
        least, held = n, held + k
    listed = counts.where((c("n") >= least) & (c("word") != F.lit(END))).select("word", "n").toArrow()
    ends = counts.where(c("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    by_ending = counts.where(c("word") != F.lit(END)).groupBy(F.substring("word", -2, 2).alias("e")).agg(
        F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    known = sorted(zip(listed.column("n").to_pylist(), listed.column("word").to_pylist()), key=lambda x: (-x[0], x[1]))
    tokens = {bytes(r["e"]): r["n"] for r in by_ending}
    kinds = {bytes(r["e"]): r["k"] for r in by_ending}
    total, varied = ends + sum(tokens.values()), (ends > 0) + sum(kinds.values())
    for n, word in known[: head - 1]:
        tokens[word[-2:]] -= n
        kinds[word[-2:]] -= 1
    class_of = {e: i + 1 for i, e in enumerate(sorted((e for e in kinds if kinds[e]), key=lambda e: (-tokens[e], e))[: tails - 1])}
    mass = np.full(tails, 0.5)
    for e in kinds:
        mass[class_of.get(e, 0)] += tokens[e] + 0.5 * kinds[e]
    out = Lexicon([END, *[w for _, w in known]], np.array([ends, *[n for n, _ in known]], np.int64), int(total), int(varied),
                  min(head, len(known) + 1), class_of, mass)
    return out, least


class _Coder:
    """A task's view of the lexicon."""

    def __init__(self, known: Lexicon):
        self.known, self.at = known, {w: i for i, w in enumerate(known.words)}
        self.tail_class = np.array([known.class_of.get(w[-2:], 0) for w in known.words], np.int64)
        index = np.arange(len(known.words))
        self.unit = np.where(index < known.head, index, known.head + self.tail_class).astype(np.uint16)
        self.base = np.log10((known.n + 0.5) / known.base_mass)
        self.tail = np.where(index < known.head, 0.0, np.log10((known.n + 0.5) / known.mass[self.tail_class]))

    def code(self, text: bytes) -> tuple:
        """Tokens, known tokens, base and tail logarithms of the directory's words, units, (hash, class) of all others."""
        found, get = words(text), self.at.get
        at = np.array([get(w, -1) for w in found] + [0], np.int64)
        out = np.flatnonzero(at < 0)
        units = self.unit[at]
        rare = [found[i] for i in out.tolist()]
        kinds = np.array([self.known.class_of.get(w[-2:], 0) for w in rare], np.int32)
        units[out] = self.known.head + kinds
        inside = at[at >= 0]
        hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(w, 42) for w in rare]), ">i8").astype(np.int64)
        known = len(inside) - (self.known.n[0] == 0)
        return len(at), known, float(self.base[inside].sum()), float(self.tail[inside].sum()), units.tobytes(), hashes, kinds


@lru_cache(maxsize=1)
def _coder(shared: Broadcast) -> _Coder:
    return _Coder(shared.value)


def _coded(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, row = _coder(shared), TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                done = [coder.code(text.as_py() or b"") for text in batch.column(2)]
                rare = pa.StructArray.from_arrays([pa.array(np.concatenate([d[5] for d in done])), pa.array(np.concatenate([d[6] for d in done]))], ["h", "k"])
                ends = pa.array(np.cumsum([0, *[len(d[5]) for d in done]]).astype(np.int32))
                plain = [pa.array([d[i] for d in done], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(done))), batch.column(0), batch.column(1), *plain, pa.ListArray.from_arrays(ends, rare)], schema=_CODED)
                row += len(done)

    return run


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """Rows and their units, a bounded number of tokens (or one document) at a time."""
    rows, units, size = [], [], 0
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(column)], batch.column(column).to_pylist()):
            rows.append(row[:column])
            units.append(np.frombuffer(row[column], np.uint16))
            size += len(units[-1])
            if size >= CHUNK:
                yield rows, units
                rows, units, size = [], [], 0
    if rows:
        yield rows, units


def _lanes(units: list[np.ndarray], window: int) -> int:
    """Streams to train on at once: at most LANES, and few enough for about 64 steps."""
    return max(8, min(LANES, sum(map(len, units)) // (64 * window)))


def train(coded: DataFrame, shape: Shape, start: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, window: int = WINDOW,
          replicas: int = REPLICAS) -> np.ndarray:
    """Weights after one pass over all rows of ``coded`` (row, units), an equal part by hash in each round.

    In a round every task trains a copy of the weights on its rows, and the
    copies are averaged by their tokens, piece by piece, on the executors; at
    most ``replicas`` tasks take part.  The driver holds one set of weights.
    """
    spark = coded.sparkSession
    state = np.concatenate([start, np.zeros_like(start)])  # weights and sums of squared gradients

    def averaged(pieces: pd.DataFrame) -> pd.DataFrame:
        values = np.stack([np.frombuffer(v, np.float32) for v in pieces["values"]])
        mean = np.average(values.astype(np.float64), axis=0, weights=pieces["tokens"]).astype(np.float32)
        return pd.DataFrame({"piece": pieces["piece"].iloc[:1], "values": [mean.tobytes()]})

    for number in range(rounds):
        shared = spark.sparkContext.broadcast(state)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, seen = shared.value.copy(), 0
            network, squares = Network(shape, own[: shape.size]), own[shape.size :]
            for _, units in _chunks(batches, 0):
                seen += network.train(units, 0, _lanes(units, window), window, rate, squares)
            if seen:
                parts = [own[i : i + _PIECE].tobytes() for i in range(0, len(own), _PIECE)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                    ["piece", "tokens", "values"])

        part = coded.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == number).select("units").coalesce(replicas)
        copies = part.mapInArrow(learn, "piece int, tokens long, values binary")
        mean = copies.groupBy("piece").applyInPandas(averaged, "piece int, values binary").collect()
        if mean:
            state = np.concatenate([np.frombuffer(r["values"], np.float32) for r in sorted(mean, key=lambda r: r["piece"])])
        shared.unpersist()
    return state[: shape.size]


def _scored(shared: Broadcast, shape: Shape, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(shape, shared.value)

        def rows() -> Iterator[tuple]:
            for held, units in _chunks(batches, 7):
                for row, value in zip(held, network.score(units, 0, LANES, 2 * window)):
                    yield *row, float(value / math.log(10))

        yield from batched(rows(), _SCORED)

    return run


def score(docs: DataFrame, held_out: Column, directory: int = DIRECTORY, head: int = HEAD, tails: int = TAILS, hidden: int = HIDDEN,
          rounds: int = ROUNDS, seed: int = 7) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text).

    ``held_out``: a condition on doc_id; rows where it is true teach nothing,
    neither counts nor weights; null counts as false.  A text's tokens are
    its words and one end.  base_score is the sum of log10((c + 0.5) / (N +
    0.5 (V + 1))).  score is log10 of the model's probability of the whole
    text: a gated recurrent state, carried from the first token to the last,
    gives each token's class, and the word if it is one of the ``head - 1``
    most frequent; any other word has its frequency in its class, (c + 0.5)
    over the class's mass, in which one unknown word has half a token.

    All training rows are counted and trained on once.  Counts of words
    outside the directory are joined by 64-bit hash and summed by row.  A
    null text counts as empty; rows with equal or null ids are scored each by
    itself; with no training rows every word is unknown; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id="long", text="binary").withColumn("held_out", F.coalesce(held_out, F.lit(False))).select("doc_id", "held_out", "text")
    counts = materialize(word_counts(rows.where(~c("held_out"))), "lm-counts")
    known, least = lexicon(counts, directory, head, tails)
    shared = spark.sparkContext.broadcast(known)
    coded = materialize(rows.mapInArrow(_coded(shared), _CODED_SQL), "lm-coded")
    shape = Shape(known.head, tails, hidden)
    start = shape.start(known.n[: known.head] + 0.5, known.mass, seed)
    weights = train(coded.where(~c("held_out")), shape, start, rounds)
    units = coded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "tail", "units")
    scored = units.mapInArrow(_scored(spark.sparkContext.broadcast(weights), shape, WINDOW), _SCORED_SQL)
    rare = coded.select("row", F.explode("rare").alias("w")).select("row", "w.h", "w.k")
    others = counts.where((c("n") < least) & (c("word") != F.lit(END))).select(F.xxhash64("word").alias("h"), "n")
    mass = F.array(*[F.lit(float(m)) for m in known.mass])
    n = F.coalesce("n", F.lit(0)) + 0.5
    sums = rare.join(others, "h", "left").groupBy("row").agg(
        F.sum(F.log10(n / F.lit(known.base_mass))).alias("more_base"),
        F.sum(F.log10(n / F.element_at(mass, c("k") + 1))).alias("more_tail"),
        F.count("n").alias("more_known"),
    )
    return scored.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (c("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (c("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (c("score") + c("tail") + F.coalesce("more_tail", F.lit(0.0))).alias("score"),
    )


def op10_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fold(c("doc_id"), 5) == 1)
