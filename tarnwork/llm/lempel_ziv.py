"""Document fingerprints from Lempel-Ziv phrases, and the edits of a document by its neighbour."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import batched, pick, table

c = F.col

SIZE = 128  # hashes kept of a document: its smallest
STRETCH = 1 << 24  # characters of the documents in one stretch of the order by id
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def phrases(text: str, seen: set[str], open_phrase: str = "") -> tuple[list[int], str]:
    """Lengths of the new phrases of a text, parsed on from ``seen`` and an unfinished phrase; the phrase left open.

    A phrase is the shortest string not seen before; it joins ``seen``.
    """
    lengths, w, add = [], open_phrase, seen.add
    for ch in text:
        w += ch
        if w not in seen:
            add(w)
            lengths.append(len(w))
            w = ""
    return lengths, w


def _power(i: int, n: int) -> np.ndarray:
    if len(_powers[i]) < n:
        size = max(n, 2 * len(_powers[i]))
        _powers[i] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _INVERSE if i else _BASE, np.uint64))])
    return _powers[i][:n]


def signature(text: str, lengths: list[int], size: int = SIZE) -> np.ndarray:
    """The smallest 32-bit hashes of the phrases that begin a text one after another with these lengths."""
    ends = np.cumsum(np.array(lengths, np.int64))
    if not len(ends):
        return np.empty(0, np.uint32)
    code = np.frombuffer(text[: ends[-1]].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(code * _power(0, len(code)))])
    starts = np.concatenate([[0], ends[:-1]])
    h = (total[ends] - total[starts]) * _power(1, len(code))[starts]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(((h ^ (h >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32))[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of common phrases of two signatures; 1 if neither has a phrase."""
    both = np.union1d(a, b)[:size]
    if not len(both):
        return 1.0
    return float(np.isin(both, a, assume_unique=True) @ np.isin(both, b, assume_unique=True).astype(float) / len(both))


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row of ``docs`` (doc_id, text); a null text counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                yield doc_id, len(text), written(signature(text, phrases(text, set())[0], size))

    return pick(docs, doc_id="long", text="string").mapInArrow(
        lambda batches: batched(rows(batches), schema, 1024), "doc_id long, n_chars long, fingerprint string"
    )


_PLACE = np.dtype([("at", "i8"), ("none", "?"), ("of", "i8")])  # id, whether it is null, hash of the text


def in_order(docs: DataFrame, characters: int = STRETCH) -> DataFrame:
    """(stretch, ahead, doc_id, text): all rows dealt out in stretches of the order by (doc_id, hash of the text, text).

    A stretch holds about ``characters`` of text, so tasks are as many as the
    text needs, and rows of one id are dealt out by their texts.  Each stretch
    ends with a copy of the next one's first row, and the last with one of the
    very first, marked ``ahead``.  The text is shuffled once.  The driver
    holds an id and a hash for each stretch.  Null ids come last.
    """
    at = F.coalesce("doc_id", F.lit(2**63 - 1)).alias("at")
    rows = pick(docs, doc_id="long", text="string").select("doc_id", "text", at, c("doc_id").isNull().alias("none"), F.xxhash64("text").alias("of"))
    total = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 64)).first()[0] or 0
    stretches = max(1, -(-total // characters))
    keys = rows.select("at", "none", "of")
    firsts = keys.repartitionByRange(stretches, "at", "none", "of").groupBy(F.spark_partition_id()).agg(F.min(F.struct("at", "none", "of")).alias("p"))
    first = np.sort(np.array([tuple(r["p"]) for r in firsts.select("p").collect()], _PLACE))
    shared = docs.sparkSession.sparkContext.broadcast(first)

    @F.pandas_udf("array<long>")
    def places(at: pd.Series, none: pd.Series, of: pd.Series) -> pd.Series:
        n, own = len(shared.value), np.empty(len(at), _PLACE)
        own["at"], own["none"], own["of"] = at, none, of
        where = np.searchsorted(shared.value, own, "right") - 1
        leads = shared.value[where] == own
        return pd.Series([[2 * i, 2 * ((i - 1) % n) + 1] if lead else [2 * i] for i, lead in zip(where.tolist(), leads.tolist())])

    placed = rows.withColumn("place", F.explode(places("at", "none", "of"))).withColumn("stretch", F.shiftright("place", 1))
    return placed.repartition("stretch").sortWithinPartitions("place", "at", "none", "of", "text").select(
        "stretch", (c("place") % 2 == 1).alias("ahead"), "doc_id", "text"
    )


def edits(docs: DataFrame, size: int = SIZE, characters: int = STRETCH) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and how near they and the next row's are.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next).  The next row is that of the next id, equal ids
    in the order of their texts, null ids last, and the first row after the
    last; the edit replaces the last half of the text (rounded down) by as
    many characters from the beginning of the next.  A null text counts as
    empty; a single row is its own next; no rows give no rows.  The first
    halves of a text and its edit are parsed once.
    """

    def parsed(text: str) -> tuple:
        cut = len(text) - len(text) // 2
        seen: set[str] = set()
        head, left = phrases(text[:cut], seen)
        more, _ = phrases(text[cut:], known := seen.copy(), left)
        del known
        return cut, head, seen, left, signature(text, head + more, size)

    def finished(doc_id: int | None, text: str, own: tuple, after: str, after_signature: np.ndarray) -> tuple:
        cut, head, seen, left, mine = own
        filled = after[: len(text) - cut]
        edited = text[:cut] + filled
        changed = signature(edited, head + phrases(filled, seen, left)[0], size)
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(mine), written(changed),
                likeness(mine, changed, size), likeness(mine, after_signature, size))

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        stretch, waiting = None, None
        for batch in batches:
            for at, ahead, doc_id, value in zip(*[batch.column(i) if i == 3 else batch.column(i).to_pylist() for i in range(4)]):
                text = value.as_py() or ""
                if at != stretch:
                    stretch, waiting = at, None
                if ahead and waiting is None:
                    continue
                own = parsed(text)
                if waiting is not None:
                    yield finished(*waiting, text, own[4])
                waiting = None if ahead else (doc_id, text, own)

    return in_order(docs, characters).mapInArrow(
        lambda batches: batched(results(batches), _OUT, 512),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def op3_lempel_ziv_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(table(spark, sf_dir, "documents"))
