"""Languages of a document as a mixture, from letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import DOCUMENT, arrow_fields, batched, pick, release, table

c = F.col

SYMBOLS = 64  # 0 is anything but a letter, 1 to 26 are a to z, other letters share the rest
GRAMS = SYMBOLS**3
UNDECIDED = "und"
_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])
_PREDICTED = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()),
              pa.field("languages", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))]


@lru_cache(maxsize=1)
def _symbol_of() -> np.ndarray:
    letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    code = np.where(letters, 27 + np.arange(0x110000) % 37, 0).astype(np.uint8)
    code[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return code


def grams(text: str) -> np.ndarray:
    """Trigram numbers of a lower-cased text; runs of other signs count as one boundary.  None: no letter."""
    code = _symbol_of()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not code.any():
        return np.empty(0, np.int32)
    code = np.concatenate([[0], code, [0]]).astype(np.int32)
    code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]
    return (code[:-2] * SYMBOLS + code[1:-1]) * SYMBOLS + code[2:]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    row_of: np.ndarray  # of a trigram; the last row is for those never seen
    log_p: np.ndarray  # rows x languages


def fit(docs: DataFrame, smoothing: float = 0.5) -> Model:
    """Trigram model of every language in ``docs`` (text, lang), from all rows with both.

    The counts are summed on the executors; the driver gets one row for each
    language and trigram seen, 262,144 trigrams at most, whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                if lang not in seen:
                    seen[lang] = np.zeros(GRAMS, np.int64)
                g = grams(text.as_py())
                if len(g) > GRAMS // 8:
                    seen[lang] += np.bincount(g, minlength=GRAMS)
                else:
                    np.add.at(seen[lang], g, 1)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], schema=_COUNTS)
        release()

    rows = pick(docs, text="string", lang="string").dropna().mapInArrow(count, "lang string, gram int, n long")
    found = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    gram = found.column("gram").to_numpy()
    kinds, row = np.unique(gram, return_inverse=True)
    counts = np.zeros((len(kinds) + 1, len(languages)))
    counts[row, np.searchsorted(np.array(languages, object), found.column("lang").to_numpy()) if languages else row] = found.column("n").to_numpy()
    row_of = np.full(GRAMS, len(kinds), np.int32)
    row_of[kinds] = np.arange(len(kinds))
    smooth = counts + smoothing
    return Model(languages, row_of, np.log(smooth / smooth.sum(0)))


def _mix(p: np.ndarray, n: np.ndarray, starts: np.ndarray, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each document after so many rounds of expectation-maximisation, and their log-likelihood."""
    sizes = np.diff(np.r_[starts, len(n)])
    total = np.add.reduceat(n, starts)[:, None]
    for _ in range(rounds):
        joint = p * np.repeat(shares, sizes, axis=0)
        joint *= (n / joint.sum(1))[:, None]
        shares = np.add.reduceat(joint, starts, axis=0) / total
    mixed = (p * np.repeat(shares, sizes, axis=0)).sum(1)
    return shares, np.add.reduceat(n * np.log(mixed), starts)


def infer(model: Model, texts: list[np.ndarray], penalty: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(shares over the selected set, shares over all languages) of documents given by their trigrams, none empty.

    Languages join the set in the order of their overall shares, the best
    single language first, as long as each raises the log-likelihood by more
    than ``penalty`` times the logarithm of the number of trigrams.
    """
    k = len(model.languages)
    keys = np.concatenate([g + np.int64(i) * GRAMS for i, g in enumerate(texts)])
    keys, n = np.unique(keys, return_counts=True)
    doc, n = keys // GRAMS, n.astype(float)
    log_p = model.log_p[model.row_of[keys % GRAMS]]
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    alone = np.add.reduceat(log_p * n[:, None], starts, axis=0)
    p = np.exp(log_p)
    overall, reached = _mix(p, n, starts, np.full((len(texts), k), 1 / k), rounds)
    best = alone.argmax(1)
    every = np.arange(len(texts))
    chosen = np.zeros((len(texts), k))
    chosen[every, best] = 1
    value = alone[every, best]
    cost = penalty * np.log(np.add.reduceat(n, starts))
    order = np.where(np.arange(k) == best[:, None], 2, overall).argsort(1)[:, ::-1]
    growing = reached - value > cost  # no set beats what all languages reach
    for size in range(2, k + 1):
        at = np.flatnonzero(growing)
        if not len(at):
            break
        rows = growing[doc]
        first = np.flatnonzero(np.r_[True, np.diff(doc[rows]) > 0])
        start = np.zeros((len(at), k))
        np.put_along_axis(start, order[at, :size], 1 / size, axis=1)
        shares, reach = _mix(p[rows], n[rows], first, start, rounds)
        better = reach - value[at] > cost[at]
        won = at[better]
        chosen[won], value[won] = shares[better], reach[better]
        growing = np.zeros(len(texts), bool)
        growing[won] = True
    return chosen, overall


def predict(docs: DataFrame, model: Model, penalty: float = 3.0, rounds: int = 12, piece: int = 1 << 18,
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(``keep``, lang_pred, score, languages) of every row of ``docs`` (``keep``, text).

    lang_pred has the largest share in the selected set, ``languages``; score
    is its share when all languages may take part.  A null text, one without
    letters, or a model that has learned no language gives ``und`` and 0.
    Rows with equal or null ids are predicted each by itself; no rows give no
    rows.  Documents are worked on together up to ``piece`` trigrams.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = {name: DOCUMENT[name] for name in keep}
    schema = pa.schema([*arrow_fields(kept), *_PREDICTED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value

        def named(held: list[tuple[tuple, np.ndarray]]) -> Iterator[tuple]:
            chosen, overall = infer(learned, [g for _, g in held], penalty, rounds)
            for (row, _), share, whole in zip(held, chosen, overall):
                at = int(share.argmax())
                found = [{"lang": learned.languages[i], "share": float(share[i])} for i in np.argsort(-share, kind="stable") if share[i] > 0]
                yield *row, learned.languages[at], float(min(1.0, whole[at])), found

        def rows() -> Iterator[tuple]:
            held, size = [], 0
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    for text, *row in zip(*[column.to_pylist() for column in batch.columns]):
                        g = grams(text or "")
                        if not len(g) or not learned.languages:
                            yield *row, UNDECIDED, 0.0, []
                            continue
                        held.append((tuple(row), g))
                        size += len(g)
                        if size >= piece:
                            yield from named(held)
                            held, size = [], 0
            if held:
                yield from named(held)

        yield from batched(rows(), schema, 512)
        release()

    read = pick(docs, **{"text": "string"} | kept).select(c("text").alias("_text"), *keep)
    return read.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in kept.items()) + ", lang_pred string, score double, languages array<struct<lang: string, share: double>>")


def fold(doc_id: Column, folds: int) -> Column:
    """The document's fold by its id; a null id is in none."""
    return F.crc32(doc_id.cast("string")) % folds


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(c("doc_id"), 3) == 1, F.lit(False))
    model = fit(docs.where(~held_out))
    return predict(docs, model).withColumn("held_out", held_out)
