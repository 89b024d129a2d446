"""Cost-balanced packing of tokenized documents into sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import batched, pick, release, table
from tarnwork.llm.tokens import WORD_BPE, WordEncoder, encoder, vocabulary

END = (2).to_bytes(4, "little")
GROUP = 512  # sequences that are balanced with each other
#: Cost of a piece of n tokens: n + QUADRATIC * n * n (attention over about 6 * 1,024 wide layers).
QUADRATIC = 1 / 6144
_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                  ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def assign(lengths: list[int], capacity: int, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; all sequences but one are full.

    Documents beyond the capacity fill sequences of their own; their rests and
    the other documents go, the costliest first, to the sequence of least cost
    that has room.  A document that fits nowhere is cut to fill the roomiest.
    """
    out, rest, sequence = [], [], 0
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            out.append((doc, k * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, doc, whole * capacity))
    full, tail = divmod(sum(n for n, _, _ in rest), capacity)
    room = np.array([capacity] * full + [tail] * (tail > 0), np.int64)
    size = room.copy()
    cost = np.zeros(len(room))
    cost[full:] = (capacity - tail) * (1 + quadratic * (capacity - tail))  # a short sequence takes less
    rest.sort(key=lambda x: (-x[0], x[1]))
    for n, doc, start in rest:
        while n:
            fits = np.flatnonzero(room >= n)
            at = int(fits[np.argmin(cost[fits])]) if len(fits) else int(np.argmax(room))
            take = min(n, int(room[at]))
            out.append((doc, start, take, sequence + at, int(size[at] - room[at])))
            room[at] -= take
            cost[at] += take * (1 + quadratic * take)
            n, start = n - take, start + take
    return out


def pack(docs: DataFrame, capacity: int = 4096, group: int = GROUP, path: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of every row of ``docs`` (doc_id, text).

    A document's tokens are its text's ids and an end id; ids are 32-bit
    little-endian.  Each task balances its documents in groups worth ``group``
    sequences, so nothing is shuffled, a task holds one group, and at most one
    sequence in a group is not full.  A null text counts as empty and yields
    the end id.  Rows with equal or null ids are packed each by itself.
    Sequence ids hold the partition and a counter; no rows give no rows.
    """
    path = path or vocabulary(WORD_BPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(WordEncoder, path)
        sequence = TaskContext.get().partitionId() << 33

        def closed(held: list[tuple[int | None, bytes]]) -> Iterator[tuple]:
            nonlocal sequence
            last = -1
            for doc, start, n, at, offset in assign([len(ids) // 4 for _, ids in held], capacity):
                doc_id, ids = held[doc]
                yield doc_id, start, n, len(ids) // 4, sequence + at, offset, ids[4 * start : 4 * (start + n)]
                last = max(last, at)
            sequence += last + 1

        def pieces() -> Iterator[tuple]:
            held, tokens = [], 0
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = words.ids(text.as_py() or b"") + END
                    held.append((doc_id, ids))
                    tokens += len(ids) // 4
                    if tokens >= group * capacity:
                        yield from closed(held)
                        held, tokens = [], 0
            yield from closed(held)

        yield from batched(pieces(), _OUT, 256)
        release()

    return pick(docs, doc_id="long", text="binary").mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )


def op6_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
