"""Token counts of fields and sections from one encoding of the whole document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tarnwork.llm.common import batched, pick, table
from tarnwork.llm.tokens import BYTE_RANKS, ByteEncoder, encoder, vocabulary

RULES = ("largest", "first", "last")


def attribute(ends: np.ndarray, spans: np.ndarray, rule: str = "largest") -> np.ndarray:
    """The span, or -1, that each token is counted for.

    ``ends``: where the tokens end, the first beginning at 0.  ``spans``: rows
    (start, end), sorted, apart from each other, in the same unit.  A token
    that touches several spans goes to the one it shares most with, the
    earlier of equals (``largest``), or to the first or last it touches; a
    token that touches none is -1.
    """
    begins = np.concatenate([[0], ends[:-1]])
    if not len(spans):
        return np.full(len(ends), -1)
    first = np.searchsorted(spans[:, 1], begins, "right")  # the first span that ends beyond the token's begin
    last = np.searchsorted(spans[:, 0], ends, "left") - 1  # the last that begins before its end
    if rule != "last":
        out = np.where(first <= last, first, -1)
    else:
        out = np.where(first <= last, last, -1)
    if rule == "largest":
        for t in np.flatnonzero(first < last):
            near = spans[first[t] : last[t] + 1]
            shared = np.minimum(near[:, 1], ends[t]) - np.maximum(near[:, 0], begins[t])
            out[t] = first[t] + int(np.argmax(shared))
    return out


def _spans(parts: list[bytes], gap: int) -> np.ndarray:
    """Spans of the parts when they stand one after another, ``gap`` bytes apart; empty ones stay."""
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + gap)[:-1]])
    return np.stack([starts, starts + sizes], axis=1)


def token_counts(docs: DataFrame, fields: tuple[str, ...] = ("source", "lang", "text"), separator: str = " ",
                 sections: str = "text", rule: str = "largest", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_crossing, separator_tokens, <field>_tokens..., section_tokens) of every row.

    The fields are written one after another with the separator between them,
    the whole is encoded once, and each token is counted for one field by
    ``rule`` (see ``attribute``); tokens of separators alone are counted
    apart, so the counts add up to n_tokens.  section_tokens has one count
    for each line of the field ``sections``; line ends belong to no line.
    A null field counts as empty; rows with equal or null ids are counted
    each by itself; no rows give no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    path = path or vocabulary(BYTE_RANKS)
    names = ["n_tokens", "n_crossing", "separator_tokens", *[f"{f}_tokens" for f in fields]]
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in names], ("section_tokens", pa.list_(pa.int64()))])
    at = fields.index(sections)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tool = encoder(ByteEncoder, path)
        gap = len(separator.encode())
        for batch in batches:
            for doc_id, *values in zip(*[batch.column(i) for i in range(batch.num_columns)]):
                texts = [v.as_py() or "" for v in values]
                parts = [t.encode() for t in texts]
                ends = tool.ends(separator.join(texts))
                spans = _spans(parts, gap)
                full = np.flatnonzero(spans[:, 1] > spans[:, 0])
                owner = attribute(ends, spans[full], rule)
                counts = np.zeros(len(fields), np.int64)
                counts[full] = np.bincount(owner[owner >= 0], minlength=len(full))
                begins = np.concatenate([[0], ends[:-1]])
                inside = np.concatenate([spans[full, 0], spans[full, 1]])
                crossing = np.searchsorted(np.sort(inside), ends, "left") > np.searchsorted(np.sort(inside), begins, "right")
                lines = _spans(parts[at].split(b"\n"), 1) + spans[at, 0]
                held = np.flatnonzero(lines[:, 1] > lines[:, 0])
                of_line = attribute(ends, lines[held], rule)
                in_lines = np.zeros(len(lines), np.int64)
                in_lines[held] = np.bincount(of_line[of_line >= 0], minlength=len(held))
                n = len(ends)
                yield (doc_id.as_py(), n, int(crossing.sum()), int(n - counts.sum()), *counts.tolist(), in_lines.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(rows(batches), schema, 1024)

    return pick(docs, doc_id="long", **dict.fromkeys(fields, "string")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"`{n}` long" for n in names) + ", section_tokens array<long>"
    )


def op7_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
