"""Shared by the operators: reading their columns, streaming Arrow rows, cutting text."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.session import apply_semantics, materialize

__all__ = ["DOCUMENT", "arrow_fields", "batched", "materialize", "pick", "prepare", "release", "table"]

#: The columns of documents.
DOCUMENT = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
_ARROW = {"long": pa.int64(), "string": pa.string()}


def arrow_fields(types: dict[str, str]) -> list[pa.Field]:
    return [pa.field(name, _ARROW[kind]) for name, kind in types.items()]


ROWS = 2000  # rows of an Arrow batch, so that a batch of long documents stays small


def prepare(spark: SparkSession) -> SparkSession:
    """The library's semantics, and small batches between Spark and Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    return apply_semantics(spark)


def release() -> None:
    """Give freed memory back; a worker waits for other tasks and would keep it beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns only, cast; other columns may have any names, these in another case included."""
    at = {name: df.columns.index(name) for name in types}
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{at[name]}").cast(kind).alias(name) for name, kind in types.items()])


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches; nothing is held beyond one batch."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
