"""Sinks for bounded runs (available-now trigger); results are tables in the shared folder.

Every batch is written under its own number with overwrite, so a replayed
batch after a failure replaces itself and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.session import fresh_dir

_TRAILING = "spark.sql.streaming.noDataMicroBatches.enabled"


def run(stream: DataFrame, mode: str, each: Callable[[DataFrame, int], None], checkpoint: str | None = None, idle: bool = True) -> None:
    """Drive a stream over everything available now, one call per micro-batch.

    Without ``idle`` no batch comes that has no data: timers that are set
    anew in every batch would call for another for ever.
    """
    spark = stream.sparkSession
    trailing = spark.conf.get(_TRAILING)
    if mode == "update" or not idle:
        # In update mode a trailing batch without data would only clear state, which ends with the run.
        spark.conf.set(_TRAILING, "false")
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or fresh_dir(spark, "stream-state"))
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    spark.conf.set(_TRAILING, trailing)
    query.awaitTermination()


def append_table(stream: DataFrame, label: str = "appended", checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """Final rows only, through the exactly-once file sink."""
    spark = stream.sparkSession
    path = path or fresh_dir(spark, label)
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or fresh_dir(spark, "stream-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _begun(like: DataFrame, label: str, path: str | None = None) -> str:
    """A folder for batches that holds one without rows, so that it can be read when no other comes."""
    path = path or fresh_dir(like.sparkSession, label)
    like.write.mode("overwrite").parquet(f"{path}/batch=-1")
    return path


def _no_rows(stream: DataFrame) -> DataFrame:
    return stream.sparkSession.createDataFrame([], stream.schema)


def batch_table(stream: DataFrame, label: str, transform: Callable[[DataFrame], DataFrame], checkpoint: str | None = None,
                path: str | None = None, idle: bool = True) -> DataFrame:
    """One output slice per micro-batch, with its number in ``batch``; a run that goes on from a checkpoint gets the same ``path``."""
    spark = stream.sparkSession
    path = _begun(transform(_no_rows(stream)).limit(0), label, path)

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    run(stream, "append", write, checkpoint, idle)
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def upsert_table(stream: DataFrame, keys: list[str], label: str = "upserted", checkpoint: str | None = None) -> DataFrame:
    """Latest version of every aggregate row: changed rows per batch, newest batch wins.

    Only rows that changed are written, so a batch costs what it touched.
    """
    spark = stream.sparkSession
    path = _begun(_no_rows(stream), label)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    run(stream, "update", write, checkpoint)
    values = [c for c in stream.columns if c not in keys]
    changes = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    latest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_latest"))
    return latest.select(*keys, "_latest.*")
