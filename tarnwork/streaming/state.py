"""State carried from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.joins import full_outer
from tarnwork.session import fresh_dir
from tarnwork.streaming.sinks import run


def update_state_by_key(
    stream: DataFrame,
    key: str,
    batch_aggs: dict[str, Column],
    next_state: dict[str, Column],
    keep: Column | None = None,
    checkpoint: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Every batch: state' = f(what is new for the key, state), for every known key.

    ``batch_aggs`` reduce the batch per key before the shuffle; ``next_state``
    reads those columns and the old state as ``old_<name>`` (null for a new
    key, null aggregates for an idle one); keys failing ``keep`` are dropped.
    Version n of the state table is written from version n-1, so a replayed
    batch rewrites the same version.
    """
    spark = stream.sparkSession
    path = path or fresh_dir(spark, "keyed-state")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def stepped(fresh: DataFrame, old: DataFrame | None) -> DataFrame:
        if old is None:
            known = fresh.select("*", *[F.lit(None).alias(f"old_{n}") for n in next_state])
        else:
            known = full_outer(fresh, old.select(key, *[F.col(n).alias(f"old_{n}") for n in next_state]), [key], most_pairs=None)
        state = known.select(key, *[e.alias(n) for n, e in next_state.items()])
        return state.where(keep) if keep is not None else state

    def reduced(batch: DataFrame) -> DataFrame:
        return batch.groupBy(key).agg(*[a.alias(n) for n, a in batch_aggs.items()])

    def step(batch: DataFrame, number: int) -> None:
        old = spark.read.parquet(f"{path}/version={number - 1}") if number else None
        stepped(reduced(batch), old).write.mode("overwrite").parquet(f"{path}/version={number}")
        # A replay of this batch reads the version before it; what is older can go.
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={number - 2}"), True)

    run(stream, "append", step, checkpoint)
    if not files.exists(folder):
        return stepped(reduced(spark.createDataFrame([], stream.schema)), None)  # nothing has ever arrived
    versions = spark.read.option("basePath", path).parquet(f"{path}/version=*")
    # Only the newest version's files are read: version is a partition value.
    return versions.where(F.col("version") == versions.agg(F.max("version")).scalar()).drop("version")


def running_maximum(stream: DataFrame, key: str, value: str, key_type: str) -> DataFrame:
    """Per key, rows seen and largest value, kept in the state store; one output row per key and batch."""

    def step(k, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, top = state.get if state.exists else (0, float("-inf"))
        for pdf in batches:
            n, top = n + len(pdf), max(top, float(pdf[value].max()))
        state.update((n, top))
        yield pd.DataFrame({key: [k[0]], "n": [n], "top": [top]})

    return stream.groupBy(key).applyInPandasWithState(
        step, f"{key} {key_type}, n long, top double", "n long, top double", "update", "NoTimeout"
    )
