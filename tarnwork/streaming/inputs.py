"""Streaming inputs: directories of files, one or more micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.session import fresh_dir


def parquet_stream(spark: SparkSession, directory: str, pattern: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{directory}/{pattern}")


def event_time(df: DataFrame, column: str = "ts", delay: str | None = None) -> DataFrame:
    """The column as an instant.

    With a ``delay``, rows that come later than that behind the newest of the
    batches before are dropped, and state older than it goes; without one
    nothing is dropped, however the files are ordered, and a run to the end
    of its input keeps the state of all windows.
    """
    timed = df.withColumn(column, F.col(column).cast("timestamp"))
    return timed.withWatermark(column, delay) if delay else timed


def queued(frames: list[DataFrame], files_per_batch: int | None = None) -> DataFrame:
    """Tables as consecutive micro-batches of one stream, in the order given; one trigger for each.

    The file source takes files by age, so the batches are written one after
    the other, each as exactly ``files_per_batch`` files: by default as many
    as the table with most partitions has, so that each is written and read
    by as many tasks.  A table of fewer rows is filled up with empty files.
    """
    spark, schema = frames[0].sparkSession, frames[0].schema
    files = files_per_batch or max(df.rdd.getNumPartitions() for df in frames)
    path = fresh_dir(spark, "queue")
    for i, df in enumerate(frames):
        part = f"{path}/part={i:05d}"
        df.repartition(files).write.parquet(part)
        for _ in range(files - len(spark.read.schema(schema).parquet(part).inputFiles())):
            spark.createDataFrame([], schema).write.mode("append").parquet(part)
    return parquet_stream(spark, path, "part=*", schema, files)
