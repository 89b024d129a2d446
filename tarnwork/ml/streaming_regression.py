"""Least squares by gradient steps, one update per micro-batch, weights kept as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.ml.gradient import descend
from tarnwork.session import fresh_dir
from tarnwork.streaming.sinks import run


class StreamingLinearRegression:
    """``train_on`` warm-starts every batch from the weights of the batch before."""

    def __init__(self, dims: int, step: float = 0.1, iterations: int = 10, weights: list[float] | None = None):
        self.step, self.iterations = step, iterations
        self.weights = list(weights) if weights else [0.0] * dims
        self._history: str | None = None
        self._spark = None

    def train_on(self, stream: DataFrame, checkpoint: str | None = None) -> "StreamingLinearRegression":
        self._spark = stream.sparkSession
        self._history = fresh_dir(self._spark, "stream-weights")

        def update(batch: DataFrame, number: int) -> None:
            # The batch before is read back by number, so a replayed batch starts from the same weights.
            if number > 0:
                self.weights = list(self._read(number - 1))
            rows = batch.select("label", "features").persist()
            self.weights = descend(rows, self.weights, "least_squares", "none", 0.0, self.step, self.iterations)
            rows.unpersist()
            row = self._spark.createDataFrame([(self.weights,)], "weights array<double>")
            row.write.mode("overwrite").parquet(f"{self._history}/batch={number}")

        run(stream, "append", update, checkpoint)
        return self

    def _read(self, number: int) -> list[float]:
        return self._spark.read.parquet(f"{self._history}/batch={number}").head()["weights"]

    def weight_history(self) -> DataFrame:
        """(batch, weights as text): one row per micro-batch."""
        table = self._spark.read.option("basePath", self._history).parquet(f"{self._history}/batch=*")
        return table.select("batch", F.array_join(F.transform("weights", lambda w: F.round(w, 8).cast("string")), ",").alias("weights"))

    def predict_on(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", dot(F.col("features"), self.weights))


def dot(features, weights: list[float]):
    return F.aggregate(
        F.zip_with(features, F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x
    )
