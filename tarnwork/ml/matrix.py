"""Row matrices as (id, features array<double>) tables; entries as (i, j, v) tables.

Only objects whose size is set by the number of columns (n x n products,
n x k factors) reach the driver, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.operators.ordering import chunked_lists

c = F.col
LOCAL_COLUMNS = 4096  # widest n x n product handled on the driver (128 MiB)


def dimensions(df: DataFrame, features: str = "features") -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.max(F.size(features)).alias("cols"))


def width(df: DataFrame, features: str = "features") -> int:
    return df.select(F.size(features)).head()[0]


def _add_up(partials: DataFrame, n_slots: int = 64) -> DataFrame:
    """Element-wise sums of (i, row) arrays in two levels, so no group holds one array per partition."""

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [pdf["i"].iloc[0]], "row": [np.sum(np.stack(pdf["row"].to_numpy()), axis=0)]})

    slot = F.pmod(F.spark_partition_id(), F.lit(n_slots)).alias("_slot")
    first = partials.groupBy("i", slot).applyInPandas(total, "i int, row array<double>")
    return first.groupBy("i").applyInPandas(total, "i int, row array<double>")


def _partial_products(df: DataFrame, right: np.ndarray | None = None) -> DataFrame:
    """Per task, sum of x^T x (or x^T (x right)) as rows (i, row); row -1 holds the column sums.

    There are no more tasks, and so no more partial products, than cores.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        product = sums = None
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["features"].to_numpy()).astype(float)
            p = x.T @ (x if right is None else x @ right)
            product = p if product is None else product + p
            s = x.sum(axis=0)
            sums = s if sums is None else sums + s
        if product is not None:
            yield pd.DataFrame({"i": np.arange(-1, len(product), dtype=np.int32), "row": [sums, *product]})

    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.select("features").coalesce(cores).mapInPandas(partial, "i int, row array<double>")


def _collect_product(df: DataFrame, right: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    rows = _add_up(_partial_products(df, right)).collect()
    by_index = {r["i"]: np.array(r["row"]) for r in rows}
    return np.stack([by_index[i] for i in range(len(by_index) - 1)]), by_index[-1]


def gramian(df: DataFrame) -> DataFrame:
    """(i, j, v) of A^T A; batches are multiplied inside tasks, only n x n partials are shuffled."""
    rows = _add_up(_partial_products(df)).where("i >= 0")
    return rows.select("i", F.posexplode("row").alias("j", "v"))


def covariance(df: DataFrame) -> DataFrame:
    """(i, j, v) of the n-1 covariance matrix."""
    rows = _add_up(_partial_products(df))
    n = df.agg(F.count("*")).scalar()
    sums = rows.where("i = -1").select(F.posexplode("row").alias("k", "s"))
    entries = rows.where("i >= 0").select("i", F.posexplode("row").alias("j", "v"))
    joined = entries.join(sums.select(c("k").alias("i"), c("s").alias("si")), "i").join(sums.select(c("k").alias("j"), c("s").alias("sj")), "j")
    return joined.select("i", "j", ((c("v") - c("si") * c("sj") / n) / (n - 1)).alias("v"))


def correlation(df: DataFrame) -> DataFrame:
    """(i, j, v) of the Pearson correlation matrix; NaN where a column is constant."""
    cov = covariance(df)
    var = cov.where("i = j").select("i", c("v").alias("var"))
    joined = cov.join(var.withColumnRenamed("var", "vi"), "i").join(var.select(c("i").alias("j"), c("var").alias("vj")), "j")
    r = F.when((c("vi") > 0) & (c("vj") > 0), c("v") / F.sqrt(c("vi") * c("vj"))).otherwise(F.lit(float("nan")))
    return joined.select("i", "j", F.when(c("i") == c("j"), F.lit(1.0)).otherwise(r).alias("v"))


def _top_vectors(df: DataFrame, k: int, rounds: int | None = None, tolerance: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and vectors of A^T A.

    Up to LOCAL_COLUMNS the product is decomposed whole.  Wider, a Krylov
    space grows by one distributed product a round, kept orthogonal, until
    the k largest eigenpairs of the product within it have residuals under
    ``tolerance`` times the largest eigenvalue; if that is not so after
    ``rounds`` (300 or 3 k by default), it fails.
    """
    n = width(df)
    if n <= LOCAL_COLUMNS:
        product, _ = _collect_product(df)
        values, vectors = np.linalg.eigh((product + product.T) / 2)
        order = np.argsort(values)[::-1][:k]
        return np.maximum(values[order], 0.0), vectors[:, order]
    limit = rounds or max(300, 3 * k)
    rng = np.random.default_rng(1)
    fresh = np.linalg.qr(rng.normal(size=(n, min(n, k + 2))))[0]
    basis, images = np.empty((n, 0)), np.empty((n, 0))
    for _ in range(limit):
        image, _ = _collect_product(df, fresh)
        basis, images = np.hstack([basis, fresh]), np.hstack([images, image])
        small = basis.T @ images
        values, inside = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1][:k]
        values, inside = values[order], inside[:, order]
        left = images @ inside - (basis @ inside) * values
        if basis.shape[1] >= n or np.linalg.norm(left, axis=0).max() <= tolerance * max(values[0], 1e-300):
            return np.maximum(values, 0.0), basis @ inside
        for _twice in range(2):
            image = image - basis @ (basis.T @ image)
        q, r = np.linalg.qr(image)
        fresh = q[:, np.abs(np.diag(r)) > 1e-12 * max(values[0], 1e-300)][:, : n - basis.shape[1]]
        if not fresh.shape[1]:
            return np.maximum(values, 0.0), basis @ inside  # the space holds its own image
        fresh -= basis @ (basis.T @ fresh)
        fresh = np.linalg.qr(fresh)[0]
    raise RuntimeError(f"the {k} largest singular values have not converged after {limit} rounds")


def svd(df: DataFrame, k: int, r_cond: float = 1e-9) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(U rows (id, features), singular values, V): values under r_cond * largest are dropped."""
    values, vectors = _top_vectors(df, k)
    sigma = np.sqrt(values)
    kept = sigma > r_cond * sigma[0]
    sigma, vectors = sigma[kept], vectors[:, kept]
    return multiply(df, vectors / sigma), sigma, vectors


def principal_components(df: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(variances, n x k components) of the covariance matrix."""
    if width(df) > LOCAL_COLUMNS:
        raise ValueError(f"principal components take up to {LOCAL_COLUMNS} columns, whose covariance the driver decomposes")
    product, sums = _collect_product(df)
    n = df.count()
    cov = (product - np.outer(sums, sums) / n) / (n - 1)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(values)[::-1][:k]
    return values[order], vectors[:, order]


def multiply(df: DataFrame, right: np.ndarray) -> DataFrame:
    """Rows times a local n x k matrix, batch by batch; other columns stay."""
    keep = [f for f in df.schema if f.name != "features"]

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                out = np.stack(pdf["features"].to_numpy()).astype(float) @ right
                yield pdf[[f.name for f in keep]].assign(features=list(out))

    fields = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in keep] + ["features array<double>"])
    return df.select(*[f.name for f in keep], "features").mapInPandas(apply, fields)


def matrix_table(spark: SparkSession, m: np.ndarray) -> DataFrame:
    rows = [(int(i), int(j), float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]
    return spark.createDataFrame(rows, "i int, j int, v double")


# ---- entry form ----------------------------------------------------------------


def to_entries(df: DataFrame, row_id: str) -> DataFrame:
    return df.select(c(row_id).alias("i"), F.posexplode("features").alias("j", "v"))


def entry_dimensions(entries: DataFrame) -> DataFrame:
    return entries.agg((F.max("i") + 1).alias("rows"), (F.max("j") + 1).alias("cols"))


def entries_to_rows(entries: DataFrame, size: int = 100_000) -> DataFrame:
    """(i, chunk, entries): sparse rows as lists of (j, v) in column order, a very wide row on several lines."""
    return chunked_lists(entries, ["i"], F.struct("j", "v"), [c("j")], "entries", size)
