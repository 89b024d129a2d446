"""Least squares with a penalty: mean squared error + reg * |w| or + reg / 2 * w^2, free intercept."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_penalised(df: DataFrame, penalty: str, reg: float) -> LinearRegressionModel:
    """``df`` has a label and a features vector; penalty is l1 or l2.

    The estimator minimises half the mean squared error and, for l2, scales
    its penalty by the label's deviation; both factors are undone here.
    """
    if penalty == "l1":
        amount, mix = reg / 2, 1.0
    elif penalty == "l2":
        amount, mix = reg / 2 * df.agg(F.stddev_samp("label")).head()[0], 0.0
    else:
        raise ValueError("penalty must be l1 or l2")
    return LinearRegression(
        regParam=amount, elasticNetParam=mix, standardization=False, solver="l-bfgs", maxIter=500, tol=1e-13
    ).fit(df)
