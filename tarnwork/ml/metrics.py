"""Evaluation of scores and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.ordering import running_totals
from tarnwork.session import materialize

c = F.col


def _ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b == 0, F.lit(empty)).otherwise(a / b)


def confusion_by_threshold(df: DataFrame, score: str = "score", label: str = "label", beta: float = 1.0) -> DataFrame:
    """One row per distinct score as threshold, with the confusion counts of "score >= threshold".

    Counts per distinct score come first; the running sums over scores are
    distributed, with no single-task window.
    """
    counts = materialize(
        df.groupBy(c(score).alias("threshold")).agg(
            F.count_if(c(label) > 0.5).alias("pos"), F.count_if(c(label) <= 0.5).alias("neg")
        ),
        "score-counts",  # scoring, often a model, then runs once
    )
    cum = running_totals(counts, [], [F.desc("threshold")], {"tp": c("pos"), "fp": c("neg")})
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    p, n = totals.select("p").scalar(), totals.select("n").scalar()
    precision, recall = _ratio(c("tp"), c("tp") + c("fp")), _ratio(c("tp"), c("p"))
    b2 = beta * beta
    return (
        cum.select("*", p.alias("p"), n.alias("n"))
        .withColumn("precision", precision).withColumn("recall", recall)
        .withColumn("fpr", _ratio(c("fp"), c("n")))
        .withColumn("f_measure", _ratio((1 + b2) * c("precision") * c("recall"), b2 * c("precision") + c("recall")))
    )


def areas(curve: DataFrame) -> DataFrame:
    """Trapezoid areas under ROC and precision-recall.

    The point before each threshold follows from its own counts, so no
    neighbouring row is needed.  The ROC starts at (0,0) and ends at (1,1);
    the precision-recall curve starts at (0,1).
    """
    tp0, fp0 = c("tp") - c("pos"), c("fp") - c("neg")
    roc = (c("fpr") - _ratio(fp0, c("n"))) * (c("recall") + _ratio(tp0, c("p"))) / 2
    pr = (c("recall") - _ratio(tp0, c("p"))) * (c("precision") + _ratio(tp0, tp0 + fp0, 1.0)) / 2
    return curve.agg(F.sum(roc).alias("area_roc"), F.sum(pr).alias("area_pr"))


def confusion_matrix(df: DataFrame, classes: list, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows actual, columns predicted, in class order."""
    return df.groupBy(label).pivot(prediction, classes).agg(F.count(F.lit(1))).na.fill(0)


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction", beta: float = 1.0) -> DataFrame:
    """(class, support, tp, fp, precision, recall, f_measure, fpr), from one grouped pass over (label, prediction)."""
    cells = df.groupBy(label, prediction).agg(F.count("*").alias("n"))
    flat = cells.select(
        F.explode(F.array(
            F.struct(c(label).alias("cls"), c("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(c(label) == c(prediction), c("n")).otherwise(0).alias("tp")),
            F.struct(c(prediction).alias("cls"), F.lit(0).cast("long").alias("support"), c("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
        )).alias("x")
    ).select("x.*")
    g = flat.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    total = cells.agg(F.sum("n")).scalar()
    b2 = beta * beta
    return (
        g.withColumn("fp", c("predicted") - c("tp")).withColumn("total", total)
        .withColumn("precision", _ratio(c("tp"), c("predicted"))).withColumn("recall", _ratio(c("tp"), c("support")))
        .withColumn("f_measure", _ratio((1 + b2) * c("precision") * c("recall"), b2 * c("precision") + c("recall")))
        .withColumn("fpr", _ratio(c("fp"), c("total") - c("support")))
    )


def weighted(classes: DataFrame) -> DataFrame:
    """Overall accuracy and class measures weighted by support."""
    w = lambda m: F.sum(c(m) * c("support")) / F.sum("support")
    return classes.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), w("precision").alias("precision"),
        w("recall").alias("recall"), w("f_measure").alias("f_measure"), w("fpr").alias("fpr"),
    )


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction", implicit: bool = False) -> DataFrame:
    """Root mean squared error; implicit ratings and predictions are first mapped to 0/1 and [0,1]."""
    y = F.when(c(label) > 0, 1.0).otherwise(0.0) if implicit else c(label)
    p = F.greatest(F.least(c(prediction), F.lit(1.0)), F.lit(0.0)) if implicit else c(prediction)
    return df.agg(F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"))


def bad_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose label is neither 0 nor 1."""
    return df.where(~c(label).isin(0, 1) | c(label).isNull())


def require_binary_labels(df: DataFrame, label: str = "label") -> DataFrame:
    if not bad_labels(df, label).isEmpty():
        raise ValueError("classification labels must be 0 or 1")
    return df
