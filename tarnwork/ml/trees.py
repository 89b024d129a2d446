"""Decision trees grown a level at a time from histograms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.session import materialize

c = F.col


@dataclass(frozen=True)
class Node:
    """A node of a tree; children of node k are 2k (left) and 2k + 1.

    A row goes left if its feature is at most ``threshold``, or, for a
    category, among ``left``.  A leaf has no feature.
    """

    number: int
    rows: int
    prediction: float
    gain: float = 0.0
    feature: int | None = None
    threshold: float | None = None
    left: tuple[int, ...] = ()


def candidates(df: DataFrame, numeric: Sequence[int], bins: int, accuracy: int = 10_000) -> dict[int, list[float]]:
    """Up to ``bins`` - 1 thresholds of every numeric feature: its quantiles by one sketch each, without the largest."""
    if not numeric:
        return {}
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = df.agg(*[F.percentile_approx(c("features")[i], shares, accuracy).alias(f"q{i}") for i in numeric], *[F.max(c("features")[i]).alias(f"m{i}") for i in numeric]).head()
    return {i: sorted({float(v) for v in row[f"q{i}"] or [] if v < row[f"m{i}"]}) for i in numeric}


def _binned(df: DataFrame, splits: dict[int, list[float]], dims: int) -> DataFrame:
    """(label, bins): for a number how many thresholds lie below it, for a category itself."""
    def bin_of(i: int) -> Column:
        value = c("features")[i]
        if i not in splits:
            return value.cast("int")
        return F.size(F.filter(F.array(*[F.lit(v) for v in splits[i]]).cast("array<double>"), lambda t: t < value))

    each = [bin_of(i) for i in range(dims)]
    return df.select(c("label").cast("double"), F.array(*each).alias("bins"))


def _goes_left(node: Node, splits: dict[int, list[float]]) -> Column:
    at = c("bins")[node.feature]
    if node.feature in splits:
        return at <= splits[node.feature].index(node.threshold)
    return at.isin(*node.left)


def _best(number: int, cells: dict[int, np.ndarray], splits: dict[int, list[float]], least_rows: int, least_gain: float) -> Node:
    """The split of a node that lowers the variance of the label most; of equals the first feature and least threshold.

    ``cells``: for each feature rows (bin, n, sum, sum of squares).
    """
    some = next(iter(cells.values()))
    n, total, squares = some[:, 1].sum(), some[:, 2].sum(), some[:, 3].sum()
    mean = total / n
    found, spread = Node(number, int(n), float(mean)), squares / n - mean * mean
    best = max(least_gain, 1e-12)
    for f in sorted(cells):
        h = cells[f]
        # Categories in the order of their mean label: the best subset is a prefix (Breiman et al., 1984).
        order = np.argsort(h[:, 0]) if f in splits else np.lexsort((h[:, 0], h[:, 2] / h[:, 1]))
        h = h[order]
        left = np.cumsum(h[:, 1:], axis=0)[:-1]
        right = h[:, 1:].sum(axis=0) - left
        fits = (left[:, 0] >= least_rows) & (right[:, 0] >= least_rows)
        if not fits.any():
            continue
        part = lambda x: x[:, 2] / n - x[:, 1] ** 2 / x[:, 0] / n
        gains = np.where(fits, np.round(spread - part(left) - part(right), 12), -np.inf)
        at = int(np.argmax(gains))
        if gains[at] > best:
            best = float(gains[at])
            if f in splits:
                found = Node(number, int(n), float(mean), best, f, splits[f][int(h[at, 0])])
            else:
                found = Node(number, int(n), float(mean), best, f, None, tuple(sorted(int(x) for x in h[: at + 1, 0])))
    return found


def grow(df: DataFrame, dims: int, categories: Sequence[int] = (), depth: int = 5, bins: int = 32, least_rows: int = 1, least_gain: float = 0.0) -> dict[int, Node]:
    """A tree over (label, features array<double>), by the variance of the label (for labels 0 and 1 half of Gini's index).

    Thresholds are quantiles from one sketch of each feature, and rows are
    written once as bins.  Every level is one aggregate, a row for each node,
    feature and bin; at most 2^depth x features x bins of those come to the
    driver, whatever the rows.  Features in ``categories`` hold small whole
    numbers and are split into any two sets.  Rows with a null or not a
    number in label or features are left out; no rows give no nodes.
    """
    whole = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x)) & (F.size("features") == dims)
    clean = df.where(c("label").isNotNull() & ~F.isnan(c("label").cast("double")) & whole)
    splits = candidates(clean, [i for i in range(dims) if i not in categories], bins)
    rows = materialize(_binned(clean, splits, dims), "binned").withColumn("node", F.lit(1))
    tree: dict[int, Node] = {}
    for level in range(depth + 1):
        each = rows.select("node", "label", F.posexplode("bins").alias("feature", "bin"))
        sums = each.groupBy("node", "feature", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("s"), F.sum(c("label") * c("label")).alias("q")).collect()
        cells: dict[int, dict[int, list]] = {}
        for r in sums:
            cells.setdefault(r["node"], {}).setdefault(r["feature"], []).append((r["bin"], r["n"], r["s"], r["q"]))
        limit = least_rows if level < depth else 1 << 62  # the last level only gets its predictions
        made = [_best(k, {f: np.array(v, float) for f, v in by.items()}, splits, limit, least_gain) for k, by in sorted(cells.items())]
        tree.update((node.number, node) for node in made)
        split = [node for node in made if node.feature is not None]
        if not split:
            break
        into = F.lit(None).cast("int")
        for node in split:
            into = F.when(c("node") == node.number, F.when(_goes_left(node, splits), 2 * node.number).otherwise(2 * node.number + 1)).otherwise(into)
        rows = rows.where(c("node").isin(*[node.number for node in split])).withColumn("node", into)
    return tree


def predict(tree: dict[int, Node], number: int = 1) -> Column:
    """The prediction for a row's ``features``; an unseen category goes right."""
    node = tree[number]
    if node.feature is None:
        return F.lit(node.prediction)
    value = c("features")[node.feature]
    left = value <= node.threshold if node.threshold is not None else value.cast("int").isin(*node.left)
    return F.when(left, predict(tree, 2 * number)).otherwise(predict(tree, 2 * number + 1))


def nodes(spark, tree: dict[int, Node]) -> DataFrame:
    """(node, rows, prediction, gain, feature, threshold, left) of every node."""
    rows = [(n.number, n.rows, n.prediction, n.gain, n.feature, n.threshold, list(n.left)) for n in tree.values()]
    return spark.createDataFrame(rows, "node int, rows long, prediction double, gain double, feature int, threshold double, left array<int>")
