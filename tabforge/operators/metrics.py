"""Metrics and reports.

All metrics are aggregates over a keyed prediction frame (one pass, partial
aggregation); the class list of a confusion matrix is the only driver-side
data and is bounded by the number of classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import global_prefix


#: Most classes of a dense confusion matrix; more raise an error.
MAX_CLASSES = 2000


def accuracy(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """Share of rows where prediction equals truth."""
    return df.agg(F.avg((F.col(pred) == F.col(truth)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def regression_errors(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """MSE, RMSE and R^2 (``1 - SSE/SST``) in one aggregate."""
    e = F.col(pred).cast("double") - F.col(truth).cast("double")
    agg = df.agg(F.avg(e * e).alias("mse"), F.sum(e * e).alias("_sse"),
                 (F.var_pop(F.col(truth).cast("double")) * F.count(F.col(truth))).alias("_sst"))
    return agg.select("mse", F.sqrt("mse").alias("rmse"),
                      (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"))


def confusion(df: DataFrame, truth: str, pred: str, classes: Sequence | None = None,
              zero_diagonal: bool = False) -> DataFrame:
    """Dense confusion matrix in long form ``(truth, pred, n)``.

    Rows are truth (first argument). Classes present only in predictions get a
    row of their own. ``zero_diagonal`` blanks correct cells (N4).
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))
    if classes is None:
        found = (df.select(F.col(truth).alias("c")).union(df.select(F.col(pred).alias("c")))
                 .where(F.col("c").isNotNull()).distinct().limit(MAX_CLASSES + 1).collect())
        if len(found) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes: a dense matrix is not meant for these columns")
        classes = sorted(r[0] for r in found)
    tt = dict(df.dtypes)[truth]
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes],
                                 f"truth {tt}, pred {tt}")
    out = grid.join(counts.withColumn("pred", F.col("pred").cast(tt)),
                    on=["truth", "pred"], how="left").fillna(0, subset=["n"])
    return out.withColumn("n", off_diagonal("truth", "pred", "n")) if zero_diagonal else out


def off_diagonal(truth: str, pred: str, n: str):
    """The count of a cell, 0 on the diagonal."""
    return F.when(F.col(truth) == F.col(pred), F.lit(0).cast("long")).otherwise(F.col(n))


def roc_points(df: DataFrame, score: str, truth: str, positive=1) -> DataFrame:
    """ROC curve at every distinct score, descending thresholds:
    ``(threshold, tp, fp, tpr, fpr)``.

    Scores are first reduced to distinct values with per-score positive and
    negative counts (partial aggregation); the running totals use range-cut
    prefix sums (``ordering.global_prefix``), never one unpartitioned window.
    """
    pos = (F.col(truth) == F.lit(positive)).cast("long")
    per = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum(pos).alias("_p"), F.sum(F.lit(1) - pos).alias("_q"))
    tot = per.agg(F.sum("_p").alias("P"), F.sum("_q").alias("N")).first()
    P, N = tot["P"] or 0, tot["N"] or 0
    cum = global_prefix(per, ["threshold"], {"tp": F.col("_p"), "fp": F.col("_q")},
                        descending=True)
    return cum.select("threshold", F.col("tp").cast("long").alias("tp"),
                      F.col("fp").cast("long").alias("fp"),
                      F.try_divide(F.col("tp"), F.lit(P).cast("double")).alias("tpr"),
                      F.try_divide(F.col("fp"), F.lit(N).cast("double")).alias("fpr"))


def feature_importance(spark, names: Sequence[str], importances) -> DataFrame:
    """``(feature, importance)`` from a fitted tree model, sorted
    descending (bounded by the number of features)."""
    vals = [float(v) for v in importances.toArray()] if hasattr(importances, "toArray") \
        else [float(v) for v in importances]
    df = spark.createDataFrame(list(zip(names, vals)), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature"))


def top_k_features(names: Sequence[str], importances, k: int) -> list[int]:
    """Indices of the ``k`` most important features, ascending index order
    (for ``VectorSlicer``)."""
    vals = [float(v) for v in (importances.toArray() if hasattr(importances, "toArray")
                               else importances)]
    top = sorted(range(len(vals)), key=lambda i: (-vals[i], i))[:k]
    return sorted(top)


def features_above(names: Sequence[str], importances, cut: float) -> list[str]:
    """The features whose importance reaches ``cut``; the others are to be dropped."""
    return [n for n, v in zip(names, importances.toArray()) if float(v) >= cut]


def tree_dump(spark, model) -> DataFrame:
    """One row per node of the fitted tree: ``(node, depth, feature, threshold,
    left, right, prediction, impurity, samples, class_counts)``.

    ``class_counts`` (classifiers; null for regressors) are the training rows of
    each class at the node; inner nodes have a feature and a threshold, leaves
    have neither. Bounded by the nodes of one tree.
    """
    rows = []

    def visit(node, number: int, depth: int) -> int:
        """Rows of the subtree in preorder; returns the next free number."""
        stats = node.impurityStats()
        inner = node.subtreeDepth() > 0
        counts = [float(x) for x in stats.stats()] if hasattr(model, "numClasses") else None
        at = len(rows)
        rows.append(None)
        left = right = feature = threshold = None
        nxt = number + 1
        if inner:
            split = node.split()
            feature = split.featureIndex()
            threshold = float(split.threshold()) if hasattr(split, "threshold") else None
            left, nxt = nxt, visit(node.leftChild(), nxt, depth + 1)
            right, nxt = nxt, visit(node.rightChild(), nxt, depth + 1)
        rows[at] = (number, depth, feature, threshold, left, right, float(node.prediction()),
                    float(node.impurity()), int(stats.count()), counts)
        return nxt

    visit(model._call_java("rootNode"), 0, 0)
    return spark.createDataFrame(rows, "node int, depth int, feature int, threshold double, left int, right int, "
                                       "prediction double, impurity double, samples long, class_counts array<double>")


def score_summary(df: DataFrame, value: str, by: Sequence[str], larger_better: bool = False) -> DataFrame:
    """Mean, population std and worst fold value per group (the greatest for
    errors, the least for scores where larger is better)."""
    worst = F.min(value) if larger_better else F.max(value)
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                               worst.alias("worst"), F.count(F.lit(1)).alias("folds"))
