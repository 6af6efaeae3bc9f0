"""AdaBoost over weighted base models: SAMME.R for classes, R2 for numbers.

SAMME.R (Zhu et al. 2009): a round fits the base classifier on the weighted rows; with its class probabilities p, a row's
weight is multiplied by ``exp(-rate (K-1)/K * sum_k c_k ln p_k)``, c being 1 for the row's class and -1/(K-1) for others,
and its score grows by ``(K-1)(ln p_k - mean ln p)``. R2 (Drucker 1997): errors e are absolute errors over the greatest;
with the weighted mean error L and b = L / (1 - L), weights are multiplied by ``b^(rate (1 - e))``, and the prediction is
the median of the models' predictions weighted by ``rate ln(1/b)``. Base models see weights, not drawn samples.

Any tree or forest of ``pyspark.ml`` with a weight column is a base model. Fitted trees are kept as arrays, so the
weights of a round and the predictions are one numpy pass over Arrow batches, and the plan does not grow with rounds.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.files import stage_table
from .boosting import feature_array

TINY = np.finfo(float).eps


@dataclass
class Flat:
    """A fitted tree as arrays: ``values`` has a row for each node, the class shares or the one prediction."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    values: list[list[float]]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        feature, threshold, left, right = (np.array(v) for v in (self.feature, self.threshold, self.left, self.right))
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.flatnonzero(left[at] >= 0)
            if not len(inner):
                return np.array(self.values)[at]
            node = at[inner]
            at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])


def flat_trees(model, classes: int | None) -> list[Flat]:
    """The trees of a fitted ``pyspark.ml`` tree or forest."""
    out = []
    for tree in (model.trees if hasattr(model, "trees") else [model]):
        flat = Flat([], [], [], [], [])

        def visit(node) -> int:
            i = len(flat.left)
            stats = list(node.impurityStats().stats())
            total = sum(stats) or 1.0
            for name, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1),
                            ("values", [float(s) / total for s in stats[:classes]] if classes else [float(node.prediction())])):
                getattr(flat, name).append(v)
            if node.subtreeDepth() > 0:
                split = node.split()
                flat.feature[i], flat.threshold[i] = split.featureIndex(), float(split.threshold())
                flat.left[i] = visit(node.leftChild())
                flat.right[i] = visit(node.rightChild())
            return i
        visit(tree._call_java("rootNode"))
        out.append(flat)
    return out


def mean_of(trees: list[Flat], x: np.ndarray) -> np.ndarray:
    """Rows x values: the forest's class shares or predictions."""
    return sum(t(x) for t in trees) / len(trees)


def log_shares(trees: list[Flat], x: np.ndarray) -> np.ndarray:
    return np.log(np.clip(mean_of(trees, x), TINY, None))


@dataclass
class AdaBoost:
    """``rounds``: the trees of each base model; ``weights``: its say in R2 (1 in SAMME.R)."""

    rounds: list[list[Flat]]
    weights: list[float]
    classes: int | None
    features: list[str] | str
    rate: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.classes:
            out = np.zeros((len(x), self.classes))
            for trees in self.rounds:
                p = log_shares(trees, x)
                out += (self.classes - 1) * (p - p.mean(axis=1, keepdims=True))
            return out
        if not self.rounds:
            return np.full((len(x), 1), np.nan)
        each = np.column_stack([mean_of(trees, x)[:, 0] for trees in self.rounds])
        order = np.argsort(each, axis=1, kind="stable")
        share = np.cumsum(np.array(self.weights)[order], axis=1)
        at = (share >= 0.5 * share[:, -1:]).argmax(axis=1)
        return np.take_along_axis(each, order[np.arange(len(x)), at][:, None], axis=1)

    def transform(self, df: DataFrame, prediction: str = "prediction", score: str | None = None) -> DataFrame:
        """Adds the class or number and, if named, the array of scores; null where a feature is missing."""
        model = self

        @F.pandas_udf("array<double>")
        def scores(x: pd.Series) -> pd.Series:
            return pd.Series(list(model.scores(np.vstack(x.to_numpy()).astype(np.float64)))) if len(x) else x

        x, s = feature_array(self.features), F.col("__ada")
        known = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v))
        width = 1 + max((f for r in self.rounds for t in r for f in t.feature), default=0)
        out = df.withColumn("__ada", F.when(known, scores(F.when(known, x).otherwise(F.array_repeat(F.lit(0.0), width)))))
        out = out.withColumn(prediction, (F.array_position(s, F.array_max(s)) - 1).cast("double") if self.classes else F.get(s, F.lit(0)))
        return out.withColumnRenamed("__ada", score) if score else out.drop("__ada")

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({**self.__dict__, "rounds": [[t.__dict__ for t in r] for r in self.rounds]})
        spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "AdaBoost":
        d = json.loads(spark.read.text(path).first()[0])
        return AdaBoost(**{**d, "rounds": [[Flat(**t) for t in r] for r in d["rounds"]]})


def class_factors(trees: list[Flat], x: np.ndarray, y: np.ndarray, classes: int, rate: float) -> np.ndarray:
    """What a SAMME.R round multiplies the weights of its rows by."""
    p = log_shares(trees, x)
    own = p[np.arange(len(y)), y.astype(int)]
    coded = own - (p.sum(axis=1) - own) / (classes - 1)
    return np.exp(-rate * (classes - 1) / classes * coded)


def fit_adaboost(df: DataFrame, features, label: str, base: Callable[[int], object], rounds: int = 200, rate: float = 0.5,
                 classes: int | None = None, seed: int = 42, every: int = 10) -> AdaBoost:
    """``base(seed)`` gives the estimator of a round (features, label and weight columns are set here). With ``classes``
    SAMME.R on labels 0 to ``classes`` - 1, else R2, which ends early when the mean error reaches one half or zero.
    Rows with a missing feature or label are left out. Weights are written every ``every`` rounds and always sum to 1
    there, so they neither vanish nor overflow."""
    x = feature_array(features)
    rows = df.select(x.alias("x"), F.col(label).cast("double").alias("y"), F.lit(1.0).alias("w0"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    folder = scratch_dir(df.sparkSession, "adaboost")
    rows = stage_table(rows, folder)
    done: list[list[Flat]] = []
    says: list[float] = []
    recent: list[tuple] = []                                     # of each round since the rows were written: trees, R2's b and scale

    def weighted(rows: DataFrame, recent: list[tuple]) -> DataFrame:
        @F.pandas_udf("double")
        def weight(x: pd.Series, y: pd.Series, w: pd.Series) -> pd.Series:
            if not len(x):
                return w
            a, t, out = np.vstack(x.to_numpy()).astype(np.float64), y.to_numpy(), w.to_numpy(dtype=np.float64).copy()
            for trees, b, scale in recent:
                if classes:
                    out *= class_factors(trees, a, t, classes, rate)
                else:
                    out *= b ** (rate * (1.0 - np.abs(mean_of(trees, a)[:, 0] - t) / scale))
            return pd.Series(np.clip(out, 1e-300, 1e300))
        return rows.withColumn("w", weight("x", "y", "w0"))

    for r in range(rounds):
        if len(recent) >= every:
            now = weighted(rows, recent)
            total = now.agg(F.sum("w")).first()[0]
            rows, recent = stage_table(now.select("x", "y", (F.col("w") / F.lit(total)).alias("w0")), folder), []
        now = weighted(rows, recent)
        train = now.select(array_to_vector("x").alias("features"), F.col("y").alias("label"), "w")
        model = base(seed + r).setFeaturesCol("features").setLabelCol("label").setWeightCol("w").fit(train)
        trees = flat_trees(model, classes)
        if classes:
            done, says, recent = [*done, trees], [*says, 1.0], [*recent, (trees, 0.0, 1.0)]
            continue

        @F.pandas_udf("double")
        def error(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series(np.abs(mean_of(trees, np.vstack(x.to_numpy()).astype(np.float64))[:, 0] - y.to_numpy())) if len(x) else y

        worst, mean = now.select("w", error("x", "y").alias("e")).agg(F.max("e"), F.sum(F.col("w") * F.col("e")) / F.sum("w")).first()
        if not worst:                                            # nothing left to learn
            done, says = [*done, trees], [*says, 1.0]
            break
        loss = mean / worst
        if loss >= 0.5:
            if not done:
                done, says = [trees], [1.0]
            break
        b = loss / (1.0 - loss)
        done, says, recent = [*done, trees], [*says, rate * math.log(1.0 / b)], [*recent, (trees, b, worst)]
    return AdaBoost(done, says, classes, features if isinstance(features, str) else list(features), rate)
