"""Estimators on ``pyspark.ml``.

Factories translate the reference's hyper-parameters to MLlib's objectives
(penalty scaling differs between the libraries); custom pieces are small
driver loops over distributed fits (AdaBoost), a column-expression feature
map (random Fourier features for kernel SVMs) and probability averaging on
one keyed frame (soft voting).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature columns to one vector column (rows with NULL features dropped)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


def array_features(df: DataFrame, arr: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr).cast("array<double>")))


# L1 - L3: trees ----------------------------------------------------------------------

def decision_tree(impurity: str = "gini", max_depth: int = 5, label: str = "label",
                  regression: bool = False, seed: int = 42):
    """L1: ``criterion`` -> ``impurity`` ('gini' / 'entropy'; 'variance' for regression)."""
    if regression:
        return DecisionTreeRegressor(maxDepth=max_depth, labelCol=label, seed=seed)
    return DecisionTreeClassifier(impurity=impurity, maxDepth=max_depth, labelCol=label, seed=seed)


def random_forest(n_estimators: int = 500, max_depth: int = 5, min_samples_split: int = 2,
                  label: str = "label", regression: bool = False, seed: int = 42):
    """L2: ``min_samples_split`` becomes ``minInstancesPerNode`` (a child must
    keep at least half of a splittable node, the nearest MLlib knob)."""
    kw = dict(numTrees=n_estimators, maxDepth=max_depth, labelCol=label, seed=seed,
              minInstancesPerNode=max(1, min_samples_split // 2))
    return RandomForestRegressor(**kw) if regression else RandomForestClassifier(**kw)


def gradient_boosting(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3,
                      subsample: float = 1.0, label: str = "label", regression: bool = False,
                      seed: int = 42):
    """L3: binary gradient boosting."""
    kw = dict(maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth,
              subsamplingRate=subsample, labelCol=label, seed=seed)
    return GBTRegressor(**kw) if regression else GBTClassifier(**kw)


# Linear classifiers -------------------------------------------------

def logistic(C: float, n_rows: int, label: str = "label", max_iter: int = 100, family: str = "auto"):
    """Scikit-learn ``C * sum(logloss) + 0.5 ||w||^2`` equals MLlib's
    ``mean(logloss) + regParam/2 ||w||^2`` with ``regParam = 1 / (n C)`` on
    unstandardised features."""
    return LogisticRegression(regParam=1.0 / (n_rows * C), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, labelCol=label,
                              family=family)


def linear_svc(C: float, n_rows: int, label: str = "label", max_iter: int = 100):
    """Hinge loss; ``regParam = 1 / (n C)`` (SGDClassifier's
    ``alpha = 1 / (n C)`` is the same objective)."""
    return LinearSVC(regParam=1.0 / (n_rows * C), standardization=False, maxIter=max_iter,
                     labelCol=label)


def softmax_regression(label: str = "label", max_iter: int = 100):
    """Multinomial logistic regression without penalty."""
    return LogisticRegression(family="multinomial", regParam=0.0, maxIter=max_iter, labelCol=label)


# Linear regression ----------------------------------------------------------------

def _label_std(df: DataFrame, label: str, sample: bool) -> float:
    f = F.stddev_samp if sample else F.stddev_pop
    return float(df.agg(f(F.col(label).cast("double"))).first()[0] or 0.0)


def linear(label: str = "label"):
    """L9 (and LARS on the full path)."""
    return LinearRegression(regParam=0.0, labelCol=label, solver="normal", standardization=False)


def ridge(alpha: float, df: DataFrame, label: str = "label"):
    """MLlib scales the L2 term by the label std, so
    ``regParam = alpha * std_pop(y) / n`` with ``solver='normal'``."""
    n = df.count()
    return LinearRegression(regParam=alpha * _label_std(df, label, False) / n, elasticNetParam=0.0,
                            standardization=False, solver="normal", labelCol=label)


def lasso(alpha: float = 1.0, label: str = "label", max_iter: int = 100):
    """L11 (and one-target MultiTaskLasso, LassoLars)."""
    return LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False,
                            labelCol=label, maxIter=max_iter)


def elastic_net(alpha: float, l1_ratio: float, df: DataFrame, label: str = "label",
                max_iter: int = 100):
    """``regParam = a r + a (1-r) sd_y``, ``elasticNetParam = a r / regParam``."""
    sd = _label_std(df, label, True)
    reg = alpha * l1_ratio + alpha * (1 - l1_ratio) * sd
    return LinearRegression(regParam=reg, elasticNetParam=(alpha * l1_ratio / reg) if reg else 0.0,
                            standardization=False, labelCol=label, maxIter=max_iter)


# Kernels by explicit feature maps --------------------------------------------------

def _mapped(df: DataFrame, arr: str, out: str, rows_to_features) -> DataFrame:
    """``out`` as a vector column: one matrix product for each Arrow batch of the array column."""
    @F.pandas_udf("array<double>")
    def features(x: pd.Series) -> pd.Series:
        return pd.Series(list(rows_to_features(np.vstack(x.to_numpy()).astype(np.float64)))) if len(x) else x

    return df.withColumn(out, array_to_vector(features(F.col(arr).cast("array<double>"))))


def random_fourier_features(df: DataFrame, arr: str, dim: int, gamma: float, n_components: int,
                            seed: int = 0, out: str = "rff") -> DataFrame:
    """L16 (Rahimi and Recht 2007): ``z_j = sqrt(2/D) cos(w_j . x + b_j)`` with
    ``w ~ N(0, 2 gamma)``, ``b ~ U[0, 2pi)`` approximates the RBF kernel
    ``exp(-gamma ||x - y||^2)``. The D x p projection is drawn on the driver
    from the seed (parameters, not data)."""
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, dim))
    b = rng.uniform(0.0, 2 * math.pi, size=n_components)
    return _mapped(df, arr, out, lambda x: math.sqrt(2.0 / n_components) * np.cos(x @ W.T + b))


def kernel_matrix(x: np.ndarray, z: np.ndarray, kernel: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    """``exp(-gamma ||x - z||^2)`` (rbf) or ``(gamma x.z + coef0)^degree`` (poly) of all rows of x with all of z."""
    if kernel == "poly":
        return (gamma * (x @ z.T) + coef0) ** degree
    return np.exp(-gamma * np.maximum((x * x).sum(1)[:, None] - 2 * x @ z.T + (z * z).sum(1)[None, :], 0.0))


def nystroem_features(df: DataFrame, arr: str, n_components: int, kernel: str = "rbf", gamma: float = 1.0, degree: int = 3,
                      coef0: float = 1.0, seed: int = 0, out: str = "kernel") -> DataFrame:
    """L16 (Williams and Seeger 2001): features whose dot product is the kernel, exact on the span of the landmarks.

    Landmarks are the ``n_components`` rows (all, if fewer) of least seeded hash of their content, so they do not depend
    on partitions and are the only rows that reach the driver. With the landmarks' kernel block ``K = U diag(l) U'``,
    a row's features are ``k(x, landmarks) U diag(l^-1/2)``; directions of hardly any weight are left out."""
    a = F.col(arr).cast("array<double>")
    rows = (df.where(a.isNotNull()).select(a.alias("x")).distinct()
            .orderBy(F.xxhash64(F.lit(seed), "x"), "x").limit(n_components).collect())
    z = np.array([r["x"] for r in rows], dtype=np.float64)
    values, u = np.linalg.eigh(kernel_matrix(z, z, kernel, gamma, degree, coef0))
    use = values > 1e-10 * values.max()
    root = u[:, use] / np.sqrt(values[use])
    return _mapped(df, arr, out, lambda x: kernel_matrix(x, z, kernel, gamma, degree, coef0) @ root)


def poly_features(degree: int, input_col: str = "features", out: str = "poly"):
    """L16 polynomial kernel by explicit expansion."""
    return PolynomialExpansion(degree=degree, inputCol=input_col, outputCol=out)


# L18 / L19 ------------------------------------------------------------------------------------

def gaussian_nb(label: str = "label"):
    """L18."""
    return NaiveBayes(modelType="gaussian", labelCol=label)


def mlp(n_features: int, n_classes: int, hidden: Sequence[int] = (16,), label: str = "label",
        max_iter: int = 50, seed: int = 42):
    """Sigmoid hidden layers, softmax output."""
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, n_classes], maxIter=max_iter,
                                          labelCol=label, seed=seed)


# AdaBoost (SAMME) --------------------------------------------------------------------------

def _leaf_value(node, x: Column, value) -> Column:
    """A fitted tree as one CASE expression over the feature array: ``value(class)`` of the row's leaf."""
    if node.subtreeDepth() == 0:
        return F.lit(float(value(node.prediction())))
    split = node.split()
    return F.when(F.get(x, split.featureIndex()) <= split.threshold(),
                  _leaf_value(node.leftChild(), x, value)).otherwise(_leaf_value(node.rightChild(), x, value))


def _leaf_weights(node) -> tuple[float, float]:
    """(weight of the missed training rows, weight of all) from the class weights the tree keeps in its leaves."""
    if node.subtreeDepth() == 0:
        stats = list(node.impurityStats().stats())
        return sum(stats) - stats[int(node.prediction())], sum(stats)
    sides = _leaf_weights(node.leftChild()), _leaf_weights(node.rightChild())
    return sides[0][0] + sides[1][0], sides[0][1] + sides[1][1]


class AdaBoostModel(Model):
    def __init__(self, trees, alphas, n_classes: int):
        super().__init__()
        self.trees, self.alphas, self.n_classes = trees, alphas, n_classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """One expression per class over all trees: the plan does not grow with the rounds."""
        df, x = dataset, F.col("_abx")
        if self.trees:
            df = df.withColumn("_abx", vector_to_array(F.col(self.trees[0].getFeaturesCol())))
        roots = [t._call_java("rootNode") for t in self.trees]
        arr = F.array(*[F.aggregate(F.array(*[_leaf_value(n, x, lambda c, k=k, a=a: a if c == k else 0.0)
                                              for n, a in zip(roots, self.alphas)]).cast("array<double>"),
                                    F.lit(0.0), lambda s, v: s + v) for k in range(self.n_classes)])
        df = df.withColumn("ada_score", arr).drop("_abx")
        arr = F.col("ada_score")
        return df.withColumn("prediction", (F.array_position(arr, F.array_max(arr)) - 1).cast("double"))


class AdaBoostSAMME(Estimator):
    """SAMME boosting of shallow trees with row weights.

    Each round fits a weighted tree (``weightCol``), takes the weighted error
    from the class weights in its leaves (no job of its own), and updates the
    weights by a column expression; the frame of features, label and weight is
    checkpointed every ``checkpoint_every`` rounds to cut lineage.
    """

    def __init__(self, n_estimators: int = 10, learning_rate: float = 0.5, max_depth: int = 2,
                 n_classes: int = 2, label: str = "label", checkpoint_every: int = 10, seed: int = 42):
        super().__init__()
        self.n, self.lr, self.depth, self.k = n_estimators, learning_rate, max_depth, n_classes
        self.label, self.every, self.seed = label, checkpoint_every, seed

    def _fit(self, dataset: DataFrame) -> AdaBoostModel:
        ensure_checkpoint_dir(dataset.sparkSession)
        df = dataset.select("features", F.col(self.label).cast("double").alias(self.label)).checkpoint()
        n, width = df.agg(F.count(F.lit(1)), F.max(F.size(vector_to_array("features")))).first()
        # with these known, no round looks for them again
        df = (df.withMetadata("features", {"ml_attr": {"num_attrs": width}})
              .withMetadata(self.label, {"ml_attr": {"type": "nominal", "num_vals": self.k}})
              .withColumn("_w", F.lit(1.0 / n)))
        trees, alphas = [], []
        for r in range(self.n):
            tree = DecisionTreeClassifier(maxDepth=self.depth, labelCol=self.label, weightCol="_w",
                                          seed=self.seed + r, predictionCol="_p",
                                          rawPredictionCol="", probabilityCol="").fit(df)
            missed, weight = _leaf_weights(tree._call_java("rootNode"))
            err = missed / weight
            if err >= 1.0 - 1.0 / self.k:
                break
            err = max(err, 1e-10)
            alpha = self.lr * (math.log((1 - err) / err) + math.log(self.k - 1))
            trees.append(tree)
            alphas.append(alpha)
            if err <= 1e-10:
                break
            # weights sum to 1, so the new total follows from the error: no second aggregate
            total = err * math.exp(alpha) + (1.0 - err)
            miss = (F.col("_p") != F.col(self.label)).cast("double")
            df = tree.transform(df).withColumn(
                "_w", F.col("_w") * F.exp(F.lit(alpha) * miss) / F.lit(total)).drop("_p")
            if (r + 1) % self.every == 0:
                df = df.checkpoint()
        return AdaBoostModel(trees, alphas, self.k)


# Soft voting -----------------------------------------------------------------------------

def soft_vote(models: Sequence, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Average the class-probability vectors of fitted models on one frame
    (each model's standard output columns are renamed after its transform, so
    the next model can write them again; no join), then argmax."""
    std_cols = ("prediction", "rawPrediction", "probability")
    probs = []
    for i, m in enumerate(models):
        df = m.transform(df)
        df = df.withColumnRenamed("probability", f"_vq{i}").drop(
            *[c for c in std_cols if c in df.columns])
        probs.append(vector_to_array(F.col(f"_vq{i}")))
    avg = probs[0]
    for p in probs[1:]:
        avg = F.zip_with(avg, p, lambda a, b: a + b)
    avg = F.transform(avg, lambda v: v / F.lit(float(len(probs))))
    df = df.withColumn("vote_probability", avg).drop(*[f"_vq{i}" for i in range(len(models))])
    arr = F.col("vote_probability")
    return df.withColumn(out, (F.array_position(arr, F.array_max(arr)) - 1).cast("double"))


def platt_svc(C: float, n_rows: int, label: str = "label") -> Pipeline:
    """SVC member of a soft vote: a linear SVM whose margin is calibrated into a
    probability by a one-feature logistic regression."""
    svc = linear_svc(C, n_rows, label).setRawPredictionCol("svm_raw").setPredictionCol("svm_pred")
    margin = _MarginToFeature()
    calib = LogisticRegression(featuresCol="svm_margin", labelCol=label, regParam=0.0)
    return Pipeline(stages=[svc, margin, calib])


class _MarginToFeature(Model):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        m = vector_to_array(F.col("svm_raw"))
        return dataset.withColumn("svm_margin", array_to_vector(F.array(F.get(m, 1)))).drop(
            "svm_raw", "svm_pred")

    def _fit(self, dataset):  # pragma: no cover - transformer only
        return self


def decision_line(coefficients, intercept: float) -> tuple[float, float]:
    """For a 2-feature linear classifier, the boundary ``w0 x0 + w1 x1 + b = 0``
    as ``x1 = slope * x0 + offset``."""
    w0, w1 = float(coefficients[0]), float(coefficients[1])
    if w1 == 0.0:
        return float("nan"), float("nan")
    return -w0 / w1, -float(intercept) / w1


def col_prob1(prob_col: str = "probability") -> Column:
    """Positive-class probability (index 1, not 0: a reference defect)."""
    return F.get(vector_to_array(F.col(prob_col)), 1)
