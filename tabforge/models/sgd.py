"""Stochastic gradient descent for linear models: squared, hinge and logistic loss with an L2 penalty.

Objective: ``mean(loss) + alpha / 2 ||w||^2``. An epoch is one pass: every task starts from the same weights, takes
seeded mini-batch steps over its own rows with a falling rate, and hands back its weights and rows; the driver averages
the weights by rows (one row of p + 1 numbers from each task). The rows are written once, so each epoch reads the same
partitions and a task that runs again takes the same steps.

No scaling is done here: on columns of very different size the steps diverge, as plain gradient descent does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.files import stage_table
from .boosting import feature_array

LOSSES = ("squared", "hinge", "logistic")


@dataclass
class SGDModel:
    """``decision = coef . x + intercept``; a regression predicts it, a classifier 1 where it is positive, else 0."""

    coef: np.ndarray
    intercept: float
    features: list[str] | str
    loss: str
    history: list[float]

    def decision(self) -> Column:
        weights = F.array(*[F.lit(float(w)) for w in self.coef])
        return F.aggregate(F.zip_with(feature_array(self.features), weights, lambda x, w: x * w),
                           F.lit(float(self.intercept)), lambda s, v: s + v)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        score = self.decision()
        return df.withColumn(out, score if self.loss == "squared" else (score > 0).cast("double"))


def _slope(loss: str, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Derivative of the loss by the decision; y is -1 or 1 for the classifiers."""
    if loss == "squared":
        return margin - y
    if loss == "hinge":
        return np.where(y * margin < 1.0, -y, 0.0)
    return -y / (1.0 + np.exp(np.clip(y * margin, -500, 500)))


def _value(loss: str, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    if loss == "squared":
        return 0.5 * (margin - y) ** 2
    if loss == "hinge":
        return np.maximum(0.0, 1.0 - y * margin)
    return np.logaddexp(0.0, -np.clip(y * margin, -500, 500))


def rate(schedule: str, eta0: float, alpha: float, power: float, t: int) -> float:
    """``invscaling``: eta0 / t^power; ``optimal``: 1 / (alpha (t + t0)) starting at eta0; ``constant``: eta0."""
    if schedule == "invscaling":
        return eta0 / t ** power
    if schedule == "optimal":
        return 1.0 / (alpha * (t - 1) + 1.0 / eta0)
    return eta0


def fit_sgd(df: DataFrame, features: Sequence[str] | str, label: str, loss: str = "squared", alpha: float = 1e-4,
            eta0: float = 0.01, schedule: str = "invscaling", power: float = 0.25, epochs: int = 5, batch: int = 32,
            seed: int = 42) -> SGDModel:
    """Fit on the rows whose features and label are all known; ``history`` is the objective before each epoch and at the end.

    Classes are 0 and 1 (anything above 0 is 1). An empty table gives zero weights.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss {loss} is not one of {', '.join(LOSSES)}")
    y = F.col(label).cast("double")
    x = feature_array(features)
    rows = df.select(x.alias("x"), (y if loss == "squared" else F.when(y > 0, 1.0).when(y <= 0, -1.0)).alias("y"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    rows = stage_table(rows, scratch_dir(df.sparkSession, "sgd"))
    width = len(features) if not isinstance(features, str) else int(rows.agg(F.max(F.size("x"))).first()[0] or 0)
    theta, steps, history = np.zeros(width + 1), 0, []

    def epoch(number: int, theta: np.ndarray, done: int, learn: bool):
        def run(batches):
            w, t, n, total = theta.copy(), done, 0, 0.0
            rng = np.random.default_rng([seed, number])
            with np.errstate(over="ignore", invalid="ignore"):
                for rows_ in batches:
                    if not rows_.num_rows:
                        continue
                    b = rows_.column("y").to_numpy(zero_copy_only=False)
                    # the arrays' values lie side by side
                    x = rows_.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), width)
                    a = np.column_stack([x, np.ones(len(b))])
                    total += float(_value(loss, a @ theta, b).sum())
                    n += len(b)
                    order = rng.permutation(len(b))
                    for i in range(0, len(b) if learn else 0, batch):
                        part = order[i:i + batch]
                        t += 1
                        g = a[part].T @ _slope(loss, a[part] @ w, b[part]) / len(part)
                        g[:-1] += alpha * w[:-1]
                        w -= rate(schedule, eta0, alpha, power, t) * g
            yield pa.RecordBatch.from_pydict({"w": [w.tolist()], "n": [n], "total": [total], "t": [t]})

        found = [r for r in rows.mapInArrow(run, "w array<double>, n long, total double, t long").collect() if r["n"]]
        n = sum(r["n"] for r in found)
        if not n:
            return theta, done, 0.0
        with np.errstate(over="ignore", invalid="ignore"):
            value = sum(r["total"] for r in found) / n + 0.5 * alpha * float(theta[:-1] @ theta[:-1])
        return sum(np.array(r["w"]) * (r["n"] / n) for r in found), max(r["t"] for r in found), value

    for e in range(epochs):
        theta, steps, value = epoch(e, theta, steps, True)
        history.append(value)
        if not math.isfinite(value):
            break
    history.append(epoch(epochs, theta, steps, False)[2])
    return SGDModel(theta[:-1], float(theta[-1]), features if isinstance(features, str) else list(features), loss, history)
