"""Multi-layer perceptron: any hidden layers, four activations, classes or a number, by L-BFGS.

Objective, as in the reference's library: mean loss + ``alpha / (2 n) ||W||^2`` (weights without intercepts), the loss
being half the squared error, or the cross-entropy of a softmax. A step is one job: each task runs its rows forward and
backward in Arrow batches and hands back one row with the sums of loss and gradient; the driver adds a row for each task
and takes the next step. So memory is a batch and the weights, and the shuffle is none.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.files import stage_table
from .boosting import feature_array

#: value and, from that value, slope of each activation.
ACTIVATIONS: dict[str, tuple[Callable, Callable]] = {
    "identity": (lambda z: z, lambda a: np.ones_like(a)),
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "logistic": (lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))), lambda a: a * (1.0 - a)),
}


def unpack(theta: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, intercepts) of each layer from one vector."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((theta[at:at + a * b].reshape(a, b), theta[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def start_weights(sizes: Sequence[int], activation: str, seed: int) -> np.ndarray:
    """Uniform within sqrt(6 / (in + out)) of zero (sqrt(2 / (in + out)) for logistic), from the seed."""
    rng, parts = np.random.default_rng(seed), []
    for a, b in zip(sizes, sizes[1:]):
        bound = math.sqrt((2.0 if activation == "logistic" else 6.0) / (a + b))
        parts.append(rng.uniform(-bound, bound, a * b + b))
    return np.concatenate(parts)


def forward(x: np.ndarray, theta: np.ndarray, sizes: Sequence[int], activation: str) -> list[np.ndarray]:
    """The values of all layers; the last is linear."""
    act, layers = ACTIVATIONS[activation][0], [x]
    for i, (w, b) in enumerate(unpack(theta, sizes)):
        z = layers[-1] @ w + b
        layers.append(z if i == len(sizes) - 2 else act(z))
    return layers


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss_and_gradient(x: np.ndarray, y: np.ndarray, theta: np.ndarray, sizes: Sequence[int], activation: str,
                      classes: bool) -> tuple[float, np.ndarray]:
    """Sums over the rows, without the penalty."""
    layers = forward(x, theta, sizes, activation)
    if classes:
        p = softmax(layers[-1])
        hit = y.astype(int)
        loss = float(-np.log(np.maximum(p[np.arange(len(y)), hit], 1e-300)).sum())
        delta = p
        delta[np.arange(len(y)), hit] -= 1.0
    else:
        delta = layers[-1] - y[:, None]
        loss = 0.5 * float((delta ** 2).sum())
    grads: list[np.ndarray] = []
    weights, slope = unpack(theta, sizes), ACTIVATIONS[activation][1]
    for i in reversed(range(len(weights))):
        grads = [(layers[i].T @ delta).ravel(), delta.sum(axis=0), *grads]
        if i:
            delta = (delta @ weights[i][0].T) * slope(layers[i])
    return loss, np.concatenate(grads)


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], theta: np.ndarray, max_iter: int, tol: float,
             memory: int = 10) -> tuple[np.ndarray, list[float]]:
    """L-BFGS with backtracking: the least point found and the value after each step."""
    now, grad = value(theta)
    path, held = [now], []
    for _ in range(max_iter):
        if np.abs(grad).max() <= tol:
            break
        step, scales = grad.copy(), []
        for s, y in reversed(held):
            a = (s @ step) / (s @ y)
            step -= a * y
            scales.append(a)
        step *= (held[-1][0] @ held[-1][1]) / (held[-1][1] @ held[-1][1]) if held else 1.0 / max(1.0, np.linalg.norm(grad))
        for (s, y), a in zip(held, reversed(scales), strict=True):
            step += s * (a - (y @ step) / (s @ y))
        size, slope = 1.0, grad @ step
        while True:
            new = theta - size * step
            then, new_grad = value(new)
            if then <= now - 1e-4 * size * slope or size < 1e-6:
                break
            size /= 2
        if not then < now:
            break
        if (new - theta) @ (new_grad - grad) > 1e-12:
            held = [*held[1 - memory:], (new - theta, new_grad - grad)]
        done = now - then <= tol * max(1.0, abs(now))
        theta, now, grad = new, then, new_grad
        path.append(now)
        if done:
            break
    return theta, path


@dataclass
class MLPModel:
    """``path`` is the objective after each step."""

    theta: np.ndarray
    sizes: list[int]
    activation: str
    classes: bool
    features: list[str] | str
    path: list[float]

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str | None = None) -> DataFrame:
        """Adds the class or number and, if named, the array of class probabilities; null where a feature is missing."""
        model = self

        @F.pandas_udf("array<double>")
        def outputs(x: pd.Series) -> pd.Series:
            if not len(x):
                return x
            z = forward(np.vstack(x.to_numpy()).astype(np.float64), model.theta, model.sizes, model.activation)[-1]
            return pd.Series(list(softmax(z) if model.classes else z))

        x = feature_array(self.features)
        known = x.isNotNull() & (F.size(x) == self.sizes[0]) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v))
        zeros = F.array_repeat(F.lit(0.0), self.sizes[0])
        p = F.col("__mlp")
        out = df.withColumn("__mlp", F.when(known, outputs(F.when(known, x).otherwise(zeros))))
        best = (F.array_position(p, F.array_max(p)) - 1).cast("double") if self.classes else F.get(p, F.lit(0))
        out = out.withColumn(prediction, best)
        return out.withColumnRenamed("__mlp", probability) if probability else out.drop("__mlp")

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({**self.__dict__, "theta": self.theta.tolist()})
        spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "MLPModel":
        d = json.loads(spark.read.text(path).first()[0])
        return MLPModel(**{**d, "theta": np.array(d["theta"])})


def fit_mlp(df: DataFrame, features: Sequence[str] | str, label: str, hidden: Sequence[int] = (100,), activation: str = "relu",
            n_classes: int | None = None, alpha: float = 1e-4, max_iter: int = 200, tol: float = 1e-4, seed: int = 42) -> MLPModel:
    """Fit on the rows whose features and label are all known: a classifier of labels 0 to ``n_classes`` - 1, or a
    regression without ``n_classes``. The rows are written once and read by every step. No rows: an error."""
    if activation not in ACTIVATIONS:
        raise ValueError(f"activation {activation} is not one of {', '.join(ACTIVATIONS)}")
    x = feature_array(features)
    rows = df.select(x.alias("x"), F.col(label).cast("double").alias("y"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    rows = stage_table(rows, scratch_dir(df.sparkSession, "mlp"))
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        raise ValueError("no rows with a label and all features")
    sizes = [int(width), *hidden, n_classes or 1]
    mask = np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in zip(sizes, sizes[1:])])

    def value(theta: np.ndarray) -> tuple[float, np.ndarray]:
        def part(batches):
            total, grad = 0.0, np.zeros(len(theta))
            for pdf in batches:
                if len(pdf):
                    a, b = loss_and_gradient(np.vstack(pdf["x"].to_numpy()), pdf["y"].to_numpy(), theta, sizes, activation, n_classes is not None)
                    total, grad = total + a, grad + b
            yield pd.DataFrame({"loss": [total], "grad": [grad.tolist()]})

        got = rows.mapInPandas(part, "loss double, grad array<double>").collect()            # one row per task
        w = theta * mask
        return (sum(r["loss"] for r in got) / n + 0.5 * alpha / n * float(w @ w),
                np.sum([r["grad"] for r in got], axis=0) / n + alpha / n * w)

    theta, path = minimise(value, start_weights(sizes, activation, seed), max_iter, tol)
    return MLPModel(theta, sizes, activation, n_classes is not None, features if isinstance(features, str) else list(features), path)
