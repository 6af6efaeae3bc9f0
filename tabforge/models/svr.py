"""Support vector regression on Spark: the epsilon-insensitive loss
by L-BFGS, one aggregate job per step.

Objective: ``0.5 ||w||^2 + C * sum(max(0, |y - w.x - b| - eps))``, the kink
rounded off over ``smooth`` (so the optimum is within ``C * n * smooth / 2`` of
the exact one). Kernels come as explicit features: ``random_fourier_features``
for RBF, ``poly_features`` for polynomials.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_array(df: DataFrame, features: str) -> Column:
    return F.col(features) if dict(df.dtypes)[features].startswith("array") else vector_to_array(features)


@dataclass
class SVRModel:
    """A fitted regression: ``prediction = coef . features + intercept``."""

    coef: np.ndarray
    intercept: float
    features: str
    objective: float

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        weights = F.array(*[F.lit(float(w)) for w in self.coef])
        dot = F.aggregate(F.zip_with(_as_array(df, self.features), weights, lambda x, w: x * w),
                          F.lit(0.0), lambda s, x: s + x)
        return df.withColumn(out, dot + F.lit(float(self.intercept)))


def _loss(rows: DataFrame, theta: np.ndarray, c: float, eps: float, smooth: float) -> tuple[float, np.ndarray]:
    """Objective and gradient: one row of p + 2 sums per task."""
    def part(batches):
        total, grad = 0.0, np.zeros(len(theta))
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.vstack(pdf["x"].to_numpy())
            r = x @ theta[:-1] + theta[-1] - pdf["y"].to_numpy()
            u = np.abs(r) - eps
            total += np.where(u <= 0, 0.0, np.where(u < smooth, u * u / (2 * smooth), u - smooth / 2)).sum()
            g = np.sign(r) * np.clip(u / smooth, 0.0, 1.0)
            grad[:-1] += x.T @ g
            grad[-1] += g.sum()
        yield pd.DataFrame({"loss": [total], "grad": [grad.tolist()]})

    got = rows.mapInPandas(part, "loss double, grad array<double>").collect()   # one row per task
    grad = np.sum([r["grad"] for r in got], axis=0) * c
    grad[:-1] += theta[:-1]
    return sum(r["loss"] for r in got) * c + 0.5 * float(theta[:-1] @ theta[:-1]), grad


def fit_svr(df: DataFrame, features: str = "features", label: str = "label", C: float = 1.0, eps: float = 0.1,
            max_iter: int = 100, tol: float = 1e-5, smooth: float | None = None, memory: int = 10) -> SVRModel:
    """Fit on the rows of ``df`` without NULL label; ``smooth`` defaults to 1% of the label's spread."""
    rows = df.where(F.col(label).isNotNull()).select(
        _as_array(df, features).alias("x"), F.col(label).cast("double").alias("y")).persist()
    try:
        start = rows.agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s"), F.max(F.size("x")).alias("p")).first()
        if start["p"] is None:
            raise ValueError("no rows with a label")
        smooth = smooth if smooth is not None else max(1e-9, 0.01 * (start["s"] or 0.0))
        theta = np.append(np.zeros(start["p"]), start["m"])
        value, grad = _loss(rows, theta, C, eps, smooth)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(max_iter):
            direction, held = grad.copy(), []
            for s, y in reversed(steps):
                a = (s @ direction) / (s @ y)
                direction -= a * y
                held.append(a)
            direction *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1.0, np.linalg.norm(grad))
            for (s, y), a in zip(steps, reversed(held), strict=True):
                direction += s * (a - (y @ direction) / (s @ y))
            size, slope = 1.0, grad @ direction
            while True:
                new = theta - size * direction
                new_value, new_grad = _loss(rows, new, C, eps, smooth)
                if new_value <= value - 1e-4 * size * slope or size < 1e-8:
                    break
                size /= 2
            s, y = new - theta, new_grad - grad
            if s @ y > 1e-12:
                steps = [*steps[1 - memory:], (s, y)]
            done = value - new_value <= tol * max(1.0, abs(value))
            theta, value, grad = new, new_value, new_grad
            if done:
                break
        return SVRModel(theta[:-1], float(theta[-1]), features, value)
    finally:
        rows.unpersist()
