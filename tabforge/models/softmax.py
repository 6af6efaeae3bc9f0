"""Softmax regression by batch gradient steps with early stopping.

A step is one pass: every task sums the gradient of its training rows and the losses of its training and validation rows
at the present weights, the driver adds a row for each task and takes the step. So the loss that decides about stopping
costs no pass of its own, and no fit starts again from zero. The rows are packed once into matrix blocks that the executors
keep (on disk where memory is short), in at most a task a core while a task's blocks stay below ``TASK_BYTES``: a step reads
blocks, plans no query, and is bounded by the job's start. A table of up to ``ONE_TASK_BYTES`` is one partition, whose task
takes all steps itself: the same sums, one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.files import stage_table
from .boosting import feature_array
from .mlp import softmax

ONE_TASK_BYTES = 1 << 25
#: Blocks of one task of a step: below LEAST_TASK_BYTES a core gets none of its own, above TASK_BYTES cores take several tasks.
LEAST_TASK_BYTES = 1 << 24
TASK_BYTES = 1 << 27
EPSILON = 1e-7


def step_sums(x: np.ndarray, y: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, float]:
    """Sums over rows: the gradient of the cross-entropy ``-log(p_y + EPSILON)`` (taken without EPSILON) and the loss."""
    p = softmax(x @ theta)
    hit = y.astype(int)
    loss = float(-np.log(p[np.arange(len(y)), hit] + EPSILON).sum())
    p[np.arange(len(y)), hit] -= 1.0
    return x.T @ p, loss


@dataclass
class SoftmaxModel:
    """``theta``: a row of weights for the intercept, then one for each feature; ``path``: (training, validation) loss
    before each step."""

    theta: np.ndarray
    features: list[str] | str
    path: list[tuple[float, float]]

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str | None = None) -> DataFrame:
        """Adds the class and, if named, the array of probabilities; null where a feature is missing."""
        x, p = feature_array(self.features), F.col("__softmax")
        score = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(w)) for w in self.theta[1:, k]]), lambda a, w: a * w),
                             F.lit(float(self.theta[0, k])), lambda s, v: s + v) for k in range(self.theta.shape[1])]
        known = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v))
        out = df.withColumn("__softmax", F.when(known, F.array(*score)))
        out = out.withColumn("__softmax", F.transform(p, lambda v: F.exp(v - F.array_max(p))))
        out = out.withColumn("__softmax", F.transform(p, lambda v: v / F.aggregate(p, F.lit(0.0), lambda s, w: s + w)))
        out = out.withColumn(prediction, (F.array_position(p, F.array_max(p)) - 1).cast("double"))
        return out.withColumnRenamed("__softmax", probability) if probability else out.drop("__softmax")


def _descend(sums, theta: np.ndarray, eta: float, alpha: float, most_steps: int):
    """Steps until the validation loss first rises: the weights before that rise, and the path of losses."""
    best, path = theta, []
    for _ in range(most_steps):
        grad, loss, n, held, m = sums(theta)
        if not n:
            break
        penalty = 0.5 * alpha * float((theta[1:] ** 2).sum())
        now = (loss / n + penalty, held / m + penalty if m else 0.0)
        if path and m and now[1] >= path[-1][1]:
            path.append(now)
            break
        path.append(now)
        best = theta
        step = grad / n
        step[1:] += alpha * theta[1:]
        theta = theta - eta * step
    return best, path


def _blocks(rows: DataFrame, tasks: int, width: int):
    """(matrix with a column of ones, classes, part) of each batch of ``rows``, in at most ``tasks`` partitions.

    Values that single precision holds exactly, as those of a float column, are kept in it; products are taken in double.
    """
    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
                with np.errstate(over="ignore"):
                    single = x.astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (
                    (single if (single == x).all() else x).tobytes(), batch.column("y").to_numpy(zero_copy_only=False).tobytes(),
                    batch.column("part").to_numpy().tobytes())], ["x", "y", "part"])

    def block(row):
        y, part = np.frombuffer(row["y"]), np.frombuffer(row["part"], dtype=np.int32)
        kind = np.float32 if len(row["x"]) == 4 * len(y) * width else np.float64
        x = np.frombuffer(row["x"], dtype=kind).reshape(len(y), width)
        return np.column_stack([np.ones(len(y), dtype=kind), x]), y, part

    return rows.coalesce(tasks).mapInArrow(pack, "x binary, y binary, part binary").rdd.map(block)


def fit_softmax(train: DataFrame, valid: DataFrame, features: Sequence[str] | str, label: str, n_classes: int, eta: float = 0.1,
                alpha: float = 0.0, most_steps: int = 5001, seed: int = 42) -> SoftmaxModel:
    """Labels are 0 to ``n_classes`` - 1; rows with a missing feature or label are left out. Steps end at the first rise
    of the validation loss (never, without validation rows) or after ``most_steps``; weights start at seeded normals."""
    x = feature_array(features)
    rows = (train.select(x.alias("x"), F.col(label).cast("double").alias("y"), F.lit(0).alias("part"))
            .unionByName(valid.select(x.alias("x"), F.col(label).cast("double").alias("y"), F.lit(1).alias("part"))))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    folder = scratch_dir(train.sparkSession, "softmax")
    rows = stage_table(rows, folder)
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = width or 0
    theta = np.random.default_rng(seed).normal(size=(width + 1, n_classes))
    shape = theta.shape

    def matrices(pdfs):
        out = []
        for pdf in pdfs:
            if len(pdf):
                out.append((np.column_stack([np.ones(len(pdf)), np.vstack(pdf["x"].to_numpy())]), pdf["y"].to_numpy(), pdf["part"].to_numpy()))
        return out

    def sums_of(parts, theta):
        grad, totals = np.zeros(shape), np.zeros(4)
        for a, y, part in parts:
            for s in (0, 1):
                mine = part == s
                if mine.any():
                    g, loss = step_sums(a[mine], y[mine], theta)
                    grad += g if s == 0 else 0.0
                    totals[2 * s:2 * s + 2] += loss, mine.sum()
        return grad, totals

    if n * (width + 1) * 8 <= ONE_TASK_BYTES:
        def all_steps(batches):
            parts = matrices(batches)

            def sums(t):
                grad, v = sums_of(parts, t)
                return (grad, *v)
            best, path = _descend(sums, theta, eta, alpha, most_steps)
            yield pd.DataFrame({"theta": [best.ravel().tolist()], "train": [[p[0] for p in path]], "valid": [[p[1] for p in path]]})

        row = rows.coalesce(1).mapInPandas(all_steps, "theta array<double>, train array<double>, valid array<double>").first()
        best, path = (np.array(row["theta"]).reshape(shape), list(zip(row["train"], row["valid"]))) if row else (theta, [])
    else:
        size = n * (width + 1) * 8
        cores = train.sparkSession.sparkContext.defaultParallelism
        tasks = max(-(-size // TASK_BYTES), min(cores, -(-size // LEAST_TASK_BYTES)))
        blocks = _blocks(rows, int(tasks), width).persist(StorageLevel.MEMORY_AND_DISK)

        def sums(t):
            def part(parts):
                yield sums_of(parts, t)

            found = blocks.mapPartitions(part).collect()                                             # one row per task
            return (np.sum([g for g, _ in found], axis=0).reshape(shape), *np.sum([v for _, v in found], axis=0))
        try:
            best, path = _descend(sums, theta, eta, alpha, most_steps)
        finally:
            blocks.unpersist()
    return SoftmaxModel(best, features if isinstance(features, str) else list(features), path)
