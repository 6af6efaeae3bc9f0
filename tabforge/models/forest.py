"""Regression forests on counted cells.

A tree of binned features sees no more of a row than its cell, the bins of its
features together. So the rows are read once for all trees: every row draws its
bootstrap count for each tree, and counts and label sums are added up by cell.
MLlib grows the trees on the cells, weighted by their counts. What a fit keeps
and passes over once a level grows with the cells, not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that a task adds up in memory (16 bytes each for every tree).
CELL_LIMIT = 1 << 16
#: Rows that the candidate cuts are taken from, as MLlib does.
CUT_ROWS = 10_000


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` midpoints between neighbouring values: all of them, or those nearest to equal counts."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) < bins:
        return middle
    below, stride, cuts = np.cumsum(counts), len(values) / bins, []
    for i in range(1, len(found)):
        target = stride * (len(cuts) + 1)
        if abs(below[i - 1] - target) < abs(below[i] - target):
            cuts.append(middle[i - 1])
    return np.array(cuts[:bins - 1])


def _cells(columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """A row's cell: its bins (x <= cut is below it) as digits of one number."""
    out = np.zeros(len(columns[0]), np.int64)
    for x, c in zip(columns, cuts, strict=True):
        out = out * (len(c) + 1) + np.searchsorted(c, x)
    return out


def _count_cells(rows: DataFrame, cuts: list[np.ndarray], trees: int, seed: int) -> DataFrame:
    """(cell, w0, s0, w1, ...): each tree's drawn rows and their sum of labels; ``rows`` holds x0, x1, ... and y."""
    size = int(np.prod([len(c) + 1 for c in cuts]))
    names = [f"{k}{t}" for t in range(trees) for k in "ws"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([abs(seed), TaskContext.get().partitionId()])
        w, s = np.zeros((trees, size), np.int64), np.zeros((trees, size))
        for batch in batches:
            *x, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if np.isnan(y).any() or not all(np.isfinite(c).all() for c in x):
                raise ValueError("labels must not be null or NaN, features must be finite numbers")
            cell, drawn = _cells(x, cuts), rng.poisson(1.0, (trees, len(y)))
            for t in range(trees):
                w[t] += np.bincount(cell, drawn[t], size).astype(np.int64)
                s[t] += np.bincount(cell, drawn[t] * y, size)
        used = np.flatnonzero(w.any(0))
        if len(used):
            sums = [pa.array(k[t][used]) for t in range(trees) for k in (w, s)]
            yield pa.RecordBatch.from_arrays([pa.array(used), *sums], ["cell", *names])

    kind = "cell long, " + ", ".join(f"{n} {'long' if n[0] == 'w' else 'double'}" for n in names)
    return rows.mapInArrow(run, kind).groupBy("cell").agg(*[F.sum(n).alias(n) for n in names])


def _bins(cell: Column, cuts: list[np.ndarray]) -> Column:
    """The digits of a cell as a feature vector."""
    digits, below = [], 1
    for c in reversed(cuts):
        digits.insert(0, F.pmod(F.floor(cell / F.lit(below)), F.lit(len(c) + 1)).cast("double"))
        below *= len(c) + 1
    return array_to_vector(F.array(*digits))


class CellForestRegressor(Estimator):
    """``forest`` on the counted cells of the rows.

    Cuts are MLlib's: from a sample of about ``CUT_ROWS`` rows, ``maxBins`` a
    feature. Bootstrap counts are Poisson draws a row and tree, as MLlib's, by
    another generator. Where the bins make more than ``CELL_LIMIT`` cells, or a
    node must hold several rows (cells do not tell), ``forest`` is fitted on the
    rows themselves.
    """

    def __init__(self, forest: RandomForestRegressor):
        super().__init__()
        self.forest = forest

    def _fit(self, dataset: DataFrame):
        f = self.forest
        at = vector_to_array(f.getFeaturesCol())
        rows = dataset.select(at.alias("x"), F.col(f.getLabelCol()).cast("double").alias("y"))
        n = rows.count()
        if not n or f.getMinInstancesPerNode() > 1:
            return f.fit(dataset)
        share = min(1.0, max(f.getMaxBins() ** 2, CUT_ROWS) / n)
        some = rows if share == 1.0 else rows.sample(share, seed=f.getSeed())
        sample = np.array([r["x"] for r in some.select("x").collect()])   # CUT_ROWS rows, about
        cuts = [cut_points(c, min(f.getMaxBins(), n)) for c in sample.T]
        size = int(np.prod([len(c) + 1.0 for c in cuts]))
        if size > CELL_LIMIT:
            return f.fit(dataset)
        trees = f.getNumTrees()
        x = [F.col("x")[j].alias(f"x{j}") for j in range(len(cuts))]
        cells = _count_cells(rows.select(*x, "y"), cuts, trees, f.getSeed()).coalesce(1).cache()    # CELL_LIMIT rows at most
        try:
            grid = dataset.sparkSession.range(size).select("id", _bins(F.col("id"), cuts).alias("features"))
            drawn = cells.agg(*[F.max(f"w{t}").alias(f"w{t}") for t in range(trees)]).first()   # one row
            grown = [t for t in range(trees) if drawn[f"w{t}"]]
            for t in grown:
                grid = self._tree(cells, cuts, t, trees).transform(grid)
            mean = sum((F.col(f"p{t}") for t in grown), F.lit(0.0)) / max(1, len(grown))
            values = np.zeros(size)
            for r in grid.select("id", mean.alias("p")).collect():     # CELL_LIMIT rows at most
                values[r["id"]] = r["p"]
        finally:
            cells.unpersist()
        return CellForestModel(cuts, values, f.getFeaturesCol(), f.getPredictionCol())

    def _tree(self, cells: DataFrame, cuts: list[np.ndarray], t: int, trees: int):
        """One tree on the cells that it drew, without a draw of its own; every bin may be cut from the next."""
        f, w = self.forest, F.col(f"w{t}")
        rows = cells.where(w > 0).select(_bins(F.col("cell"), cuts).alias("features"),
                                         (F.col(f"s{t}") / w).alias("label"), w.cast("double").alias("weight"))
        part = f.getFeatureSubsetStrategy()
        part = {True: "all", False: "onethird"}[trees == 1] if part == "auto" else part
        return RandomForestRegressor(
            numTrees=1, bootstrap=False, featureSubsetStrategy=part, maxDepth=f.getMaxDepth(), maxBins=int(CELL_LIMIT ** 0.5),
            minInfoGain=f.getMinInfoGain(), seed=f.getSeed() + t, weightCol="weight", predictionCol=f"p{t}").fit(rows)


class CellForestModel(Model):
    """The forest's mean prediction of every cell."""

    def __init__(self, cuts: list[np.ndarray], values: np.ndarray, features: str, prediction: str):
        super().__init__()
        self.cuts, self.values, self.features, self.prediction = cuts, values, features, prediction

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts, table = self.cuts, dataset.sparkSession.sparkContext.broadcast(self.values)    # CELL_LIMIT doubles at most

        @F.pandas_udf("double")
        def predict(*x: pd.Series) -> pd.Series:
            return pd.Series(table.value[_cells([c.to_numpy() for c in x], cuts)])

        at = vector_to_array(self.features)
        return dataset.withColumn(self.prediction, predict(*[at[j] for j in range(len(cuts))]))
