"""Second-order gradient boosting: regularised trees on gradient and hessian histograms.

Features are cut once at (weighted) quantiles into at most 255 bins and the binned rows are written to the shared
folder, one byte for each feature. A round grows one tree for each class, level by level; a level is one job: every
task sums gradients, hessians and rows by (class, node, feature, bin) over its rows with numpy, one shuffle by feature adds
the tasks' cells, running sums over the bins give every cut's gain, and the best splits of each node reach the driver.
So a level costs one pass over the bytes whatever the depth, and neither rows nor histograms are collected.

Rows are never joined or renumbered: a row's node follows from its bins and the tree so far, its margin from the trees
since the binned rows were last written (every ``every`` rounds). Missing values (null or NaN) have a bin of their own
and go to the side of the better gain. Row and feature sampling are functions of the row's content, the round and the
seed, so a task that runs again draws the same rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.files import stage_table

OBJECTIVES = ("reg:squarederror", "binary:logistic", "multi:softmax")
MOST_BINS = 255
#: Cells of a task's histograms; a level with more is done in several jobs.
MOST_CELLS = 1 << 22
#: Bytes of binned rows up to which they are one partition, whose task then searches the cuts itself.
ONE_TASK_BYTES = 1 << 22
#: Bytes of binned rows that a task takes at least, and at most if cores take several: tasks, so the cells that they
#: send, do not become more with the input until all cores are full of work.
LEAST_TASK_BYTES = 1 << 22
TASK_BYTES = 1 << 28


@dataclass
class Params:
    """Names and defaults of the usual boosting parameters; ``reg_lambda`` and ``reg_alpha`` are the leaf penalties."""

    objective: str = "reg:squarederror"
    n_estimators: int = 100
    eta: float = 0.3
    max_depth: int = 6
    gamma: float = 0.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    max_bins: int = MOST_BINS
    n_classes: int = 2
    base_score: float = 0.5
    early_stopping_rounds: int | None = None
    seed: int = 42

    def outputs(self) -> int:
        return self.n_classes if self.objective == "multi:softmax" else 1

    def base_margin(self) -> float:
        if self.objective == "binary:logistic":
            return math.log(self.base_score / (1.0 - self.base_score))
        return self.base_score


@dataclass
class Tree:
    """Nodes by number; ``left`` is -1 for a leaf. A row goes left if its value is below ``cut`` (``bin`` or less)."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    missing_left: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("cut", 0.0), ("missing_left", 0), ("left", -1), ("right", -1),
                        ("value", value), ("gain", 0.0), ("cover", cover)):
            getattr(self, name).append(v)
        return len(self.value) - 1

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row (bins, 0 = missing) has reached."""
        feature, cut, miss, left, right = (np.array(x) for x in (self.feature, self.bin, self.missing_left, self.left, self.right))
        at = np.zeros(len(bins), dtype=np.int64)
        while True:
            inner = np.flatnonzero(left[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            b = bins[inner, feature[node]]
            goes_left = np.where(b == 0, miss[node] == 1, b <= cut[node])
            at[inner] = np.where(goes_left, left[node], right[node])

    def values_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf values of raw rows (NaN = missing)."""
        feature, cut, miss, left, right, value = (np.array(v) for v in (
            self.feature, self.cut, self.missing_left, self.left, self.right, self.value))
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.flatnonzero(left[at] >= 0)
            if not len(inner):
                return value[at]
            node = at[inner]
            v = x[inner, feature[node]]
            goes_left = np.where(np.isnan(v), miss[node] == 1, v < cut[node])
            at[inner] = np.where(goes_left, left[node], right[node])

    def prune(self, gamma: float) -> None:
        """Bottom-up: a split of less gain than ``gamma`` whose sides are leaves becomes a leaf."""
        for i in reversed(range(len(self.left))):
            a, b = self.left[i], self.right[i]
            if a >= 0 and self.left[a] < 0 and self.left[b] < 0 and self.gain[i] < gamma:
                self.left[i] = self.right[i] = self.feature[i] = -1
                self.gain[i] = 0.0


# ---------------------------------------------------------------- losses

def probabilities(margin: np.ndarray, objective: str) -> np.ndarray:
    """Rows x outputs of margins to values, probabilities of class 1, or of all classes."""
    if objective == "binary:logistic":
        return 1.0 / (1.0 + np.exp(-margin))
    if objective == "multi:softmax":
        e = np.exp(margin - margin.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    return margin


def gradients(margin: np.ndarray, y: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss by margin, rows x outputs."""
    p = probabilities(margin, objective)
    if objective == "multi:softmax":
        hit = y[:, None] == np.arange(margin.shape[1])[None, :]
        return p - hit, np.maximum(2.0 * p * (1.0 - p), 1e-16)
    if objective == "binary:logistic":
        return p - y[:, None], np.maximum(p * (1.0 - p), 1e-16)
    return p - y[:, None], np.ones_like(p)


def losses(margin: np.ndarray, y: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    """For each row the loss of the evaluation list (squared error or log loss) and the error of the class (0 or 1)."""
    p = probabilities(margin, objective)
    if objective == "reg:squarederror":
        return (p[:, 0] - y) ** 2, np.zeros(len(y))
    if objective == "binary:logistic":
        q = np.clip(np.where(y == 1, p[:, 0], 1 - p[:, 0]), 1e-16, None)
        return -np.log(q), ((p[:, 0] > 0.5) != (y == 1)).astype(float)
    q = np.clip(p[np.arange(len(y)), y.astype(int)], 1e-16, None)
    return -np.log(q), (p.argmax(axis=1) != y).astype(float)


def leaf_value(g: float, h: float, p: Params) -> float:
    """-T(G) / (H + lambda), T the soft threshold of alpha."""
    t = math.copysign(max(abs(g) - p.reg_alpha, 0.0), g)
    return -t / (h + p.reg_lambda) if h + p.reg_lambda > 0 else 0.0


# ---------------------------------------------------------------- model

@dataclass
class BoostedTrees:
    """``rounds[r][k]`` is the tree of output k; ``evals`` holds (round, set, loss, error), best_round is 0-based."""

    params: Params
    features: list[str] | str
    width: int
    rounds: list[list[Tree]]
    evals: list[tuple[int, str, float, float]]
    best_round: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full((len(x), self.params.outputs()), self.params.base_margin())
        for trees in self.rounds[:self.best_round + 1]:
            for k, t in enumerate(trees):
                out[:, k] += t.values_of(x)
        return out

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str | None = None) -> DataFrame:
        """Adds the class or value of each row and, if named, an array of its probabilities (or the value)."""
        model, objective = self, self.params.objective

        @F.pandas_udf("array<double>")
        def scores(x: pd.Series) -> pd.Series:
            rows = _matrix(x, model.width)
            p = probabilities(model.margins(rows), objective)
            if objective == "binary:logistic":
                p = np.column_stack([1 - p[:, 0], p[:, 0]])
            return pd.Series(list(p))

        p = "__boost_p"
        out = df.withColumn(p, scores(feature_array(self.features)))
        best = F.get(p, F.lit(0)) if objective == "reg:squarederror" else (
            F.array_position(p, F.array_max(p)) - 1).cast("double")
        out = out.withColumn(prediction, best)
        return out.withColumnRenamed(p, probability) if probability else out.drop(p)

    def importance(self, kind: str = "gain") -> dict[int, float]:
        """By feature: total ``gain``, number of splits (``weight``) or total ``cover``; features never split are absent."""
        out: dict[int, float] = {}
        for t in (t for trees in self.rounds[:self.best_round + 1] for t in trees):
            for i, f in enumerate(t.feature):
                if f >= 0:
                    out[f] = out.get(f, 0.0) + {"gain": t.gain[i], "weight": 1.0, "cover": t.cover[i]}[kind]
        return out

    def dump(self) -> list[tuple[int, int, int, int, float, int, int, float, float]]:
        """(round, output, node, feature, cut, left, right, value, gain) of every node that a row can reach."""
        out = []
        for r, trees in enumerate(self.rounds[:self.best_round + 1]):
            for k, t in enumerate(trees):
                todo = [0]
                while todo:
                    i = todo.pop()
                    out.append((r, k, i, t.feature[i], t.cut[i], t.left[i], t.right[i], t.value[i], t.gain[i]))
                    todo += [j for j in (t.right[i], t.left[i]) if j >= 0]
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps(asdict(self))
        spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedTrees":
        d = json.loads(spark.read.text(path).first()[0])
        return BoostedTrees(Params(**d["params"]), d["features"], d["width"], [[Tree(**t) for t in r] for r in d["rounds"]],
                            [tuple(e) for e in d["evals"]], d["best_round"])


def feature_array(features: Sequence[str] | str) -> Column:
    """An array<double> of the named columns, or of the one array column."""
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in features])


def _matrix(x, width: int) -> np.ndarray:
    """Rows of arrays (null, or holding nulls) as a float matrix with NaN for what is missing."""
    if len(x) and all(v is not None and len(v) == width and v.dtype == np.float64 for v in x):
        return np.concatenate(list(x)).reshape(len(x), width)
    out = np.full((len(x), width), np.nan)
    for i, row in enumerate(x):
        if row is not None:
            row = np.asarray(row, dtype=np.float64)
            out[i, :len(row)] = row[:width]
    return out


# ---------------------------------------------------------------- Arrow columns

def _column_matrix(x: pa.Array, width: int) -> np.ndarray:
    """``_matrix`` of an Arrow column; arrays all of ``width`` lie side by side."""
    if not x.null_count and (np.diff(x.offsets.to_numpy()) == width).all():
        return x.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(x), width)
    return _matrix(x.to_pandas(), width)


def _bytes_matrix(x: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` bytes."""
    if not width or not len(x):
        return np.zeros((len(x), width), dtype=np.uint8)
    start = np.frombuffer(x.buffers()[1], dtype=np.int32)[x.offset]
    return np.frombuffer(x.buffers()[2], dtype=np.uint8)[start:start + len(x) * width].reshape(len(x), width)


def _bytes_column(rows: np.ndarray) -> pa.Array:
    """A binary value of each row of bytes."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _list_column(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())


# ---------------------------------------------------------------- bins

def quantile_cuts(df: DataFrame, x: str, width: int, max_bins: int, weight: str | None = None) -> list[np.ndarray]:
    """Ascending cuts of each feature, at most ``max_bins`` - 1, the last bin open; weighted if ``weight`` is given.

    One pass of mergeable quantile sketches. With weights the sketch is finer, and a second pass sums the weights
    between its points (``max_bins`` x 8 x features cells at most); cuts are then set at equal shares of the weight.
    """
    if not width:
        return []
    points = max_bins * (8 if weight else 1)
    probs = [i / points for i in range(1, points)]
    found = df.agg(*[F.percentile_approx(F.when(~F.isnan(F.get(x, F.lit(i))), F.get(x, F.lit(i))), probs, max(10_000, 4 * points))
                     .alias(f"q{i}") for i in range(width)]).first()
    cuts = [np.unique(np.array(q or [], dtype=np.float64)) for q in found]
    if weight is None:
        return cuts
    fine = cuts

    def part(batches):
        sums = [np.zeros(len(c) + 1) for c in fine]
        for pdf in batches:
            rows, w = _matrix(pdf["x"], width), pdf["w"].to_numpy(dtype=np.float64)
            for f, c in enumerate(fine):
                ok = ~np.isnan(rows[:, f])
                sums[f] += np.bincount(np.searchsorted(c, rows[ok, f], side="right"), weights=w[ok], minlength=len(c) + 1)
        for f, s in enumerate(sums):
            yield pd.DataFrame({"f": np.int32(f), "b": np.arange(len(s), dtype=np.int32), "w": s})

    total = (df.select(F.col(x).alias("x"), F.col(weight).cast("double").alias("w")).mapInPandas(part, "f int, b int, w double")
             .groupBy("f", "b").agg(F.sum("w").alias("w")).collect())
    out = []
    for f, c in enumerate(fine):
        w = np.zeros(len(c) + 1)
        for r in total:
            if r["f"] == f:
                w[r["b"]] = r["w"]
        below = np.cumsum(w)[:-1]                                    # weight below each point
        want = np.arange(1, max_bins) * w.sum() / max_bins
        out.append(np.unique(c[np.minimum(np.searchsorted(below, want), len(c) - 1)]) if len(c) else c)
    return out


def _binned(df: DataFrame, cuts: list[np.ndarray], outputs: int, base: float) -> DataFrame:
    """bins binary (a byte for each feature, 0 = missing), y, w, part, rid, margin array."""
    width = len(cuts)
    schema = "bins binary, y double, w double, part int, rid long, margin array<double>"

    def run(batches):
        for rb in batches:
            rows = _column_matrix(rb.column("x"), width)
            bins = np.zeros(rows.shape, dtype=np.uint8)
            for f, c in enumerate(cuts):
                ok = ~np.isnan(rows[:, f])
                bins[ok, f] = np.searchsorted(c, rows[ok, f], side="right") + 1
            yield pa.RecordBatch.from_arrays(
                [_bytes_column(bins), *[rb.column(c) for c in ("y", "w", "part", "rid")], _list_column(np.full((len(rows), outputs), base))],
                ["bins", "y", "w", "part", "rid", "margin"])

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- training

def _drawn(rid: np.ndarray, seed: int, r: int, share: float) -> np.ndarray:
    """Which rows round ``r`` takes: a function of the row's hash, the seed and the round."""
    v = rid.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))
    for s, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        v = (v ^ v >> np.uint64(s)) * np.uint64(m)
    return (v ^ v >> np.uint64(31)) >> np.uint64(11) < np.uint64(int(share * (1 << 53)))


def _margins(rb: pa.RecordBatch, bins: np.ndarray, recent: list[list[Tree]]) -> np.ndarray:
    out = rb.column("margin").flatten().to_numpy(zero_copy_only=False).reshape(len(bins), -1).copy()
    for trees in recent:
        for k, t in enumerate(trees):
            out[:, k] += np.array(t.value)[t.nodes_of(bins)]
    return out


_CELLS = "k int, node int, f int, cells binary"
_BEST = "k int, node int, gain double, f int, b int, missing_left int, gl double, hl double, g double, h double, n double"


def _level(data: DataFrame, p: Params, width: int, r: int, recent: list[list[Tree]], growing: list[Tree],
           frontier: list[tuple[int, int]], columns: list[np.ndarray], score: bool, bins_n: int, search: bool) -> DataFrame:
    """The cells of one level: for (output, node) of ``frontier`` and each feature a row with the sums of all bins (g and h
    as doubles, rows as 32-bit integers); losses as k = -1, in bin 0, if asked.

    With ``search``, of a table in one partition, the best cuts themselves.
    """
    outputs, objective = p.outputs(), p.objective
    place = {kn: i for i, kn in enumerate(frontier)}

    def run(batches):
        sums = np.zeros((3, len(frontier) * width * bins_n))
        scores: dict[int, np.ndarray] = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            bins = _bytes_matrix(rb.column("bins"), width)
            y, w, part = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "part"))
            margin = _margins(rb, bins, recent)
            if score:
                loss, miss = losses(margin, y, objective)
                for s in np.unique(part):
                    mine = part == s
                    scores[int(s)] = scores.get(int(s), np.zeros(3)) + np.array(
                        [(loss * w)[mine].sum(), (miss * w)[mine].sum(), w[mine].sum()])
            use = part == 0
            if p.subsample < 1.0:
                use &= _drawn(rb.column("rid").to_numpy(zero_copy_only=False), p.seed, r, p.subsample)
            if not use.any() or not frontier:
                continue
            bins, w = bins[use], w[use]
            g, h = gradients(margin[use], y[use], objective)
            for k in range(outputs):
                at = growing[k].nodes_of(bins)
                slot = np.full(len(growing[k].value), -1)
                for (kk, node), i in place.items():
                    if kk == k:
                        slot[node] = i
                where = slot[at]
                ok = where >= 0
                if not ok.any():
                    continue
                cols = columns[k]
                cell = ((where[ok, None] * width + cols[None, :]) * bins_n + bins[ok][:, cols]).ravel()
                for row, v in enumerate((g[ok, k] * w[ok], h[ok, k] * w[ok], np.ones(int(ok.sum())))):
                    sums[row] += np.bincount(cell, weights=np.repeat(v, len(cols)), minlength=sums.shape[1])
        kn = np.array(frontier, dtype=np.int32).reshape(-1, 2)
        if search:
            if len(kn):
                knf = np.column_stack([np.repeat(kn, width, axis=0), np.tile(np.arange(width), len(kn))])
                drawn = np.concatenate([np.isin(np.arange(width), columns[k]) for k, _ in frontier])
                yield _batch(best_cuts(knf[drawn], sums.reshape(3, -1, bins_n)[:, drawn], p))
            for s, v in scores.items():
                yield _batch(pd.DataFrame([(-1, s, 0.0, 0, 0, 0, 0.0, 0.0, *v)], columns=list(_TYPES)))
            return
        sums = sums.reshape(3, -1, bins_n)
        full = np.flatnonzero(sums[2].any(axis=1))
        keys = [np.append(kn[full // max(1, width), c], np.array(lost, dtype=np.int32)) for c, lost in (
            (0, [-1] * len(scores)), (1, list(scores)))]
        lost = np.zeros((3, len(scores), bins_n))
        for i, v in enumerate(scores.values()):
            lost[:2, i, 0] = v[:2]
            lost[0, i, 1] = v[2]                                  # a weight need not be whole
        cells = np.concatenate([sums[:, full], lost], axis=1)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int32()) for c in keys], pa.array(np.append(full % max(1, width), np.zeros(len(scores))).astype(np.int32)),
             _bytes_column(np.concatenate([cells[0].view(np.uint8), cells[1].view(np.uint8), cells[2].astype(np.int32).view(np.uint8)], axis=1))],
            ["k", "node", "f", "cells"])

    return data.mapInArrow(run, _BEST if search else _CELLS)


_TYPES = dict(x.split() for x in _BEST.split(", "))


def _batch(found: pd.DataFrame) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "double": pa.float64()}
    return pa.RecordBatch.from_arrays([pa.array(found[c].to_numpy(), kinds[t]) for c, t in _TYPES.items()], list(_TYPES))


def best_cuts(knf: np.ndarray, sums: np.ndarray, p: Params) -> pd.DataFrame:
    """The best cut of each (k, node) over the features given.

    ``knf``: (k, node, f) of each group, ``sums``: 3 x groups x bins of g, h and rows, bin 0 for missing values. Left of
    the cut behind bin b are bins 1 to b, the missing values on either side. The gain is
    T(GL)^2/(HL+l) + T(GR)^2/(HR+l) - T(G)^2/(H+l); ties go to the least feature, then the least bin. Without a cut that
    ``min_child_weight`` allows the gain is 0. k = -1 marks sums of losses, which pass through.
    """
    t = lambda g: np.maximum(np.abs(g) - p.reg_alpha, 0.0)

    def score(g, h):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + p.reg_lambda > 0, t(g) ** 2 / (h + p.reg_lambda), 0.0)

    parts = []
    step = max(1, (1 << 18) // sums.shape[2])
    for i in range(0, len(knf), step):
        v = sums[:, i:i + step]
        total, missing, below = v.sum(axis=2)[..., None], v[..., :1], np.cumsum(v[..., 1:], axis=2)
        best = None
        for to_left in (0, 1):
            here = below + missing * to_left
            right = total - here
            fits = (here[2] > 0) & (right[2] > 0) & (here[1] >= p.min_child_weight) & (right[1] >= p.min_child_weight)
            gain = np.where(fits, score(here[0], here[1]) + score(right[0], right[1]) - score(total[0], total[1]), -np.inf)
            gain = gain.astype(np.float32)                    # so that the order of sums hardly ever decides between equals
            at = gain.argmax(axis=1)
            row = np.arange(len(at))
            found = np.column_stack([np.maximum(gain[row, at], 0.0), at + 1, np.full(len(at), to_left), here[0, row, at], here[1, row, at]])
            best = found if best is None else np.where((found[:, 0] > best[:, 0])[:, None], found, best)
        parts.append(np.column_stack([knf[i:i + step], best, total[..., 0].T]))
    names = ["k", "node", "f", "gain", "b", "missing_left", "gl", "hl", "g", "h", "n"]
    out = pd.DataFrame(np.concatenate(parts) if parts else np.empty((0, len(names))), columns=names)
    return _first_of_node(out).astype({c: np.int32 for c in ("k", "node", "f", "b", "missing_left")})


def _first_of_node(found: pd.DataFrame) -> pd.DataFrame:
    ordered = found.sort_values(["k", "node", "gain", "f", "b"], ascending=[True, True, False, True, True])
    return ordered.groupby(["k", "node"], as_index=False).first()[[x.split()[0] for x in _BEST.split(", ")]]


def _best_splits(cells: DataFrame, p: Params, bins: int) -> list[dict]:
    """One row for each (k, node): the best cut and the node's sums.

    Tasks have summed their cells, so these go straight to the tasks that search the features: one shuffle, and a row
    for each node and task comes back.
    """
    def search(batches):
        place, sums = {}, np.zeros((3, 64, bins))
        for rb in batches:
            keys = list(zip(*(rb.column(c).to_pylist() for c in ("k", "node", "f"))))
            raw = _bytes_matrix(rb.column("cells"), 20 * bins)
            at = np.array([place.setdefault(key, len(place)) for key in keys], dtype=np.int64)
            if len(place) > sums.shape[1]:
                sums = np.concatenate([sums, np.zeros((3, len(place), bins))], axis=1)
            for row, (a, b, kind) in enumerate(((0, 8, np.float64), (8, 16, np.float64), (16, 20, np.int32))):
                np.add.at(sums[row], at, np.ascontiguousarray(raw[:, a * bins:b * bins]).view(kind))
        lost = [(s, sums[:, i]) for (k, s, _), i in place.items() if k == -1]
        for s, v in lost:
            yield _batch(pd.DataFrame([(-1, s, 0.0, 0, 0, 0, 0.0, 0.0, v[0, 0], v[1, 0], v[0, 1])], columns=list(_TYPES)))
        knf = np.array([key for key in place if key[0] >= 0], dtype=np.int64).reshape(-1, 3)
        if len(knf):
            yield _batch(best_cuts(knf, sums[:, [i for key, i in place.items() if key[0] >= 0]], p))

    found = cells.repartition("k", "node", "f").mapInArrow(search, _BEST).toPandas()
    return _first_of_node(found).to_dict("records")


def fit_boosted(train: DataFrame, features: Sequence[str] | str, label: str, params: Params, weight: str | None = None,
                evals: Mapping[str, DataFrame] | None = None, cuts: list[np.ndarray] | None = None, every: int = 20) -> BoostedTrees:
    """Fit on ``train``; ``evals`` names further tables whose loss is noted after every round.

    ``features``: names of numeric columns, or of one array column. Rows without a label are left out. The loss of all
    sets comes with the first level of the next round, so it costs no pass of its own; with
    ``early_stopping_rounds`` the last set of ``evals`` decides, and prediction uses the best round.
    """
    p = params
    if p.objective not in OBJECTIVES:
        raise ValueError(f"objective {p.objective} is not one of {', '.join(OBJECTIVES)}")
    if not 2 <= p.max_bins <= MOST_BINS:
        raise ValueError(f"max_bins must be 2 to {MOST_BINS}")
    spark, outputs = train.sparkSession, p.outputs()
    names = ["train", *(evals or {})]
    x = feature_array(features)

    def rows(df: DataFrame, part: int) -> DataFrame:
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        y = F.col(label).cast("double")
        return df.where(y.isNotNull()).select(x.alias("x"), y.alias("y"), w.alias("w"), F.lit(part).alias("part"),
                                              F.xxhash64(x, y).alias("rid"))

    source = rows(train, 0)
    width = len(features) if not isinstance(features, str) else int(source.agg(F.max(F.size("x"))).first()[0] or 0)
    if cuts is None:
        cuts = quantile_cuts(source, "x", width, p.max_bins, "w" if weight else None)
    every_row = source
    for i, df in enumerate((evals or {}).values(), 1):
        every_row = every_row.unionByName(rows(df, i))
    folder = scratch_dir(spark, "boost")
    data = stage_table(_binned(every_row, cuts, outputs, p.base_margin()), folder)
    bins_n = max([len(c) for c in cuts], default=0) + 2
    size = data.count() * (width + 8 * outputs)
    alone = size <= ONE_TASK_BYTES
    if alone:
        data = stage_table(data.coalesce(1), folder)
    tasks = 1 if alone else max(-(-size // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-size // LEAST_TASK_BYTES)))
    data = data.coalesce(tasks)

    done: list[list[Tree]] = []
    recent: list[list[Tree]] = []
    noted: list[tuple[int, str, float, float]] = []
    best_round, best_loss = -1, math.inf
    taken = max(1, round(p.colsample * width))
    for r in range(p.n_estimators + 1):
        growing = [Tree() for _ in range(outputs)]
        for t in growing:
            t.add(0.0, 0.0)
        rng = np.random.default_rng([p.seed, r])
        columns = [np.sort(rng.choice(width, taken, replace=False)) if taken < width else np.arange(width) for _ in range(outputs)]
        frontier = [(k, 0) for k in range(outputs)] if r < p.n_estimators else []
        last_losses: dict[int, tuple[float, float]] = {}
        depth = 0
        while frontier or (depth == 0 and r == p.n_estimators):
            found = []
            share = max(1, MOST_CELLS // max(1, width * bins_n))
            for i in range(0, max(1, len(frontier)), share):
                level = _level(data, p, width, r, recent, growing, frontier[i:i + share], columns, depth == 0 and i == 0, bins_n, alone)
                found += level.toPandas().to_dict("records") if alone else _best_splits(level, p, bins_n)
            for row in (x for x in found if x["k"] == -1):
                # the cells of a loss: its sum in g, the errors in h, the weight in n
                last_losses[row["node"]] = (row["g"] / row["n"], row["h"] / row["n"]) if row["n"] else (math.nan, math.nan)
            frontier = _grow(growing, [x for x in found if x["k"] >= 0], p, cuts, depth)
            depth += 1
        if r and last_losses:
            for s, (loss, miss) in sorted(last_losses.items()):
                noted.append((r - 1, names[s], math.sqrt(loss) if p.objective == "reg:squarederror" else loss, miss))
            watched = last_losses.get(len(names) - 1, (math.nan, 0))[0]
            if watched < best_loss:
                best_loss, best_round = watched, r - 1
            if p.early_stopping_rounds and r - 1 - best_round >= p.early_stopping_rounds:
                break
        if r == p.n_estimators:
            break
        for t in growing:
            t.prune(p.gamma)
        done.append(growing)
        recent.append(growing)
        if len(recent) >= every:
            data = _with_margins(data, recent, width, folder).coalesce(tasks)
            recent = []
    return BoostedTrees(p, features if isinstance(features, str) else list(features), width, done, noted,
                        best_round if p.early_stopping_rounds else len(done) - 1)


def _grow(growing: list[Tree], found: list[dict], p: Params, cuts: list[np.ndarray], depth: int) -> list[tuple[int, int]]:
    """Apply the splits of one level; the nodes of the next."""
    frontier = []
    for row in sorted(found, key=lambda x: (x["k"], x["node"])):
        tree, node = growing[row["k"]], row["node"]
        if depth == 0:
            tree.value[0], tree.cover[0] = p.eta * leaf_value(row["g"], row["h"], p), row["h"]
        if depth >= p.max_depth or row["gain"] <= 1e-6:
            continue
        f, b = row["f"], row["b"]
        gr, hr = row["g"] - row["gl"], row["h"] - row["hl"]
        tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node] = f, b, row["missing_left"], row["gain"]
        tree.cut[node] = float(cuts[f][b - 1]) if b <= len(cuts[f]) else math.inf
        tree.left[node] = tree.add(p.eta * leaf_value(row["gl"], row["hl"], p), row["hl"])
        tree.right[node] = tree.add(p.eta * leaf_value(gr, hr, p), hr)
        if depth + 1 < p.max_depth:
            frontier += [(row["k"], tree.left[node]), (row["k"], tree.right[node])]
    return frontier


def _with_margins(data: DataFrame, recent: list[list[Tree]], width: int, folder: str) -> DataFrame:
    """The binned rows written again with the margins of the trees so far."""
    def run(batches):
        for rb in batches:
            if rb.num_rows:
                margin = _list_column(_margins(rb, _bytes_matrix(rb.column("bins"), width), recent))
                yield pa.RecordBatch.from_arrays([margin if c == "margin" else rb.column(c) for c in rb.schema.names], rb.schema.names)

    return stage_table(data.mapInArrow(run, data.schema), folder)
