"""Linear models from sufficient statistics.

``X'X``, ``X'y``, ``sum x``, ``sum y``, ``sum y^2`` and ``n`` are aggregated in
one partially aggregated Spark job (p(p+1)/2 + 2p + 3 sums, independent of the
row count); the p x p solve then runs on the driver on that bounded summary.
That covers ordinary least squares, ridge, lasso and elastic net (cyclic
coordinate descent), least-angle regression with and without the lasso's drop
steps, orthogonal matching pursuit, Bayesian ridge and ARD (the scikit-learn
update rules, written on the Gram matrix instead of the data matrix). The
fitted model is a column expression.

For k-fold scoring, one ``groupBy(fold)`` job yields per-fold statistics; the
training statistics of fold f are the total minus fold f and the held-out
squared error is a quadratic form in fold f's statistics, so fitting and
scoring all k folds of every solver costs one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Gram:
    n: float
    sx: np.ndarray       # (p,)
    sy: float
    xx: np.ndarray       # (p, p)
    xy: np.ndarray       # (p,)
    yy: float

    def __sub__(self, o: "Gram") -> "Gram":
        return Gram(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.xx - o.xx,
                    self.xy - o.xy, self.yy - o.yy)

    def centered(self):
        mx = self.sx / self.n
        my = self.sy / self.n
        cxx = self.xx - self.n * np.outer(mx, mx)
        cxy = self.xy - self.n * mx * my
        cyy = self.yy - self.n * my * my
        return mx, my, cxx, cxy, cyy


def _gram_sums(clean: DataFrame, features: Sequence[str], label: str,
               fold: str | None = None) -> dict:
    """Each task forms ``A'A`` for ``A = [1, X, y]`` with NumPy
    (one (p+2) x (p+2) matrix per task and fold, upper triangle emitted), and
    ``groupBy(fold, i, j).sum`` adds the tasks' matrices. The shuffle is
    ~(p+2)^2 / 2 rows per task and fold, independent of the row count.
    Returns ``{fold: Gram}`` (fold 0 when ``fold`` is None)."""
    import pandas as pd
    cols = [*features, label]
    m = len(cols) + 1
    iu, ju = np.triu_indices(m)
    fcol = F.col(fold).cast("int") if fold else F.lit(0)

    def part(batches):
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            for f, g in pdf.groupby("_f"):
                a = np.column_stack([np.ones(len(g)), g[cols].to_numpy(dtype=np.float64)])
                acc[int(f)] = acc.get(int(f), np.zeros((m, m))) + a.T @ a
        for f, mat in acc.items():
            yield pd.DataFrame({"f": np.full(len(iu), f, dtype=np.int32), "i": iu.astype(np.int32),
                                "j": ju.astype(np.int32), "v": mat[iu, ju]})

    sums = (clean.select(fcol.alias("_f"), *[F.col(c).cast("double") for c in cols])
            .mapInPandas(part, "f int, i int, j int, v double")
            .groupBy("f", "i", "j").agg(F.sum("v").alias("v")).collect())   # k (p+2)^2 / 2 values
    mats: dict[int, np.ndarray] = {}
    for r in sums:
        a = mats.setdefault(r["f"], np.zeros((m, m)))
        a[r["i"], r["j"]] = a[r["j"], r["i"]] = r["v"]
    p = len(features)
    return {f: Gram(a[0, 0], a[0, 1:p + 1].copy(), a[0, p + 1], a[1:p + 1, 1:p + 1].copy(),
                    a[1:p + 1, p + 1].copy(), a[p + 1, p + 1]) for f, a in mats.items()}


def gram(df: DataFrame, features: Sequence[str], label: str) -> Gram:
    """One aggregate job over complete rows (NULL in any input drops the row)."""
    found = _gram_sums(df.dropna(subset=[*features, label]), features, label)
    p = len(features)
    return found.get(0, Gram(0.0, np.zeros(p), 0.0, np.zeros((p, p)), np.zeros(p), 0.0))


def fold_grams(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, Gram]:
    clean = df.dropna(subset=[*features, label])
    return _gram_sums(clean, features, label, fold)


@dataclass
class LinearFit:
    features: list[str]
    coef: np.ndarray
    intercept: float
    name: str = "linear"

    def predict_col(self) -> Column:
        expr = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coef):
            if c != 0.0:
                expr = expr + F.col(f).cast("double") * F.lit(float(c))
        return expr

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.predict_col())


def _finish(g: Gram, w: np.ndarray, features, name) -> LinearFit:
    mx, my, *_ = g.centered()
    return LinearFit(list(features), w, float(my - mx @ w), name)


def ols(g: Gram, features, alpha: float = 0.0) -> LinearFit:
    """L9 (alpha=0) and L10 ridge ``||y - Xw - b||^2 + alpha ||w||^2``."""
    _, _, cxx, cxy, _ = g.centered()
    p = len(features)
    w = np.linalg.lstsq(cxx + alpha * np.eye(p), cxy, rcond=None)[0]
    return _finish(g, w, features, "ridge" if alpha else "ols")


def elastic_net(g: Gram, features, alpha: float = 1.0, l1_ratio: float = 0.5, max_iter: int = 100_000,
                tol: float = 1e-13) -> LinearFit:
    """L12 ``||y - Xw - b||^2 / 2n + alpha r ||w||_1 + alpha (1-r) / 2 ||w||^2``.

    Cyclic coordinate descent with the soft threshold, on the centred statistics: a sweep costs p^2 and no pass over
    rows. With one target the multi-task forms have the same objective. It ends when no step of a sweep moves the
    fitted values by more than ``tol`` of the label's norm, or as soon as the equations of the columns in use have a
    solution that meets all conditions of the optimum. On nearly dependent columns sweeps hardly move; after 2,000 the
    columns in use are those of the least-angle path.
    """
    _, _, cxx, cxy, cyy = g.centered()
    p = len(features)
    l1, l2 = g.n * alpha * l1_ratio, g.n * alpha * (1.0 - l1_ratio)
    diag, w, grad = np.diag(cxx), np.zeros(p), cxy.copy()          # grad = X'(y - Xw)
    enough = tol * np.sqrt(max(cyy, 0.0))
    for sweep in range(max_iter):
        if sweep % 50 == 49:
            near = w if sweep != 1999 else on_path(_angle_path(cxx + l2 * np.eye(p), cxy, np.ones(p), True, p), l1)
            exact = _solved_in_use(cxx, cxy, near, l1, l2)
            if exact is not None:
                w = exact
                break
        moved = 0.0
        for j in range(p):
            if diag[j] + l2 <= 0.0:
                continue
            z = grad[j] + diag[j] * w[j]
            step = np.sign(z) * max(abs(z) - l1, 0.0) / (diag[j] + l2) - w[j]
            if step != 0.0:
                w[j] += step
                grad -= cxx[:, j] * step
                moved = max(moved, abs(step) * np.sqrt(diag[j]))
        if moved <= enough:
            break
    return _finish(g, w, features, "elastic_net" if l1_ratio < 1.0 else "lasso")


def _solved_in_use(cxx, cxy, w, l1: float, l2: float) -> np.ndarray | None:
    """The optimum if it uses the columns and signs of ``w``, else None."""
    use = np.flatnonzero(w)
    sign = np.sign(w[use])
    a = cxx[np.ix_(use, use)] + l2 * np.eye(len(use))
    if len(use) and np.linalg.cond(a) > 1e12:
        return None
    out = np.zeros(len(w))
    out[use] = np.linalg.solve(a, cxy[use] - l1 * sign)
    rest = np.delete(cxy - cxx @ out, use)
    fits = (np.sign(out[use]) == sign).all() and (np.abs(rest) <= l1 * (1 + 1e-12) + 1e-12).all()
    return out if fits else None


def lasso(g: Gram, features, alpha: float = 1.0) -> LinearFit:
    """L11 (and its multi-task form with one target)."""
    return elastic_net(g, features, alpha, 1.0)


def least_angle_path(g: Gram, drops: bool = True, normalize: bool = False, most: int | None = None
                     ) -> list[tuple[float, np.ndarray]]:
    """L13 least-angle regression: the knots ``(penalty, w)`` of the path, from the empty model on.

    All chosen columns keep the same correlation with the residual, which falls until another column has it too; with
    ``drops`` a weight that reaches zero leaves, and the knots are lasso solutions at ``alpha = penalty``. Steps are
    solved on the Gram matrix of the chosen columns. ``normalize`` scales columns to unit length first (weights are
    returned for the columns as they are, penalties for the scaled ones). ``most`` bounds the columns chosen. A column
    without variance, or one that the chosen columns span, is never chosen.
    """
    _, _, cxx, cxy, _ = g.centered()
    scale = np.sqrt(np.maximum(np.diag(cxx), 0.0))
    unit = np.where(scale > 0, scale, 1.0) if normalize else np.ones(len(cxy))
    return [(c / g.n, w) for c, w in _angle_path(cxx, cxy, unit, drops, most or len(cxy))]


def _angle_path(cxx, cxy, unit, drops: bool, most: int) -> list[tuple[float, np.ndarray]]:
    """Knots (greatest correlation, weights) of the least-angle path of the columns divided by ``unit``."""
    p = len(cxy)
    diag = np.maximum(np.diag(cxx), 0.0)
    banned = diag <= 1e-24 * max(diag.max(initial=0.0), 1e-300)
    a, c0 = cxx / np.outer(unit, unit), cxy / unit
    w, active = np.zeros(p), []
    start = float(np.abs(np.where(banned, 0.0, c0)).max(initial=0.0))
    tiny = 1e-12 * max(start, 1e-300)
    path, dropped = [(start, w / unit)], -1
    for _ in range(8 * p + 8):
        corr = c0 - a @ w
        free = np.array([j for j in range(p) if j not in active and not banned[j]], dtype=int)
        now = float(np.abs(corr[active]).max()) if active else start
        if now <= tiny:
            break
        if dropped < 0 and len(free) and len(active) < most:
            j = int(free[np.argmax(np.abs(corr[free]))])
            if abs(corr[j]) >= now * (1 - 1e-9):
                trial = a[np.ix_(active + [j], active + [j])]
                if np.linalg.cond(trial) < 1e12:
                    active.append(j)
                else:
                    banned[j] = True
                    continue
        free = np.array([j for j in range(p) if j not in active and not banned[j]], dtype=int)
        direction = np.linalg.solve(a[np.ix_(active, active)], np.sign(corr[active]))     # correlations fall by one a unit
        step, dropped = now, -1
        if len(free) and len(active) < most:
            fall = a[np.ix_(free, active)] @ direction
            with np.errstate(divide="ignore", invalid="ignore"):
                meets = np.concatenate([(now - corr[free]) / (1 - fall), (now + corr[free]) / (1 + fall)])
            meets = meets[np.isfinite(meets) & (meets > tiny)]
            step = min(step, float(meets.min())) if len(meets) else step
        if drops:
            with np.errstate(divide="ignore", invalid="ignore"):
                zero = -w[active] / direction
            zero = np.where(np.isfinite(zero) & (zero > tiny), zero, np.inf)
            if len(zero) and zero.min() < step:
                step, dropped = float(zero.min()), int(np.argmin(zero))
        w[active] += step * direction
        if dropped >= 0:
            w[active[dropped]] = 0.0
            del active[dropped]
        path.append((max(now - step, 0.0), w / unit))
        if now - step <= tiny or not active:
            break
    return path


def on_path(path: list[tuple[float, np.ndarray]], alpha: float) -> np.ndarray:
    """The weights at a penalty: the path is linear between its knots."""
    for (high, a), (low, b) in zip(path, path[1:]):
        if alpha >= low:
            share = 1.0 if high <= low else (high - max(alpha, low)) / (high - low)
            return a + min(max(share, 0.0), 1.0) * (b - a)
    return path[-1][1]


def lars(g: Gram, features, n_nonzero: int = 500) -> LinearFit:
    """L13 least-angle regression, all the way down or until ``n_nonzero`` columns are chosen."""
    return _finish(g, least_angle_path(g, drops=False, most=min(n_nonzero, len(features)))[-1][1], features, "lars")


def lasso_lars(g: Gram, features, alpha: float = 1.0, normalize: bool = True) -> LinearFit:
    """L13 the lasso at one penalty of the least-angle path, on columns of unit length as the reference's scores have it."""
    return _finish(g, on_path(least_angle_path(g, normalize=normalize), alpha), features, "lasso_lars")


def omp(g: Gram, features, n_nonzero: int | None = None) -> LinearFit:
    """L13 orthogonal matching pursuit; default ``max(int(0.1 p), 1)`` atoms."""
    _, _, cxx, cxy, _ = g.centered()
    p = len(features)
    k = n_nonzero or max(int(0.1 * p), 1)
    norms = np.sqrt(np.maximum(np.diag(cxx), 1e-300))
    active: list[int] = []
    w = np.zeros(p)
    for _ in range(min(k, p)):
        corr = (cxy - cxx @ w) / norms
        corr[active] = 0.0
        j = int(np.argmax(np.abs(corr)))
        if abs(corr[j]) < 1e-12:
            break
        active.append(j)
        sub = np.linalg.lstsq(cxx[np.ix_(active, active)], cxy[active], rcond=None)[0]
        w = np.zeros(p)
        w[active] = sub
    return _finish(g, w, features, "omp")


def _sse(cxx, cxy, cyy, w) -> float:
    return float(cyy - 2 * w @ cxy + w @ cxx @ w)


def bayesian_ridge(g: Gram, features, max_iter: int = 300, tol: float = 1e-3,
                   a1: float = 1e-6, a2: float = 1e-6, l1: float = 1e-6, l2: float = 1e-6
                   ) -> LinearFit:
    """L13 Bayesian ridge: evidence maximisation of noise precision ``alpha``
    and weight precision ``lambda`` (scikit-learn's updates, on the Gram)."""
    _, _, cxx, cxy, cyy = g.centered()
    n = g.n
    evals, V = np.linalg.eigh(cxx)
    evals = np.maximum(evals, 0.0)
    var_y = cyy / n
    alpha, lam = 1.0 / (var_y + np.finfo(float).eps), 1.0
    w_old = None
    for _ in range(max_iter):
        w = V @ ((V.T @ cxy) / (evals + lam / alpha))
        sse = _sse(cxx, cxy, cyy, w)
        gamma = float(np.sum(alpha * evals / (lam + alpha * evals)))
        lam = (gamma + 2 * l1) / (float(w @ w) + 2 * l2)
        alpha = (n - gamma + 2 * a1) / (sse + 2 * a2)
        if w_old is not None and np.sum(np.abs(w_old - w)) < tol:
            break
        w_old = w
    w = V @ ((V.T @ cxy) / (evals + lam / alpha))
    return _finish(g, w, features, "bayesian_ridge")


def ard(g: Gram, features, max_iter: int = 300, tol: float = 1e-3, a1: float = 1e-6,
        a2: float = 1e-6, l1: float = 1e-6, l2: float = 1e-6,
        threshold_lambda: float = 1e4) -> LinearFit:
    """L13 automatic relevance determination: one precision per weight, weights
    whose precision passes ``threshold_lambda`` are pruned to zero."""
    _, _, cxx, cxy, cyy = g.centered()
    n, p = g.n, len(features)
    alpha = 1.0 / (cyy / n + np.finfo(float).eps)
    lam = np.ones(p)
    keep = np.ones(p, dtype=bool)
    w = np.zeros(p)
    w_old = None
    for _ in range(max_iter):
        k = np.flatnonzero(keep)
        sigma = np.linalg.pinv(np.diag(lam[k]) + alpha * cxx[np.ix_(k, k)])
        w = np.zeros(p)
        w[k] = alpha * sigma @ cxy[k]
        sse = _sse(cxx, cxy, cyy, w)
        gamma = 1.0 - lam[k] * np.diag(sigma)
        lam[k] = (gamma + 2 * l1) / (w[k] ** 2 + 2 * l2)
        alpha = (n - gamma.sum() + 2 * a1) / (sse + 2 * a2)
        keep = lam < threshold_lambda
        w[~keep] = 0.0
        if w_old is not None and np.sum(np.abs(w_old - w)) < tol:
            break
        w_old = w
    return _finish(g, w, features, "ard")


SOLVERS = {"ols": ols, "ridge": lambda g, f: ols(g, f, 1.0), "lasso": lasso, "multitask_lasso": lasso,
           "elastic_net": elastic_net, "multitask_elastic_net": elastic_net, "lars": lars, "lasso_lars": lasso_lars,
           "omp": omp, "bayesian_ridge": bayesian_ridge, "ard": ard}


def fit(df: DataFrame, features: Sequence[str], label: str, solver: str = "ols") -> LinearFit:
    return SOLVERS[solver](gram(df, features, label), list(features))


def sse(g: Gram, fit: LinearFit) -> float:
    """Sum of squared errors of ``fit`` on the rows summarised by ``g``:
    sum((y - b - w.x)^2) expanded into the statistics, no pass over rows."""
    w, b = fit.coef, fit.intercept
    return float(g.yy - 2 * b * g.sy - 2 * w @ g.xy + g.n * b * b + 2 * b * (w @ g.sx)
                 + w @ g.xx @ w)


def fold_rmse(per: dict[int, Gram], features: Sequence[str], solver) -> list[tuple[int, float]]:
    """M1 for a Gram model: ``(fold, held-out RMSE)`` from each fold's statistics, without a pass over rows."""
    total = None
    for g in per.values():
        total = g if total is None else Gram(total.n + g.n, total.sx + g.sx, total.sy + g.sy,
                                             total.xx + g.xx, total.xy + g.xy, total.yy + g.yy)
    return [(int(f), float(np.sqrt(max(sse(g, solver(total - g, list(features))), 0.0) / g.n))) for f, g in sorted(per.items())]


def cv_rmse(df: DataFrame, features: Sequence[str], label: str, fold: str,
            solvers: Sequence[str]) -> DataFrame:
    """M1/M3 for Gram models: per (solver, fold) held-out RMSE from ONE scan.

    ``groupBy(fold)`` yields each fold's statistics; the training statistics of
    fold f are the total minus fold f, and the held-out error is a quadratic
    form in fold f's own statistics (``sse``)."""
    spark = df.sparkSession
    per = fold_grams(df, features, label, fold)
    rows = [(name, f, v) for name in solvers for f, v in fold_rmse(per, features, SOLVERS[name])]
    return spark.createDataFrame(rows, "model string, fold int, rmse double")
