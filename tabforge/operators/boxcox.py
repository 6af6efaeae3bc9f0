"""Box-Cox transform with a maximum-likelihood lambda.

The profile log-likelihood for positive ``x`` is

    llf(l) = (l - 1) * sum(ln x) - n/2 * ln(var_pop(y_l)),
    y_l = (x^l - 1) / l   (ln x when l == 0).

One aggregate job evaluates ``var_pop(y_l)`` for a whole grid of lambdas
(rows paired with grid values, ``groupBy(lambda)``: one scan, partial
aggregation); the grid is then narrowed around the best point and evaluated
again. Only grid statistics (one row per lambda) reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col


def boxcox_expr(x: ColumnOrName, lmbda: float, shift: float = 0.0) -> Column:
    """Box-Cox of ``x + shift`` with a fixed lambda; NULL for non-positive input."""
    v = col(x).cast("double") + F.lit(float(shift))
    if lmbda == 0:
        y = F.ln(v)
    else:
        y = (F.pow(v, F.lit(float(lmbda))) - F.lit(1.0)) / F.lit(float(lmbda))
    return F.when(v > 0, y)


def _llf_grid(df: DataFrame, x: str, shift: float, grid: list[float]) -> list[tuple[float, float]]:
    """Profile log-likelihood at every lambda of ``grid`` in one scan: rows are
    paired with the grid values (``explode`` of a literal array, streamed, not
    stored) and ``groupBy(lambda)`` aggregates partially, returning one row per
    grid point."""
    v = F.col(x).cast("double") + F.lit(float(shift))
    lam = F.col("_l")
    y = F.when(lam == 0, F.ln("_v")).otherwise((F.pow("_v", lam) - F.lit(1.0)) / lam)
    rows = (df.select(v.alias("_v")).where(F.col("_v") > 0)
            .select("_v", F.explode(F.array(*[F.lit(float(l)) for l in grid])).alias("_l"))
            .groupBy("_l").agg(F.count(F.lit(1)).alias("n"), F.sum(F.ln("_v")).alias("sl"),
                               F.var_pop(y).alias("var"))
            .collect())                                                  # len(grid) rows
    out = []
    for r in rows:
        n, sl, var, l = r["n"], r["sl"], r["var"], r["_l"]
        if not n or var is None or var <= 0:
            continue
        out.append((l, (l - 1.0) * sl - n / 2.0 * math.log(var)))
    return sorted(out)


def fit_lambda(df: DataFrame, x: str, shift: float = 0.0, lo: float = -5.0, hi: float = 5.0,
               points: int = 41, rounds: int = 4) -> float:
    """Maximum-likelihood lambda by successive grid refinement (each round one
    scan; the step shrinks by ``(points - 1) / 2`` per round)."""
    best = None
    for _ in range(rounds):
        step = (hi - lo) / (points - 1)
        grid = [lo + i * step for i in range(points)]
        scored = _llf_grid(df, x, shift, grid)
        if not scored:
            raise ValueError("Box-Cox needs positive, non-constant data")
        best = max(scored, key=lambda t: t[1])[0]
        lo, hi = best - step, best + step
    return float(best)


def boxcox(df: DataFrame, x: str, out: str | None = None, shift: float = 0.0,
           lmbda: float | None = None) -> tuple[DataFrame, float]:
    """H9: returns ``(frame with transformed column, lambda)``. ``shift=1`` is the
    ``x + 1`` variant; a given ``lmbda`` skips the fit."""
    lam = fit_lambda(df, x, shift) if lmbda is None else float(lmbda)
    return df.withColumn(out or x, boxcox_expr(x, lam, shift)), lam
