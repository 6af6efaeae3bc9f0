from __future__ import annotations

import numpy as np
import pytest

from tabforge.models.svr import fit_svr


def objective(x, y, w, b, c, eps):
    return 0.5 * w @ w + c * np.maximum(0, np.abs(y - x @ w - b) - eps).sum()


def test_svr_reaches_the_optimum_and_ignores_outliers(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((200, 2))
    y = x @ np.array([2.0, -1.0]) + 3 + rng.uniform(-0.05, 0.05, 200)
    y[:6] += 50
    df = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)] + [([0.0, 0.0], None)], "features array<double>, label double")
    m = fit_svr(df, C=1.0, eps=0.1, max_iter=200, tol=1e-9, smooth=1e-3)
    assert m.coef == pytest.approx([2.0, -1.0], abs=0.05) and m.intercept == pytest.approx(3.0, abs=0.08)
    mine = objective(x, y, m.coef, m.intercept, 1.0, 0.1)
    around = [objective(x, y, m.coef + d[:2], m.intercept + d[2], 1.0, 0.1) for d in rng.normal(0, 0.02, (300, 3))]
    assert mine <= min(around) + 0.15
    got = m.transform(df).select("prediction").first()[0]
    assert got == pytest.approx(x[0] @ m.coef + m.intercept)
