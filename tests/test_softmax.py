"""Softmax by gradient steps: equal to NumPy step by step, in one task and in a job a step; early stop; odd rows."""

import numpy as np
import pytest

from tabforge.models import softmax as S


def tables(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = np.argmax(x @ rng.normal(size=(3, 4)) + rng.normal(scale=2.0, size=(n, 4)), axis=1).astype(float)
    return spark.createDataFrame([([float(v) for v in r], float(c)) for r, c in zip(x, y)], "x array<double>, y double").repartition(3), x, y


def by_numpy(x, y, vx, vy, steps, eta, alpha):
    theta, path = np.random.default_rng(42).normal(size=(4, 4)), []
    a, b = np.column_stack([np.ones(len(x)), x]), np.column_stack([np.ones(len(vx)), vx])
    for _ in range(steps):
        loss = []
        for m, t in ((a, y), (b, vy)):
            e = np.exp(m @ theta)
            p = e / e.sum(1, keepdims=True)
            loss.append(-np.log(p[np.arange(len(t)), t.astype(int)] + 1e-7).mean() + 0.5 * alpha * (theta[1:] ** 2).sum())
        path.append(loss)
        e = np.exp(a @ theta)
        grad = a.T @ (e / e.sum(1, keepdims=True) - np.eye(4)[y.astype(int)]) / len(y)
        grad[1:] += alpha * theta[1:]
        theta = theta - eta * grad
    return path


@pytest.mark.parametrize("steps, limit", [(50, 1 << 25), (8, 0)])
def test_steps_equal_numpy(spark, monkeypatch, steps, limit):
    monkeypatch.setattr(S, "ONE_TASK_BYTES", limit)
    train, x, y = tables(spark, 150, 1)
    valid, vx, vy = tables(spark, 60, 1)
    m = S.fit_softmax(train, valid, "x", "y", 4, alpha=0.01, most_steps=steps)
    assert np.allclose(m.path, by_numpy(x, y, vx, vy, steps, 0.1, 0.01)[:len(m.path)]) and len(m.path) == steps
    e = np.exp(np.column_stack([np.ones(60), vx]) @ m.theta)
    got = m.transform(valid, probability="p").toPandas()
    want = {tuple(r): p for r, p in zip(vx, e / e.sum(1, keepdims=True))}
    assert all(np.allclose(want[tuple(r)], p) and c == np.argmax(p) for r, p, c in zip(got["x"], got["p"], got["prediction"]))


def test_stops_at_the_first_rise(spark):
    train, _, _ = tables(spark, 40, 2)
    valid, _, _ = tables(spark, 40, 9)                              # other classes: fitting on makes it worse at some point
    m = S.fit_softmax(train, valid, "x", "y", 4, eta=0.5)
    held = [v for _, v in m.path]
    assert len(held) < 5001 and held[-1] >= held[-2] and held[:-1] == sorted(held[:-1], reverse=True)
    again = S.fit_softmax(train, valid, "x", "y", 4, eta=0.5, most_steps=len(held) - 1)
    assert np.allclose(again.theta, m.theta)


def test_odd_rows(spark):
    rows = [([1.0, None], 0.0), (None, 1.0), ([1.0, 2.0], None), ([2.0, 1.0], 1.0), ([float("nan"), 1.0], 0.0)]
    df = spark.createDataFrame(rows, "x array<double>, y double")
    m = S.fit_softmax(df, df.where("false"), "x", "y", 2, most_steps=5)
    assert len(m.path) == 5 and m.path[-1][0] < m.path[0][0]
    assert [r["prediction"] is None for r in m.transform(df).collect()] == [True, True, False, False, True]
    assert S.fit_softmax(df.where("false"), df, "x", "y", 2).path == []


def test_blocks_hold_every_row_exactly_in_few_tasks(spark):
    """Rows go into matrix blocks once, in the tasks asked for, instead of a query a step."""
    floats = spark.sql("select array(cast(id as float) / 3f, -1f) x, 0d y, 0 part from range(0, 25, 1, 5)")
    rows = floats.selectExpr("cast(x as array<double>) x", "y", "part").unionByName(spark.sql("select array(0.1d, 1e300d) x, 1d y, 1 part"))
    blocks = S._blocks(rows, 2, 2)
    assert blocks.getNumPartitions() == 2
    found = sorted(tuple(r) + (c, p) for x, y, part in blocks.collect() for r, c, p in zip(x.astype(float).tolist(), y.tolist(), part.tolist()))
    assert found == sorted((1.0, *r["x"], r["y"], r["part"]) for r in rows.collect())
