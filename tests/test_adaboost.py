"""SAMME.R and AdaBoost.R2: weights, scores and medians equal a NumPy loop over the fitted base models."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tabforge.models import adaboost as A
from tabforge.models import estimators as L


def table(spark, n=250, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    c = ((x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 2] > 0.5)).astype(float)
    y = np.sin(2 * x[:, 0]) + x[:, 1] ** 2 + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(i, [float(v) for v in r], float(k), float(t)) for i, (r, k, t) in enumerate(zip(x, c, y))],
                               "id int, x array<double>, c double, y double").repartition(3)
    return df, x, c, y


class Noted:
    """A base model that keeps its fitted models and the weights they saw."""

    def __init__(self, make):
        self.make, self.models, self.weights = make, [], []

    def __call__(self, seed):
        est, outer = self.make(seed), self

        def noted(train):
            model = type(est).fit(est, train)
            outer.models.append(model)
            outer.weights.append({tuple(r["features"]): r["w"] for r in train.collect()})
            return model
        est.fit = noted
        return est


def test_samme_r_equals_a_plain_loop(spark, tmp_path):
    df, x, c, _ = table(spark)
    base = Noted(lambda seed: L.random_forest(3, 2, seed=seed))
    m = A.fit_adaboost(df, "x", "c", base, rounds=5, rate=0.5, classes=3, every=2)
    w, score = np.ones(len(x)), np.zeros((len(x), 3))
    vec = df.select("id", array_to_vector("x").alias("features"))
    for model, seen in zip(base.models, base.weights, strict=True):
        got = np.array([seen[tuple(r)] for r in x])
        assert np.allclose(got / got.sum(), w / w.sum())
        p = np.array([r[0] for r in model.transform(vec).orderBy("id").select(vector_to_array("probability")).collect()])
        lp = np.log(np.clip(p, np.finfo(float).eps, None))
        code = np.where(c[:, None] == np.arange(3), 1.0, -0.5)
        w = w * np.exp(-0.5 * (2 / 3) * (code * lp).sum(1))
        score += 2 * (lp - lp.mean(1, keepdims=True))
    rows = m.transform(df, score="s").orderBy("id").collect()
    assert np.allclose([r["s"] for r in rows], score)
    assert [r["prediction"] for r in rows] == [float(k) for k in score.argmax(1)]
    assert (score.argmax(1) == c).mean() > 0.5
    m.save(spark, str(tmp_path / "m"))
    again = A.AdaBoost.load(spark, str(tmp_path / "m"))
    assert np.array_equal(again.scores(x), m.scores(x))


def test_r2_equals_a_plain_loop(spark):
    df, x, _, y = table(spark, seed=2)
    base = Noted(lambda seed: DecisionTreeRegressor(maxDepth=3, seed=seed))
    m = A.fit_adaboost(df, "x", "y", base, rounds=5, rate=1.0, every=2)
    w, each, says = np.ones(len(x)), [], []
    vec = df.select("id", array_to_vector("x").alias("features"))
    for model, seen in zip(base.models, base.weights, strict=True):
        got = np.array([seen[tuple(r)] for r in x])
        assert np.allclose(got / got.sum(), w / w.sum())
        p = np.array([r[0] for r in model.transform(vec).orderBy("id").select("prediction").collect()])
        e = np.abs(p - y) / np.abs(p - y).max()
        loss = (w * e).sum() / w.sum()
        b = loss / (1 - loss)
        w = w * b ** (1 - e)
        each.append(p)
        says.append(np.log(1 / b))
    want = []
    for col in np.array(each).T:
        order, share = np.argsort(col, kind="stable"), 0.0
        for i in order:
            share += says[i]
            if share >= 0.5 * sum(says):
                want.append(col[i])
                break
    got = [r["prediction"] for r in m.transform(df).orderBy("id").collect()]
    assert m.weights == pytest.approx(says) and got == pytest.approx(want)
    assert np.mean((np.array(got) - y) ** 2) < np.mean((each[0] - y) ** 2)


def test_odd_rows_and_early_end(spark):
    rows = [(None, 1.0), ([1.0, None], 1.0), ([1.0, 2.0], None), ([1.0, 2.0], 3.0), ([2.0, 2.0], 5.0)]
    df = spark.createDataFrame(rows, "x array<double>, y double")
    m = A.fit_adaboost(df, "x", "y", lambda seed: DecisionTreeRegressor(maxDepth=2, seed=seed), rounds=5)
    assert len(m.rounds) == 1                                      # the first tree is exact
    assert [r["prediction"] for r in m.transform(df).collect()] == [None, None, 3.0, 3.0, 5.0]
    assert m.transform(df.where(F.lit(False))).count() == 0
