"""SGD against closed forms, kernel maps against exact kernels, wide correlations against NumPy."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.models import estimators as L
from tabforge.models import sgd as S
from tabforge.operators import groups as E


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 3))
    y = x @ [1.5, -2.0, 0.0] + 0.7 + rng.normal(scale=0.3, size=3000)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id int, a double, b double, c double, y double").repartition(4, "id")
    return df, x, y


def test_squared_loss_comes_within_one_percent_of_the_closed_form(data):
    df, x, y = data
    a, m = 1e-3, S.fit_sgd(df, ["a", "b", "c"], "y", alpha=1e-3, eta0=0.1, epochs=15)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc / len(y) + a * np.eye(3), xc.T @ yc / len(y))
    best = 0.5 * np.mean((yc - xc @ w) ** 2) + 0.5 * a * w @ w
    assert best <= m.history[-1] <= 1.01 * best
    assert m.history[-1] < 0.05 * m.history[0]
    again = S.fit_sgd(df, ["a", "b", "c"], "y", alpha=1e-3, eta0=0.1, epochs=15)
    assert np.array_equal(m.coef, again.coef) and m.history == again.history
    got = m.transform(df).select(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    assert got == pytest.approx(np.mean((x @ m.coef + m.intercept - y) ** 2))


@pytest.mark.parametrize("loss", ["hinge", "logistic"])
def test_classifiers(data, loss):
    df, x, y = data
    t = df.withColumn("label", (F.col("y") > 0.7).cast("int")).withColumn("v", F.array("a", "b", "c"))
    m = S.fit_sgd(t, "v", "label", loss, alpha=1e-3, eta0=0.5, schedule="optimal", epochs=6)
    assert m.transform(t).where("prediction = label").count() > 2750
    assert m.history[-1] < 0.5 * m.history[0]


def test_unscaled_columns_diverge(data):
    df, _, _ = data
    m = S.fit_sgd(df.withColumn("a", F.col("a") * 1000), ["a", "b"], "y", eta0=0.01, epochs=3)
    assert not m.history[-1] < 1e6


def test_odd_rows(spark):
    rows = [(1.0, None, 1.0), (None, 2.0, 3.0), (1.0, 2.0, None), (float("nan"), 1.0, 1.0), (2.0, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    m = S.fit_sgd(df, ["a", "b"], "y", epochs=1)
    assert m.coef.any() and m.history[0] == pytest.approx(12.5)
    assert not S.fit_sgd(df.where("y > 9"), ["a", "b"], "y").coef.any()
    with pytest.raises(ValueError, match="loss"):
        S.fit_sgd(df, ["a"], "y", "cubic")


def test_landmark_map_is_nearer_to_the_kernel_than_random_features(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 4)) @ np.diag([1.0, 1.0, 0.3, 0.1])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, x array<double>")
    exact = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))

    def error(out, col, k):
        z = np.array([r[0] for r in out.orderBy("id").select(vector_to_array(col)).collect()])
        return np.linalg.norm(z @ z.T - k) / np.linalg.norm(k)
    near = error(L.nystroem_features(df, "x", 40, gamma=0.3, seed=1), "kernel", exact)
    assert near < 0.06 and near < 0.5 * error(L.random_fourier_features(df, "x", 4, 0.3, 40, seed=1), "rff", exact)
    poly = (x @ x.T + 1.0) ** 2
    assert error(L.nystroem_features(df, "x", 60, kernel="poly", gamma=1.0, degree=2, coef0=1.0), "kernel", poly) < 1e-6
    assert L.nystroem_features(df, "x", 500, gamma=0.3).count() == 80          # more landmarks than rows: all of them


def test_landmarks_do_not_depend_on_partitions(spark):
    df = spark.range(200).select("id", F.array((F.col("id") * 7 % 13).cast("double"), F.col("id").cast("double")).alias("x"))
    a, b = (L.nystroem_features(d, "x", 10, gamma=0.01, seed=3).orderBy("id").first()["kernel"] for d in (df, df.repartition(7)))
    assert np.allclose(a.toArray(), b.toArray())


def test_correlations_of_many_columns_take_one_shuffle(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 500)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(500)]
    wide = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(3)
    df = wide.select(*[F.nullif(F.get("v", F.lit(i)), F.lit(float("nan"))).alias(n) for i, n in enumerate(names)])
    out = E.corr_long(df, names)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = out.toPandas().pivot(index="col_a", columns="col_b", values="corr").loc[names, names].to_numpy(dtype=float)
    import pandas as pd
    assert np.allclose(got, pd.DataFrame(x).corr().to_numpy(), atol=1e-7)


def test_correlation_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, 5, None, "x"), (2.0, 5, 1.0, "y"), (None, 5, 2.0, "z")], "a double, k int, b double, s string")
    for corr in (E.corr_long, E.corr_products):
        got = {(r[0], r[1]): r[2] for r in corr(df, ["a", "b"]).collect()}
        assert got["a", "a"] == pytest.approx(1.0) and got["a", "b"] is None and len(got) == 4
    got = {(r[0], r[1]): r[2] for r in E.corr_products(df, ["a", "k", "b"]).collect()}
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "k"] is None and got["a", "b"] is None and got["k", "k"] is None
    assert len(got) == 9 and all(r[2] is None for r in E.corr_products(df.where("a > 9"), ["a", "b"]).collect())
