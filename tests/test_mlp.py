"""MLP: gradients by finite differences, steps that fall, a fit that a linear model cannot reach, odd rows, files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.models import mlp as P

from .conftest import SF001


@pytest.mark.parametrize("activation", list(P.ACTIVATIONS))
@pytest.mark.parametrize("classes", [True, False])
def test_gradient_equals_finite_differences(activation, classes):
    rng = np.random.default_rng(1)
    sizes = [4, 5, 3, 3 if classes else 1]
    x, y = rng.normal(size=(20, 4)), rng.integers(0, 3, 20).astype(float)
    theta = P.start_weights(sizes, activation, 2)
    _, grad = P.loss_and_gradient(x, y, theta, sizes, activation, classes)
    for i in range(0, len(theta), 3):
        e = np.zeros(len(theta))
        e[i] = 1e-6
        up, down = (P.loss_and_gradient(x, y, theta + s * e, sizes, activation, classes)[0] for s in (1, -1))
        assert grad[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


def test_steps_reach_the_least_point_of_a_known_function():
    a = np.diag([1.0, 10.0, 100.0])
    theta, path = P.minimise(lambda t: (float(0.5 * t @ a @ t - t.sum()), a @ t - 1.0), np.zeros(3), 100, 1e-9)
    assert theta == pytest.approx([1.0, 0.1, 0.01], abs=1e-5) and path == sorted(path, reverse=True)


def test_fits_what_a_line_cannot(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, size=(400, 2))
    label = (x[:, 0] * x[:, 1] > 0).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, label))],
                               "id int, a double, b double, label double").repartition(3)
    m = P.fit_mlp(df, ["a", "b"], "label", (8,), "tanh", n_classes=2, max_iter=60, seed=1)
    out = m.transform(df, probability="p")
    assert out.where("prediction = label").count() >= 380
    sums = out.agg(F.min(F.aggregate("p", F.lit(0.0), lambda s, v: s + v)), F.max(F.aggregate("p", F.lit(0.0), lambda s, v: s + v))).first()
    assert tuple(sums) == pytest.approx((1.0, 1.0))
    m.save(spark, str(tmp_path / "m"))
    again = P.MLPModel.load(spark, str(tmp_path / "m"))
    assert again.transform(df).exceptAll(m.transform(df)).isEmpty()


def test_regression_and_odd_rows(spark):
    rows = [([float(i), 1.0], 2.0 * i + 1.0) for i in range(-5, 6)] + [(None, 1.0), ([1.0, None], 2.0), ([1.0, float("nan")], 2.0), ([1.0, 2.0], None)]
    df = spark.createDataFrame(rows, "x array<double>, y double")
    m = P.fit_mlp(df, "x", "y", (4,), "identity", alpha=0.0, max_iter=100, tol=1e-8)
    got = m.transform(df).collect()
    assert [r["prediction"] for r in got[:11]] == pytest.approx([r["y"] for r in got[:11]], abs=0.02)
    assert [r["prediction"] is None for r in got[11:]] == [True, True, True, False]
    with pytest.raises(ValueError, match="no rows"):
        P.fit_mlp(df.where("false"), "x", "y")


def test_loss_falls_on_the_embeddings(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    m = P.fit_mlp(e, "embedding", "label", (16,), n_classes=10, max_iter=10)
    assert m.path == sorted(m.path, reverse=True) and m.path[-1] < 0.9 * m.path[0]
