"""Encoders against pandas, array operators against NumPy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabforge.functions import arrays as A
from tabforge.operators import boxcox as BC
from tabforge.operators import encode as J

from .conftest import rows


@pytest.fixture
def cats(spark):
    return spark.createDataFrame([(1, "S"), (2, "C"), (3, "Q"), (4, "S"), (5, None)], "id int, e string")


def test_label_encode_sorted_and_inverse(cats):
    enc, model = J.label_encode(cats.where("e is not null"), "e", "code")
    assert dict(rows(enc, "e", "code")) == {"C": 0, "Q": 1, "S": 2}
    back = J.label_decode(enc, "code", "e2", model)
    assert back.where("e <> e2").count() == 0


def test_one_hot_sums_to_one_and_first_indicator(cats):
    oh = J.one_hot_columns(cats, "e")
    assert oh.columns[-3:] == ["e_C", "e_Q", "e_S"]
    sums = {r["id"]: r["e_C"] + r["e_Q"] + r["e_S"] for r in oh.collect()}
    assert sums == {1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0, 5: 0.0}
    fi = dict(rows(J.first_category_indicator(cats, "e", "f"), "id", "f"))
    assert fi == {1: 0.0, 2: 1.0, 3: 0.0, 4: 0.0, 5: 0.0}


def test_scalers_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "a double, c double")
    out = J.standard_scale(df, ["a", "c"], suffix="_s")
    a = np.array([1.0, 2, 3, 6])
    assert sorted(r[0] for r in out.select("a_s").collect()) == pytest.approx(sorted((a - a.mean()) / a.std()))
    assert {r[0] for r in out.select("c_s").collect()} == {0.0}
    mm = J.minmax_scale(df, ["a"], suffix="_m")
    assert sorted(r[0] for r in mm.select("a_m").collect()) == pytest.approx([0, 0.2, 0.4, 1.0])
    # Fit on one frame, apply to another; model persists like any ML stage
    model = J.StandardScale(["a"]).fit(df.where("a < 4"))
    got = [r[0] for r in model.transform(spark.createDataFrame([(2.0,)], "a double")).collect()]
    assert got == [0.0]


def test_equal_width_bins_match_pandas_cut(spark):
    vals = [0.5, 3.0, 7.2, 10.0, 22.5, 40.0, 41.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    out = J.equal_width_bins(df, "x", 10, "b")
    exp = pd.cut(pd.Series(vals), 10, labels=False) + 1
    got = [r[0] for r in out.orderBy("id").select("b").collect()]
    assert got == list(exp)
    _, edges = pd.cut(pd.Series(vals), 10, retbins=True)   # labels round edges; bins do not
    lo = [r[0] for r in out.orderBy("id").select("b_lo").collect()]
    assert lo == pytest.approx([edges[b - 1] for b in exp], rel=1e-9)


def test_quantile_bins_match_pandas_qcut(spark):
    vals = list(range(9))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    out = J.quantile_bins(df, "x", 3, "q")
    got = [r[0] for r in out.orderBy("x").select("q").collect()]
    assert got == list(pd.qcut(pd.Series(vals), 3, labels=False))
    assert out.select((F.col("q_0") + F.col("q_1") + F.col("q_2")).alias("s")).distinct().collect()[0][0] == 1.0


def test_binarize_and_pipeline_persistence(spark, tmp_path):
    df = spark.createDataFrame([(5.0,), (6.0,), (7.0,), (None,)], "x double")
    assert [r[0] for r in df.select(J.binarize("x", 6)).collect()] == [0.0, 0.0, 1.0, None]
    pipe = Pipeline(stages=[J.MinMaxScale(["x"], suffix="_m")]).fit(df)
    pipe.write().overwrite().save(str(tmp_path / "p"))
    from pyspark.ml import PipelineModel
    back = PipelineModel.load(str(tmp_path / "p"))
    assert rows(back.transform(df), "x_m") == rows(pipe.transform(df), "x_m")


def test_boxcox_fit_maximises_likelihood(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(1.0, 0.5, 400)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = BC.fit_lambda(df, "x")

    def llf(l):
        y = np.log(x) if l == 0 else (x ** l - 1) / l
        return (l - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())
    grid = np.linspace(-2, 2, 4001)
    best = grid[np.argmax([llf(g) for g in grid])]
    assert abs(lam - best) < 2e-3
    out, _ = BC.boxcox(df, "x", "y", lmbda=0.0)
    assert out.select(F.max(F.abs(F.col("y") - F.ln("x")))).first()[0] < 1e-12


def test_softmax_argmax_xent(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 2), ([5.0, 5.0, 1.0], 0)], "z array<double>, y int")
    out = df.select(A.softmax("z").alias("p"), A.argmax("z").alias("am"), "y").collect()
    z = np.array([1.0, 2, 3])
    assert out[0]["p"] == pytest.approx(list(np.exp(z) / np.exp(z).sum()))
    assert [r["am"] for r in out] == [2, 0]           # first maximum wins
    xe = df.select(A.cross_entropy_term(A.softmax("z"), "y")).first()[0]
    assert xe == pytest.approx(-math.log(np.exp(3) / np.exp(z).sum() + 1e-10))


def test_shift_pad_reshape(spark):
    img = [float(i) for i in range(16)]
    df = spark.createDataFrame([(img,)], "a array<double>")
    m = np.array(img).reshape(4, 4)
    r = df.select(A.shift("a", 4, 1, 0).alias("down"), A.shift(A.shift("a", 4, 0, 1), 4, 0, -1).alias("rl"),
                  A.pad("a", 4, 1).alias("p"), A.reshape_rows("a", 4).alias("m"),
                  A.prepend_bias("a").alias("b"), A.scale("a", 2.0).alias("s")).first()
    down = np.zeros((4, 4)); down[1:] = m[:-1]
    assert r["down"] == list(down.ravel())
    rl = m.copy(); rl[:, -1] = 0                       # right then left keeps the interior
    assert r["rl"] == list(rl.ravel())
    assert r["p"] == list(np.pad(m, 1).ravel())
    assert r["m"] == [list(row) for row in m]
    assert r["b"][0] == 1.0 and len(r["b"]) == 17 and r["s"][3] == 1.5
    copies = df.select(F.explode(A.shifted_copies("a", 4)).alias("c")).count()
    assert copies == 4
