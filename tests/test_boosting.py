"""AdaBoost and the boosters: full sizes by default, votes equal to those of the trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.models import estimators as L
from tabforge.plans import learn

from .conftest import SF001


class Seen(Exception):
    pass


def test_queries_fit_the_reference_sizes(spark, monkeypatch):
    def seen(*args, **kw):
        raise Seen(args, kw)
    monkeypatch.setattr(learn.L, "AdaBoostSAMME", seen)
    monkeypatch.setattr(learn.B, "fit_boosted", seen)
    with pytest.raises(Seen) as e:
        learn.q_adaboost(spark, SF001)
    assert (e.value.args[1]["n_estimators"], e.value.args[1]["learning_rate"]) == (200, 0.5)
    for given, rounds in (({}, 100), ({"rounds": 7}, 7)):
        with pytest.raises(Seen) as e:
            learn.q_xgb_like(spark, SF001, **given)
        assert e.value.args[0][3].n_estimators == rounds


def test_adaboost_matches_a_plain_loop_over_its_trees(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = ((x[:, 0] * x[:, 1] > 0) + (x[:, 2] > 0.5)).astype(float)
    df = L.assemble(spark.createDataFrame([(i, *map(float, v), float(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))],
                                          "id int, a double, b double, c double, label double"), ["a", "b", "c"])
    model = L.AdaBoostSAMME(n_estimators=12, n_classes=3, checkpoint_every=5).fit(df)
    assert len(model.trees) == 12
    w, score = np.full(300, 1 / 300), np.zeros((300, 3))
    for tree, alpha in zip(model.trees, model.alphas, strict=True):
        p = np.array([r[0] for r in tree.transform(df).orderBy("id").select("_p").collect()])
        err = w[p != y].sum() / w.sum()
        assert alpha == pytest.approx(0.5 * (np.log((1 - err) / err) + np.log(2)))
        w = w * np.exp(alpha * (p != y))
        w /= w.sum()
        score[np.arange(300), p.astype(int)] += alpha
    got = model.transform(df).orderBy("id").select("ada_score", "prediction").collect()
    assert np.allclose([r.ada_score for r in got], score)
    assert [r.prediction for r in got] == [float(k) for k in score.argmax(1)]
    assert set(model.transform(df).columns) == {*df.columns, "ada_score", "prediction"}
    assert L.AdaBoostModel([], [], 2).transform(df).where(F.col("prediction") != 0).count() == 0
