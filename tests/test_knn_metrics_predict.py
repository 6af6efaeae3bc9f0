"""D8/L17 against brute force, N1-N9 and P1-P4."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import knn as KNN
from tabforge.operators import metrics as N
from tabforge.operators import predict as P

from .conftest import rows


def test_knn_matches_brute_force_across_batches(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(60, 5))
    X[7] = X[3]                                           # a zero distance
    lab = rng.integers(0, 3, 60)
    df = spark.createDataFrame([(i, [float(v) for v in X[i]], int(lab[i])) for i in range(60)],
                               "id long, v array<double>, y int").repartition(4)
    nb = KNN.knn_neighbours(df, df, 4, "id", "v", "y", exclude_self=True,
                            max_query_bytes=1000, block_bytes=500,      # 4 query batches, 8 blocks
                            chunk_bytes=256)
    got = {}
    for r in nb.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["nbr_id"]))
    for q in range(60):
        d = np.sqrt(((X - X[q]) ** 2).sum(1))
        d[q] = np.inf
        exp = sorted(range(60), key=lambda j: (d[j], j))[:4]
        assert [j for _, j in sorted(got[q])] == exp
    vote = dict(rows(KNN.knn_vote(nb, "distance"), "query_id", "prediction"))
    assert vote[3] == lab[7] and vote[7] == lab[3]        # zero distance takes all the weight


def test_accuracy_errors_confusion(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 0.0, 1.0), (3, 2.0, 2.0), (4, 1.0, 3.0)],
                               "id int, y double, p double")
    assert N.accuracy(df, "p", "y").first()["accuracy"] == 0.5
    e = N.regression_errors(df, "p", "y").first()
    assert e["mse"] == pytest.approx(5 / 4) and e["rmse"] == pytest.approx(np.sqrt(5 / 4))
    y = np.array([1.0, 0, 2, 1])
    assert e["r2"] == pytest.approx(1 - 5 / ((y - y.mean()) ** 2).sum())
    cm = {(r["truth"], r["pred"]): r["n"] for r in N.confusion(df, "y", "p").collect()}
    assert len(cm) == 16 and cm[(1.0, 3.0)] == 1 and cm[(3.0, 3.0)] == 0   # class only in predictions
    off = N.confusion(df, "y", "p", zero_diagonal=True).where("truth = pred").agg(F.sum("n")).first()[0]
    assert off == 0


def test_roc_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    s = rng.integers(0, 20, 200).astype(float)
    y = (rng.random(200) < s / 20).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in N.roc_points(df, "s", "y").collect()}
    for t in np.unique(s):
        assert got[t] == (int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum()))


def test_importance_topk_score_summary(spark):
    imp = N.feature_importance(spark, ["a", "b", "c"], [0.2, 0.7, 0.1])
    assert [r[0] for r in imp.collect()] == ["b", "a", "c"]
    assert N.top_k_features(["a", "b", "c"], [0.2, 0.7, 0.1], 2) == [0, 1]
    sc = spark.createDataFrame([("m", 0, 1.0), ("m", 1, 3.0)], "model string, fold int, v double")
    r = N.score_summary(sc, "v", ["model"]).first()
    assert (r["mean"], r["std"], r["worst"]) == (2.0, 1.0, 3.0)


def test_rule_prediction_variants(spark):
    df = spark.createDataFrame([("Woman", "g1", 0.0), ("Woman", "Alone", 0.0), ("Boy", "g2", 1.0),
                                ("Boy", "g3", 0.5), ("Man", "g4", 1.0)], "kind string, g string, r double")
    v8 = [r["prediction"] for r in P.group_rule_prediction(df, "kind", "g", "r").collect()]
    v7 = [r["prediction"] for r in P.group_rule_prediction(df, "kind", "g", "r",
                                                           require_group=False).collect()]
    assert v8 == [0, 1, 1, 0, 0] and v7 == [0, 0, 1, 0, 0]


def test_ensemble_argmax_sums_models(spark):
    df = spark.createDataFrame([(1, 0, [0.6, 0.4]), (1, 1, [0.1, 0.9]), (2, 0, [0.5, 0.5])],
                               "id int, model int, p array<double>")
    out = {r["id"]: r["prediction"] for r in P.ensemble_argmax(df, "id", "p", n_classes=2).collect()}
    assert out == {1: 1, 2: 0}                            # tie -> lowest class


def test_override_predictions(spark):
    base = spark.createDataFrame([(1, 0.0), (2, 1.0)], "k int, prediction double")
    over = spark.createDataFrame([(2, 0.0)], "k int, prediction double")
    assert rows(P.override_predictions(base, over, "k", ["prediction"])) == [(1, 0.0), (2, 0.0)]


def test_knn_null_labels_and_bad_vectors(spark):
    nan = float("nan")
    ref = spark.createDataFrame([(1, [0.0, 0.0], None), (2, [0.1, 0.0], 3), (3, [nan, 0.0], 5), (4, [9.0, 9.0], 4)],
                                "id int, v array<double>, l int")
    q = spark.createDataFrame([(10, [0.0, 0.0]), (11, [nan, 1.0]), (12, [9.0, 9.0])], "id int, v array<double>")
    nb = KNN.knn_neighbours(ref, q, 2, "id", "v", "l")
    got = {(r["query_id"], r["rank"]): (r["nbr_id"], r["nbr_label"]) for r in nb.collect()}
    assert got == {(10, 1): (1, None), (10, 2): (2, 3), (11, 1): (None, None), (12, 1): (4, 4), (12, 2): (2, 3)}
    votes = {r["query_id"]: (r["u"], r["w"]) for r in KNN.knn_votes(nb, {"u": "uniform", "w": "distance"}).collect()}
    assert votes == {10: (3, 3), 11: (None, None), 12: (3, 4)}
    lone = KNN.knn_votes(KNN.knn_neighbours(ref.where("id = 1"), q, 2, "id", "v", "l"), {"u": "uniform"})
    assert {r["query_id"]: r["u"] for r in lone.collect()} == {10: None, 11: None, 12: None}


def test_shortlist_follows_the_metric(spark):
    import random

    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    from tabforge.models import selection as M
    from tabforge.operators import split as K
    rnd = random.Random(1)
    data = [(i, float(x), float(x > 0.5)) for i, x in ((i, rnd.random()) for i in range(300))]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(data, "id int, x double, label double"))
    df = K.kfold(df, "id", 3, 1, exact=False)
    good, bad = DecisionTreeClassifier(maxDepth=3), DecisionTreeClassifier(maxDepth=0)
    out = M.shortlist({"bad": bad, "good": good}, df, "fold", M.accuracy_evaluator()).collect()
    assert [r["model"] for r in out] == ["good", "bad"] and all(r["worst"] <= r["mean"] for r in out)
    out = M.shortlist({"bad": bad, "good": good}, df, "fold", M.rmse_evaluator()).collect()
    assert [r["model"] for r in out] == ["good", "bad"] and all(r["worst"] >= r["mean"] for r in out)
