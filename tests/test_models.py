"""Optimality and invariant checks with fixed seeds."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.models import estimators as L
from tabforge.models import gram as GR
from tabforge.models import selection as M
from tabforge.operators import split as K


@pytest.fixture(scope="module")
def reg_data(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 4))
    y = X @ np.array([2.0, -1.0, 0.0, 0.5]) + 3.0 + rng.normal(scale=0.3, size=300)
    rows = [(i, *map(float, X[i]), float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y double")
    return df, X, y


FEATS = ["a", "b", "c", "d"]


def test_gram_ols_and_ridge_match_closed_form(reg_data):
    df, X, y = reg_data
    g = GR.gram(df, FEATS, "y")
    Xc, yc = X - X.mean(0), y - y.mean()
    ols = GR.ols(g, FEATS)
    exp = np.linalg.lstsq(Xc, yc, rcond=None)[0]
    assert ols.coef == pytest.approx(exp, rel=1e-8)
    assert ols.intercept == pytest.approx(y.mean() - X.mean(0) @ exp, rel=1e-8)
    ridge = GR.ols(g, FEATS, alpha=10.0)
    assert ridge.coef == pytest.approx(np.linalg.solve(Xc.T @ Xc + 10 * np.eye(4), Xc.T @ yc), rel=1e-8)
    pred = ols.transform(df).select(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    assert pred < 0.12


def test_gram_and_folds_equal_numpy(reg_data):
    df, X, y = reg_data
    g = GR.gram(df.repartition(5), FEATS, "y")
    assert g.n == len(y) and g.sy == pytest.approx(y.sum(), rel=1e-9) and g.yy == pytest.approx(y @ y, rel=1e-9)
    assert np.allclose(g.xx, X.T @ X, rtol=1e-9) and np.allclose(g.xy, X.T @ y, rtol=1e-9)
    f = K.kfold(df, "id", 3, 1, exact=False)
    parts = GR.fold_grams(f, FEATS, "y", "fold")
    assert sum(p.n for p in parts.values()) == len(y)
    assert np.allclose(sum(p.xx for p in parts.values()), g.xx, rtol=1e-9)


def test_bayesian_ridge_and_ard_on_gram_equal_data_matrix(reg_data):
    df, X, y = reg_data
    g = GR.gram(df, FEATS, "y")
    br = GR.bayesian_ridge(g, FEATS)
    # the same updates written on the data matrix (SVD) give the same weights
    Xc, yc = X - X.mean(0), y - y.mean()
    U, S, Vt = np.linalg.svd(Xc, full_matrices=False)
    ev = S ** 2
    alpha, lam = 1 / (yc.var() + np.finfo(float).eps), 1.0
    w_old = None
    for _ in range(300):
        w = Vt.T @ (Vt @ (Xc.T @ yc) / (ev + lam / alpha))
        sse = ((yc - Xc @ w) ** 2).sum()
        gamma = (alpha * ev / (lam + alpha * ev)).sum()
        lam = (gamma + 2e-6) / (w @ w + 2e-6)
        alpha = (len(y) - gamma + 2e-6) / (sse + 2e-6)
        if w_old is not None and np.abs(w_old - w).sum() < 1e-3:
            break
        w_old = w
    w = Vt.T @ (Vt @ (Xc.T @ yc) / (ev + lam / alpha))
    assert br.coef == pytest.approx(w, rel=1e-6)
    ard = GR.ard(g, FEATS)
    assert abs(ard.coef[2]) < 0.05 and ard.coef[0] == pytest.approx(2.0, abs=0.1)
    omp = GR.omp(g, FEATS, n_nonzero=2)
    assert np.count_nonzero(omp.coef) == 2 and omp.coef[2] == 0.0


def test_lasso_and_elastic_net_on_gram_meet_the_conditions_and_equal_mllib(spark, reg_data):
    df, X, y = reg_data
    g, n = GR.gram(df, FEATS, "y"), len(y)
    Xc, yc = X - X.mean(0), y - y.mean()
    for alpha, r in ((0.05, 1.0), (0.3, 1.0), (0.2, 0.5), (0.4, 0.1)):
        w = GR.elastic_net(g, FEATS, alpha, r).coef
        grad = Xc.T @ (yc - Xc @ w) / n - alpha * (1 - r) * w
        used = w != 0
        assert np.abs(grad[used] - alpha * r * np.sign(w[used])).max(initial=0) < 1e-8
        assert (np.abs(grad[~used]) <= alpha * r + 1e-8).all()
    t = L.assemble(df.withColumnRenamed("y", "label"), FEATS)
    assert GR.lasso(g, FEATS, 0.3).coef == pytest.approx(L.lasso(0.3, max_iter=500).setTol(1e-12).fit(t).coefficients.toArray(), abs=1e-3)
    assert GR.elastic_net(g, FEATS, 0.2, 0.5).coef == pytest.approx(
        L.elastic_net(0.2, 0.5, t, max_iter=500).setTol(1e-12).fit(t).coefficients.toArray(), abs=1e-3)
    assert GR.lasso(g, FEATS, 1e6).coef == pytest.approx(np.zeros(4))
    assert GR.lasso(g, FEATS, 1e6).intercept == pytest.approx(y.mean())


def _gram_of(X, y):
    return GR.Gram(float(len(y)), X.sum(0), y.sum(), X.T @ X, X.T @ y, y @ y)


@pytest.mark.parametrize("seed", range(40))
def test_least_angle_knots_are_lasso_solutions(seed):
    rng = np.random.default_rng(seed)
    n, p = int(rng.integers(12, 60)), int(rng.integers(1, 9))
    X = rng.normal(size=(n, p)) @ (np.eye(p) + 0.7 * rng.normal(size=(p, p)))     # correlated, so that columns leave the path
    y = X @ rng.normal(size=p) + rng.normal(size=n)
    if seed % 5 == 0:
        X[:, 0] = 3.0
    if seed % 7 == 0 and p > 2:
        X[:, 1] = X[:, 2]
    g, names = _gram_of(X, y), [str(i) for i in range(p)]
    Xc, yc = X - X.mean(0), y - y.mean()
    sse = lambda w: float(((yc - Xc @ w) ** 2).sum())
    path = GR.least_angle_path(g)
    assert all(a >= b - 1e-12 for (a, _), (b, _) in zip(path, path[1:]))
    knots = [a for a, _ in path if a > 1e-9]
    for a in knots + [0.5 * (x + z) for x, z in zip(knots, knots[1:])]:
        w, ref = GR.on_path(path, a), GR.lasso(g, names, a).coef
        assert sse(w) / 2 / n + a * np.abs(w).sum() == pytest.approx(sse(ref) / 2 / n + a * np.abs(ref).sum(), abs=1e-8)
    ols = sse(GR.ols(g, names).coef)
    assert sse(path[-1][1]) == pytest.approx(ols, abs=1e-7)
    assert sse(GR.lars(g, names).coef) == pytest.approx(ols, abs=1e-7)
    assert np.count_nonzero(GR.lars(g, names, 1).coef) <= 1


def test_lasso_lars_scales_columns_to_unit_length():
    rng = np.random.default_rng(1)
    X = rng.normal(size=(50, 3)) * [1.0, 10.0, 100.0]
    y = X @ [1.0, 0.2, 0.01] + rng.normal(size=50)
    g, names = _gram_of(X, y), ["a", "b", "c"]
    norm = np.linalg.norm(X - X.mean(0), axis=0)
    unit = _gram_of((X - X.mean(0)) / norm, y)
    assert GR.lasso_lars(g, names, 0.02).coef * norm == pytest.approx(GR.lasso(unit, names, 0.02).coef, abs=1e-9)
    assert not GR.lasso_lars(g, names, 1.0).coef.any()             # as in the reference's scores: the constant model


def test_gram_cv_one_scan_matches_refits(reg_data):
    df, _, _ = reg_data
    f = K.kfold(df, "id", 3, 1)
    cv = {(r["model"], r["fold"]): r["rmse"] for r in GR.cv_rmse(f, FEATS, "y", "fold", ["ols"]).collect()}
    for k in range(3):
        m = GR.fit(f.where(F.col("fold") != k), FEATS, "y")
        exp = m.transform(f.where(F.col("fold") == k)).select(
            F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)))).first()[0]
        assert cv[("ols", k)] == pytest.approx(exp, rel=1e-9)


def test_logistic_penalty_mapping_is_stationary(spark, reg_data):
    df, X, y = reg_data
    lab = (y > 3).astype(float)
    t = L.assemble(df.withColumn("label", (F.col("y") > 3).cast("double")), FEATS)
    C = 1.0
    m = L.logistic(C, 300, max_iter=200).fit(t)
    w, b = m.coefficients.toArray(), m.intercept
    p = 1 / (1 + np.exp(-(X @ w + b)))
    grad = C * X.T @ (p - lab) + w          # gradient of the C-form objective
    assert np.abs(grad).max() < 1e-2


def test_linear_regression_family(spark, reg_data):
    df, X, y = reg_data
    t = L.assemble(df.withColumnRenamed("y", "label"), FEATS)
    ols = L.linear().fit(t)
    assert ols.coefficients.toArray() == pytest.approx(GR.fit(df, FEATS, "y").coef, rel=1e-6)
    las = L.lasso(0.5).fit(t)
    assert abs(las.coefficients[2]) < 1e-6                    # L1 zeroes the useless feature
    en = L.elastic_net(0.5, 0.5, t).fit(t)
    assert np.abs(en.coefficients.toArray()).sum() < np.abs(ols.coefficients.toArray()).sum()


def test_trees_boosting_vote(spark, reg_data):
    df, _, _ = reg_data
    t = L.assemble(df.withColumn("label", (F.col("a") > 0).cast("double")), FEATS)
    tree = L.decision_tree("entropy", 2).fit(t)
    assert tree.transform(t).where("prediction = label").count() >= 290
    assert "If (feature 0" in tree.toDebugString
    ada = L.AdaBoostSAMME(n_estimators=4, max_depth=1).fit(t)
    assert ada.transform(t).where("prediction = label").count() >= 290
    models = [L.random_forest(5, 3).fit(t), L.logistic(1.0, 300, max_iter=20).fit(t), L.gaussian_nb().fit(t)]
    v = L.soft_vote(models, t)
    sums = v.select(F.aggregate("vote_probability", F.lit(0.0), lambda a, b: a + b).alias("s"))
    assert sums.agg(F.min("s"), F.max("s")).first() == pytest.approx((1.0, 1.0))
    assert v.count() == 300


def test_random_fourier_features_approximate_rbf(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(6, 3))
    df = spark.createDataFrame([(i, [float(v) for v in X[i]]) for i in range(6)], "id int, x array<double>")
    z = L.random_fourier_features(df, "x", 3, gamma=0.5, n_components=2000, seed=1)
    Z = np.array([r[0] for r in z.orderBy("id").select(vector_to_array("rff")).collect()])
    K_ = np.exp(-0.5 * ((X[:, None] - X[None]) ** 2).sum(-1))
    assert np.abs(Z @ Z.T - K_).max() < 0.1


def test_selection_grid_random_impute(spark, reg_data):
    df, _, _ = reg_data
    t = K.kfold(L.assemble(df.withColumn("label", (F.col("a") > 0).cast("double")), FEATS), "id", 3, 2)
    est = L.decision_tree()
    maps = M.union_grids(est, [{"maxDepth": [1, 2], "impurity": ["gini", "entropy"]}, {"maxDepth": [3]}])
    assert len(maps) == 5
    table, best, params = M.search(est, maps, t, "fold", M.accuracy_evaluator(), parallelism=2)
    assert table.count() == 5 and best is not None
    rs = M.sample_params(L.logistic(1.0, 300), {"regParam": ("loguniform", 1e-4, 1.0)}, 4, 7)
    assert len(rs) == 4 and all(1e-4 <= list(m.values())[0] <= 1.0 for m in rs)
    again = M.sample_params(L.logistic(1.0, 300), {"regParam": ("loguniform", 1e-4, 1.0)}, 4, 7)
    assert [list(m.values()) for m in rs] == [list(m.values()) for m in again]   # seeded
    sl = M.shortlist({"t": L.decision_tree("gini", 2), "nb": L.gaussian_nb()}, t, "fold",
                     M.accuracy_evaluator())
    assert sl.count() == 2
    oof = M.oof_predictions(L.decision_tree("gini", 2), t, "fold", ["id"])
    assert oof.count() == 300 and oof.select("id").distinct().count() == 300
    miss = df.withColumn("y", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("y")))
    fit = lambda known: Pipeline(stages=[VectorAssembler(inputCols=FEATS, outputCol="features"),
                                         L.linear("y")]).fit(known)
    filled = M.model_impute(miss, "y", fit)
    assert filled.where("y is null").count() == 0 and filled.count() == 300
