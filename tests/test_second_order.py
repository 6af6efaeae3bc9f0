"""Second-order boosting: splits and leaf values equal a NumPy brute force; missing values, penalties, sampling, files."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.models import boosting as B

COLS = ["a", "b", "c"]


def table(spark, n=300, seed=0, classes=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random((n, 3)) < 0.08] = np.nan
    z = np.nan_to_num(x)
    y = z[:, 0] * 2 + (z[:, 1] > 0.3) - z[:, 2] ** 2 + rng.normal(scale=0.2, size=n)
    if classes == 2:
        y = (y > 0).astype(float)
    elif classes:
        y = np.digitize(y, np.quantile(y, np.linspace(0, 1, classes + 1)[1:-1])).astype(float)
    rows = [(i, *(None if math.isnan(v) else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(4)
    return df, x, y


def brute(x, y, p, cuts, rounds):
    """Depth-first growth of every tree by trying each cut of each feature on the rows themselves."""
    margin = np.full((len(x), p.outputs()), p.base_margin())
    soft = lambda g: math.copysign(max(abs(g) - p.reg_alpha, 0), g)
    score = lambda g, h: soft(g) ** 2 / (h + p.reg_lambda)
    out = []
    for _ in range(rounds):
        g, h = B.gradients(margin, y, p.objective)
        step = np.zeros_like(margin)
        trees = []
        for k in range(p.outputs()):
            def grow(rows, depth):
                gs, hs = g[rows, k], h[rows, k]
                value = -p.eta * soft(gs.sum()) / (hs.sum() + p.reg_lambda)
                best = None
                for f in range(x.shape[1]):
                    v, known = x[rows, f], ~np.isnan(x[rows, f])
                    for b, c in enumerate([*cuts[f], math.inf], 1):
                        for left_too in (1, 0):
                            left = np.where(known, v < c, bool(left_too))
                            if not left.any() or left.all() or not known.any():
                                continue
                            if (known & left).sum() == 0:
                                continue                          # a cut below all known values
                            hl, hr = hs[left].sum(), hs[~left].sum()
                            if hl < p.min_child_weight or hr < p.min_child_weight:
                                continue
                            gain = score(gs[left].sum(), hl) + score(gs[~left].sum(), hr) - score(gs.sum(), hs.sum())
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, c, left)
                if depth == p.max_depth or best is None:
                    return value, rows
                sides = [grow(rows[best[3]], depth + 1), grow(rows[~best[3]], depth + 1)]
                if best[0] < p.gamma and all(len(s) == 2 for s in sides):
                    return value, rows
                return best[1], best[2], best[0], sides
            tree = grow(np.arange(len(x)), 0)
            trees.append(tree)

            def fill(t):
                if len(t) == 2:
                    step[t[1], k] = t[0]
                else:
                    for s in t[3]:
                        fill(s)
            fill(tree)
        margin = margin + step
        out.append(trees)
    return out, margin


def same(tree: B.Tree, i: int, want) -> None:
    if len(want) == 2:
        assert tree.left[i] < 0
        assert tree.value[i] == pytest.approx(want[0], rel=1e-9, abs=1e-12)
        return
    assert tree.left[i] >= 0
    assert tree.gain[i] == pytest.approx(want[2], rel=1e-7)
    same(tree, tree.left[i], want[3][0])
    same(tree, tree.right[i], want[3][1])


@pytest.mark.parametrize("kw, classes", [
    (dict(objective="reg:squarederror", max_depth=3), 0),
    (dict(objective="reg:squarederror", max_depth=4, gamma=1.5, reg_alpha=0.7, reg_lambda=3.0, min_child_weight=5.0), 0),
    (dict(objective="binary:logistic", max_depth=3, eta=0.5), 2),
    (dict(objective="multi:softmax", max_depth=2, n_classes=3), 3)])
def test_trees_equal_a_numpy_brute_force(spark, kw, classes):
    df, x, y = table(spark, classes=classes)
    p = B.Params(n_estimators=3, max_bins=40, **kw)
    model = B.fit_boosted(df, COLS, "y", p, every=2)
    src = df.select(F.array(*COLS).alias("x"))
    cuts = B.quantile_cuts(src, "x", 3, 40)
    want, margin = brute(x, y, p, cuts, 3)
    assert len(model.rounds) == 3
    assert np.allclose(model.margins(x), margin, rtol=1e-9, atol=1e-9)
    for got, trees in zip(model.rounds, want):
        for a, b in zip(got, trees):
            same(a, 0, b)
    rows = model.transform(df, "p", "probs").orderBy("id").collect()
    probs = B.probabilities(margin, p.objective)
    if classes == 3:
        assert [r["p"] for r in rows] == [float(k) for k in probs.argmax(1)]
        assert np.allclose([r["probs"] for r in rows], probs)
    elif classes == 2:
        assert np.allclose([r["probs"][1] for r in rows], probs[:, 0])
    else:
        assert np.allclose([r["p"] for r in rows], margin[:, 0])


def test_losses_of_the_evaluation_list(spark):
    df, x, y = table(spark, classes=2)
    valid, vx, vy = table(spark, 120, 7, classes=2)
    p = B.Params("binary:logistic", 4, max_depth=2)
    model = B.fit_boosted(df, COLS, "y", p, evals={"valid": valid})
    assert [(r, s) for r, s, *_ in model.evals] == [(r, s) for r in range(4) for s in ("train", "valid")]
    for r, s, loss, miss in model.evals:
        part = B.BoostedTrees(p, COLS, 3, model.rounds, [], r)
        m, t = (part.margins(x), y) if s == "train" else (part.margins(vx), vy)
        a, b = B.losses(m, t, p.objective)
        assert loss == pytest.approx(a.mean()) and miss == pytest.approx(b.mean())
    train = [e[2] for e in model.evals if e[1] == "train"]
    assert train == sorted(train, reverse=True)


def test_early_stop_keeps_the_best_round(spark):
    df, _, _ = table(spark, 60, 1)
    valid, _, _ = table(spark, 60, 2)
    noise = valid.withColumn("y", -F.col("y"))                      # every round makes it worse
    p = B.Params("reg:squarederror", 30, max_depth=3, early_stopping_rounds=2, base_score=0.0)
    model = B.fit_boosted(df, COLS, "y", p, evals={"valid": noise})
    assert model.best_round == 0 and len(model.rounds) <= 4


def test_weights_repeat_rows(spark):
    df, x, _ = table(spark, 150, 3)
    twice = df.withColumn("w", F.when(F.col("id") % 3 == 0, 2.0).otherwise(1.0))
    cuts = [np.unique(x[~np.isnan(x[:, f]), f])[1:] for f in range(3)]
    p = B.Params(n_estimators=2, max_depth=2)
    a = B.fit_boosted(twice, COLS, "y", p, weight="w", cuts=cuts)
    b = B.fit_boosted(df.unionByName(df.where("id % 3 = 0")), COLS, "y", p, cuts=cuts)
    assert np.allclose(a.margins(x), b.margins(x))
    assert all(len(c) < 20 for c in B.quantile_cuts(twice.select(F.array(*COLS).alias("x"), "w"), "x", 3, 20, "w"))


def test_weighted_cuts_share_the_weight(spark):
    rows = [(float(v), 9.0 if v < 100 else 1.0) for v in range(1000)]
    df = spark.createDataFrame(rows, "v double, w double").select(F.array("v").alias("x"), "w")
    cuts = B.quantile_cuts(df, "x", 1, 9, "w")[0]
    assert len(cuts) == 8 and sum(c <= 101 for c in cuts) == 4          # 900 of 1,800 lie below 100
    assert all(abs(c - e) <= 25 for c, e in zip(cuts[4:], [200, 400, 600, 800]))


def test_sampling_is_seeded_and_uses_its_share(spark):
    df, x, _ = table(spark, 400, 4)
    p = B.Params(n_estimators=3, max_depth=2, subsample=0.5, colsample=0.34)
    a, b = B.fit_boosted(df, COLS, "y", p), B.fit_boosted(df.repartition(7), COLS, "y", p)
    assert np.allclose(a.margins(x), b.margins(x))
    assert all(len({f for f in t.feature if f >= 0}) == 1 for r in a.rounds for t in r)
    assert all(120 < t.cover[0] < 280 for r in a.rounds for t in r)
    rid = np.arange(20_000, dtype=np.int64) * 7919
    assert abs(B._drawn(rid, 1, 2, 0.3).mean() - 0.3) < 0.02


def test_saved_model_predicts_the_same(spark, tmp_path):
    df, x, _ = table(spark, 100, 5, classes=3)
    model = B.fit_boosted(df, COLS, "y", B.Params("multi:softmax", 2, n_classes=3, max_depth=2))
    model.save(spark, str(tmp_path / "m"))
    again = B.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert np.array_equal(again.margins(x), model.margins(x)) and again.evals == [tuple(e) for e in model.evals]
    assert model.importance("weight") == again.importance("weight")
    inner = sum(1 for d in model.dump() if d[5] >= 0)
    assert inner == sum(model.importance("weight").values())


def test_odd_tables(spark):
    schema = "id int, x array<double>, y double"
    rows = [(1, None, 1.0), (2, [1.0, None], 2.0), (3, [float("nan"), 2.0], None), (4, [3.0, 5.0], 4.0)]
    df = spark.createDataFrame(rows, schema)
    model = B.fit_boosted(df, "x", "y", B.Params(n_estimators=2, min_child_weight=0.0))
    assert model.transform(df).where("prediction is not null").count() == 4
    empty = B.fit_boosted(spark.createDataFrame([], schema), "x", "y", B.Params(n_estimators=1))
    assert [r["prediction"] for r in empty.transform(df).collect()] == [0.5] * 4


def test_search_by_shuffle_equals_the_one_task(spark, monkeypatch):
    df, x, _ = table(spark, 200, 6, classes=3)
    p = B.Params("multi:softmax", 2, max_depth=3, n_classes=3)
    a = B.fit_boosted(df, COLS, "y", p)
    monkeypatch.setattr(B, "ONE_TASK_BYTES", -1)
    b = B.fit_boosted(df, COLS, "y", p)
    assert np.allclose(a.margins(x), b.margins(x)) and [t.feature for r in a.rounds for t in r] == [t.feature for r in b.rounds for t in r]
    monkeypatch.setattr(B, "MOST_CELLS", 3 * 256)
    c = B.fit_boosted(df, COLS, "y", p)
    assert np.allclose(a.margins(x), c.margins(x))
