"""Kernels and searches whose cost must not outgrow the input: same results as plain formulas, rows read once."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabforge.models import boosting as B
from tabforge.models import estimators as L
from tabforge.models import forest as F_
from tabforge.models import selection as M
from tabforge.models import sgd as SGD
from tabforge.operators import knn as KNN
from tabforge.operators import split as K


def brute(q, r, k):
    out = {}
    for qi, qv in zip(q["id"], q["vec"]):
        d = [(float(((qv - v) ** 2).sum()), i) for i, v in zip(r["id"], r["vec"]) if i != qi and np.isfinite(((qv - v) ** 2).sum())]
        out[qi] = sorted(d)[:k]
    return out


@pytest.mark.parametrize("scale", [1.0, 1e-160, 1e160])
def test_bounded_distances_are_exact(monkeypatch, scale):
    """Copies, far-off means, a vector of NaN and overflowing squares, in several blocks of queries and references."""
    monkeypatch.setattr(KNN, "QUERY_ROWS", 16)
    monkeypatch.setattr(KNN, "FIRST_ROWS", 8)
    rng = np.random.default_rng(1)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.concatenate([rng.normal(size=(40, 5)), np.repeat(rng.normal(size=(3, 5)), 8, axis=0), 1e6 + rng.normal(size=(20, 5)) * 1e-3]) * scale
        x[7] = np.nan
        r = pd.DataFrame({"id": rng.permutation(len(x)), "vec": list(x), "label": rng.integers(0, 3, len(x))})
        found = KNN._block_topk(4, True, 16 * 8 * 10)(r[["id", "vec"]], r)
        want = brute(r, r, 4)
    for qi, g in found.groupby("query_id"):
        got = [(d, i) for d, i in zip(g["dist"], g["nbr_id"]) if not pd.isna(i)]
        assert [i for _, i in got] == [i for _, i in want[qi]] and np.allclose([d for d, _ in got], np.sqrt([d for d, _ in want[qi]]))


def test_a_task_sends_one_row_for_each_node_and_feature(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    df = spark.createDataFrame([([float(v) for v in r], float(r[0] > 0)) for r in x], "x array<double>, y double")
    p = B.Params(n_estimators=1, max_depth=2)
    rows = df.selectExpr("x", "y", "1d w", "0 part", "xxhash64(x, y) rid")
    cuts = B.quantile_cuts(rows, "x", 3, 255)
    data = B._binned(rows, cuts, 1, 0.5).repartition(2).localCheckpoint()
    tree = B.Tree()
    tree.add(0.0, 0.0)
    level = B._level(data, p, 3, 0, [], [tree], [(0, 0)], [np.arange(3)], True, 257, False)
    assert level.where("k >= 0").count() == 2 * 3 and level.where("k = -1").count() == 2
    found = {r["k"]: r for r in B._best_splits(level, p, 257)}
    y = (x[:, 0] > 0).astype(float)
    assert found[0]["f"] == 0 and found[0]["n"] == 400 and np.isclose(found[-1]["g"] / found[-1]["n"], ((0.5 - y) ** 2).mean())


def test_arrow_columns():
    rows = np.arange(12, dtype=np.uint8).reshape(4, 3)
    assert (B._bytes_matrix(B._bytes_column(rows).slice(1, 2), 3) == rows[1:3]).all()
    whole = pa.array([[1.0, None], [2.0, 3.0]], pa.list_(pa.float64()))
    odd = pa.array([[1.0, None, 5.0], None, [2.0]], pa.list_(pa.float64()))
    assert np.array_equal(B._column_matrix(whole, 2), [[1, np.nan], [2, 3]], equal_nan=True)
    assert np.array_equal(B._column_matrix(odd, 2), [[1, np.nan], [np.nan, np.nan], [2, np.nan]], equal_nan=True)


def test_sgd_reads_arrays_side_by_side(spark, monkeypatch):
    monkeypatch.setattr("pyspark.sql.DataFrame.mapInPandas", None)
    df = spark.sql("select double(id % 7) a, double(id % 5) b, double(id % 7) * 2 y from range(400)")
    m = SGD.fit_sgd(df, ["a", "b"], "y", eta0=0.02, epochs=20)
    assert np.allclose(m.coef, [2, 0], atol=0.3) and m.history == sorted(m.history, reverse=True)
    assert SGD.fit_sgd(df.where("false"), ["a", "b"], "y").coef.tolist() == [0, 0]


def test_repetitions_do_not_multiply_rows(spark):
    df = spark.sql("select if(id = 3, null, id) id, if(id = 5, null, double(id * id)) y from range(200)")
    found = K.repeated_holdout_baseline(df, "id", "y", 4, 0.3)
    for r in found.collect():
        t = df.withColumn("t", K.hash_col("id", r["rep"]) < int(round(0.3 * K.HASH_P)))
        m = t.where("not t").agg(F.avg("y")).first()[0]
        e = t.where("t").agg(F.avg((F.col("y") - m) ** 2), F.count("*")).first()
        assert np.isclose(r["mse"], e[0]) and r["n_test"] == e[1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 4 and plan.index("Generate") < plan.index("Aggregate")      # above it: on one row
    assert K.repeated_holdout_baseline(df.where("false"), "id", "y", 4, 0.3).count() == 0


def test_search_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.sql("select double(id % 11) x, double(id % 11) * 3 + id % 2 label, int(id % 3) fold from range(300)").mapInArrow(
        count, "x double, label double, fold int")
    t = L.assemble(df, ["x"])
    est = LinearRegression(solver="normal")
    maps = M.union_grids(est, [{"regParam": [0.0, 5.0]}])
    table, best, params = M.search(est, maps, t, "fold", M.rmse_evaluator(), parallelism=2)
    assert seen.value == 300 and params == {"regParam": 0.0} and best.summary.numInstances == 300
    want = [np.mean([v for _, v in M.cv_scores(est.copy(m), t, "fold", M.rmse_evaluator())]) for m in maps]
    assert np.allclose(sorted(r["metric"] for r in table.collect()), sorted(want))
    for bad in ("if(x = 1, null, fold)", "fold + 1", "0"):
        with pytest.raises(ValueError):
            M.search(est, maps, t.withColumn("fold", F.expr(bad)), "fold", M.rmse_evaluator())


def test_forest_grows_on_counted_cells(spark):
    """Every row is counted in its cell, the trees see cells, and the fit is MLlib's up to the bootstrap draws."""
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 60, 6000), rng.integers(0, 3, 6000)], 1)
    y = np.where(x[:, 0] > 20, 10.0, 0.0) + 5.0 * x[:, 1] + rng.normal(size=6000)
    df = L.assemble(spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, label double"), ["a", "b"])
    forest = F_.CellForestRegressor(L.random_forest(5, 8, regression=True))
    forest.forest.setFeatureSubsetStrategy("all")
    cuts = [F_.cut_points(c.astype(float), 32) for c in x.T]
    assert len(cuts[0]) <= 31 and cuts[1].tolist() == [0.5, 1.5]
    cells = F_._count_cells(df.select(F.col("a").alias("x0"), F.col("b").alias("x1"), F.col("label").alias("y")), cuts, 5, 1).toPandas()
    assert cells["cell"].is_unique and len(cells) <= (len(cuts[0]) + 1) * 3
    assert all(abs(cells[f"w{t}"].sum() - 6000) < 400 and abs(cells[f"s{t}"].sum() - y.sum()) < 0.1 * y.sum() for t in range(5))
    got, want = (m.transform(df).select("a", "b", "label", "prediction").toPandas() for m in (forest.fit(df), forest.forest.fit(df)))
    both = got.merge(want.drop_duplicates(["a", "b"]), on=["a", "b"])
    assert len(both) == 6000 and np.abs(both["prediction_x"] - both["prediction_y"]).mean() < 0.25
    assert isinstance(forest.fit(df), F_.CellForestModel)
    one = df.where("a = 1 and b = 1").withColumn("label", F.lit(2.0))           # one cell, no cut
    assert {r["prediction"] for r in forest.fit(one).transform(df).collect()} == {2.0}


def test_forest_on_rows_where_cells_are_many(spark, monkeypatch):
    monkeypatch.setattr(F_, "CELL_LIMIT", 8)
    df = L.assemble(spark.range(40).selectExpr("double(id) a", "double(id) label"), ["a"])
    assert not isinstance(F_.CellForestRegressor(L.random_forest(2, 2, regression=True)).fit(df), F_.CellForestModel)
    with pytest.raises(Exception, match="(?i)null"):
        F_.CellForestRegressor(L.random_forest(2, 2, regression=True)).fit(df.withColumn("label", F.lit(None).cast("double")))
