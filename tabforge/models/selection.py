"""Model selection.

Folds are a column (``operators.split.kfold``) of one frame, so every fit
reads the same cached rows and no positional slicing happens. Fold fits of
one or several estimators run as concurrent Spark jobs from a small driver
thread pool (``parallelism``), like ``CrossValidator(parallelism=...)``;
the executors do the work.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.files import stage_table


def rmse_evaluator(label: str = "label"):
    return RegressionEvaluator(metricName="rmse", labelCol=label)


def accuracy_evaluator(label: str = "label"):
    return MulticlassClassificationEvaluator(metricName="accuracy", labelCol=label)


def auc_evaluator(label: str = "label"):
    return BinaryClassificationEvaluator(metricName="areaUnderROC", labelCol=label)


def cv_scores(estimator, df: DataFrame, fold: str, evaluator, parallelism: int = 4
              ) -> list[tuple[int, float]]:
    """M1: ``(fold, metric)`` for each held-out fold."""
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())   # k values

    def one(f):
        m = estimator.fit(df.where(F.col(fold) != f))
        return f, float(evaluator.evaluate(m.transform(df.where(F.col(fold) == f))))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(one, folds))


def cv_table(spark: SparkSession, name: str, scores: Sequence[tuple[int, float]]) -> DataFrame:
    return spark.createDataFrame([(name, int(f), float(v)) for f, v in scores],
                                 "model string, fold int, value double")


def shortlist(candidates: Mapping[str, object], df: DataFrame, fold: str, evaluator,
              parallelism: int = 4) -> DataFrame:
    """M2/M3: fit every candidate on every fold; ``mean``, population ``std`` and
    ``worst`` per model, best model first (by the evaluator's direction), then
    smaller ``std``. ``worst`` is the worst fold: the least value where larger is
    better, the greatest otherwise."""
    spark = df.sparkSession
    tables = [cv_table(spark, n, cv_scores(est, df, fold, evaluator, parallelism))
              for n, est in candidates.items()]
    long = tables[0]
    for t in tables[1:]:
        long = long.unionByName(t)
    larger = evaluator.isLargerBetter()
    worst = F.min("value") if larger else F.max("value")
    return (long.groupBy("model").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                      worst.alias("worst"), F.count(F.lit(1)).alias("folds"))
            .orderBy(F.col("mean").desc() if larger else F.col("mean").asc(), F.col("std").asc()))


def union_grids(estimator, grids: Sequence[Mapping]) -> list:
    """M4: a list of dicts is a *union* of grids (each dict a Cartesian product)."""
    maps = []
    for g in grids:
        b = ParamGridBuilder()
        for name, values in g.items():
            b = b.addGrid(estimator.getParam(name), list(values))
        maps += b.build()
    return maps


def sample_params(estimator, space: Mapping[str, tuple], n_iter: int, seed: int) -> list:
    """M5/M6: seeded random search maps. ``space[name]`` is ``('uniform', lo, hi)``,
    ``('loguniform', lo, hi)``, ``('int', lo, hi)`` or ``('choice', [values])``."""
    rng = np.random.default_rng(seed)
    maps = []
    for _ in range(n_iter):
        pm = {}
        for name, spec in space.items():
            kind = spec[0]
            if kind == "uniform":
                v = float(rng.uniform(spec[1], spec[2]))
            elif kind == "loguniform":
                v = float(math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2]))))
            elif kind == "int":
                v = int(rng.integers(spec[1], spec[2] + 1))
            else:
                v = spec[1][int(rng.integers(0, len(spec[1])))]
            pm[estimator.getParam(name)] = v
        maps.append(pm)
    return maps


def search(estimator, maps: list, df: DataFrame, fold: str, evaluator, parallelism: int = 4, folds: int = 3):
    """M4/M5/M7: cross-validated search over ``maps`` on a fold column; returns
    ``(table(params, metric), best_model, best_params)`` where the best model is
    refit on all rows. The frame is written once, and every fit reads from it the
    columns that its stages use: no join is done again, no wide row is cached and
    no row passes through Python."""
    spark = df.sparkSession
    df = stage_table(df, scratch_dir(spark, "search"))
    if df.where(~F.coalesce(F.col(fold).between(0, folds - 1), F.lit(False))).take(1):
        raise ValueError(f"{fold} must be 0 to {folds - 1}")
    parts = [(df.where(F.col(fold) != f), df.where(F.col(fold) == f)) for f in range(folds)]
    if not all(p.take(1) for pair in parts for p in pair):
        raise ValueError("a fold leaves no rows for training or validation")

    def one(job):
        (train, valid), pm = job
        return float(evaluator.evaluate(estimator.fit(train, pm).transform(valid)))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        found = np.array(list(pool.map(one, itertools.product(parts, maps)))).reshape(folds, len(maps))
    metrics = found.mean(axis=0).tolist()
    rows = [(json.dumps({p.name: v for p, v in m.items()}, default=str), float(a)) for m, a in zip(maps, metrics)]
    table = spark.createDataFrame(rows, "params string, metric double")
    better = max if evaluator.isLargerBetter() else min
    best_i = metrics.index(better(metrics))
    best_params = {p.name: v for p, v in maps[best_i].items()}
    return table, estimator.fit(df, maps[best_i]), best_params


def oof_predictions(estimator, df: DataFrame, fold: str, keep: Sequence[str]) -> DataFrame:
    """Out-of-fold predictions: each fold scored by the model fit on the others."""
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())   # k values
    out = None
    for f in folds:
        m = estimator.fit(df.where(F.col(fold) != f))
        part = m.transform(df.where(F.col(fold) == f)).select(*keep, fold, "prediction")
        out = part if out is None else out.unionByName(part)
    return out


def model_impute(df: DataFrame, target: str, model_fit: Callable[[DataFrame], object],
                 out: str | None = None) -> DataFrame:
    """M9: learn ``target`` on the rows where it is known, then fill the missing
    rows with the model's prediction in the same frame
    (``coalesce(x, prediction)``): no split-off part, concat or sort, and no key
    needed, since the fitted model is a row-local projection.

    ``model_fit(known)`` returns a fitted transformer writing ``prediction``.
    """
    model = model_fit(df.where(F.col(target).isNotNull()))
    scored = model.transform(df)
    return scored.withColumn(out or target, F.coalesce(F.col(target), F.col("prediction"))).drop(
        "prediction")


def repeated_holdout(estimators: Mapping[str, object], df: DataFrame, key: str, reps: int,
                     test_ratio: float, label: str, parallelism: int = 4) -> DataFrame:
    """K7: for seed r in 0..reps-1, hash hold-out, fit each model on train, score
    test MSE and accuracy; long ``(rep, model, metric, value)`` table."""
    from ..operators.split import random_holdout
    spark = df.sparkSession
    jobs = list(itertools.product(range(reps), estimators.items()))

    def one(job):
        r, (name, est) = job
        s = random_holdout(df, key, test_ratio, r)
        m = est.fit(s.where(F.col("split") == "train"))
        p = m.transform(s.where(F.col("split") == "test"))
        row = p.agg(F.avg(F.pow(F.col("prediction") - F.col(label), 2)).alias("mse"),
                    F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("acc")).first()
        return [(r, name, "mse", float(row["mse"] or 0.0)), (r, name, "accuracy", float(row["acc"] or 0.0))]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = [x for res in pool.map(one, jobs) for x in res]
    return spark.createDataFrame(rows, "rep int, model string, metric string, value double")
