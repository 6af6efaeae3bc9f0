"""Prediction-side operators.

All are column expressions or keyed joins on a prediction frame; nothing is
re-ordered, so outputs stay keyed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rule_chain
from .lookup import keyed_update


def group_rule_prediction(df: DataFrame, kind: str, group: str, rate: str,
                          out: str = "prediction", require_group: bool = True,
                          sentinel: str = "Alone") -> DataFrame:
    """Rule classifier from group survival rates.

    Start at 0; a 'Woman' gets 1; a 'Woman' in a (non-sentinel, when
    ``require_group``) group whose rate is 0 gets 0; a 'Boy' whose group rate
    is 1 gets 1. Later rules win (B15).
    """
    woman = F.col(kind) == "Woman"
    dead_group = woman & (F.col(rate) == 0)
    if require_group:
        dead_group = dead_group & (F.col(group) != F.lit(sentinel))
    boy_saved = (F.col(kind) == "Boy") & (F.col(rate) == 1)
    rules = [(woman, 1), (dead_group, 0), (boy_saved, 1)]
    return df.withColumn(out, rule_chain(rules, 0))


def ensemble_argmax(long_probs: DataFrame, key: str, probs: str, n_classes: int,
                    out: str = "prediction") -> DataFrame:
    """Sum class probabilities over models per key, then argmax (first
    maximum: lowest class on ties).

    ``long_probs`` has one row per (key, model) with an array of ``n_classes``
    probabilities. One partial aggregate with a sum per class: one shuffle, and a
    key with many model rows never gathers in one buffer.
    """
    summed = long_probs.groupBy(key).agg(*[
        F.sum(F.get(F.col(probs), F.lit(i))).alias(f"_p{i}") for i in range(n_classes)])
    scores = F.array(*[F.col(f"_p{i}") for i in range(n_classes)])
    best = F.array_max(scores)
    return summed.select(key, (F.array_position(scores, best) - 1).cast("int").alias(out),
                         best.alias(f"{out}_score"))


def keyed_predictions(model, df: DataFrame, key: str, name: str = "prediction",
                      cast: str = "int") -> DataFrame:
    """Batch prediction as a keyed two-column frame (submission layout)."""
    return model.transform(df).select(key, F.col("prediction").cast(cast).alias(name))


def override_predictions(base: DataFrame, model_preds: DataFrame, key: str,
                         columns: Sequence[str]) -> DataFrame:
    """Model predictions replace rule predictions for the rows they cover."""
    return keyed_update(base, model_preds, key, columns)
