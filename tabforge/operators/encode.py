"""Encoders, scalers and binners.

Fitting is one aggregate job returning a bounded row (one statistic per
column, or the sorted category list); the fitted form is a set of SQL column
expressions with the statistics as literals, wrapped in ``ExprModel`` so it is
a ``pyspark.ml`` stage (pipelines, persistence, streaming ``transform``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quantiles as Q


def _lit_sql(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, bool):
        return "true" if v else "false"
    return f"CAST({float(v)!r} AS DOUBLE)" if isinstance(v, float) else str(v)


class ExprModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted transformer: output column -> SQL expression.

    ``exprs`` is JSON text of ``{name: sql}`` applied in one ``withColumns``.
    """

    exprs = Param(Params._dummy(), "exprs", "JSON object name -> SQL expression",
                  typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, exprs: str = "{}"):
        super().__init__()
        self._setDefault(exprs="{}")
        self._set(**self._input_kwargs)

    def expressions(self) -> dict[str, str]:
        return json.loads(self.getOrDefault(self.exprs))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({k: F.expr(v) for k, v in self.expressions().items()})


def expr_model(exprs: Mapping[str, str]) -> ExprModel:
    return ExprModel(exprs=json.dumps(dict(exprs)))


class FunctionTransformer(Transformer):
    """User function ``DataFrame -> DataFrame`` as a pipeline stage
    (``FunctionTransformer``). The function should use column expressions."""

    def __init__(self, fn):
        super().__init__()
        self.fn = fn

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fn(dataset)


# J5 / J6 / J7 -------------------------------------------------------------------------

class StandardScale(Estimator):
    """``(x - mean) / std`` with the *population* std (NumPy/scikit-learn);
    pyspark.ml's StandardScaler uses the sample std. Constant column -> 0."""

    def __init__(self, columns: Sequence[str], suffix: str = ""):
        super().__init__()
        self.columns, self.suffix = list(columns), suffix

    def _fit(self, dataset: DataFrame) -> ExprModel:
        aggs = []
        for c in self.columns:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        r = dataset.agg(*aggs).first()
        exprs = {}
        for c in self.columns:
            m, s = r[f"m_{c}"], r[f"s_{c}"]
            if m is None:
                exprs[c + self.suffix] = f"CAST(NULL AS DOUBLE)"
            elif not s:
                exprs[c + self.suffix] = f"CASE WHEN `{c}` IS NULL THEN NULL ELSE 0.0 END"
            else:
                exprs[c + self.suffix] = f"(`{c}` - {_lit_sql(float(m))}) / {_lit_sql(float(s))}"
        return expr_model(exprs)


class MinMaxScale(Estimator):
    """``(x - min) / (max - min)``; a constant column maps to 0."""

    def __init__(self, columns: Sequence[str], suffix: str = ""):
        super().__init__()
        self.columns, self.suffix = list(columns), suffix

    def _fit(self, dataset: DataFrame) -> ExprModel:
        aggs = []
        for c in self.columns:
            aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
        r = dataset.agg(*aggs).first()
        exprs = {}
        for c in self.columns:
            lo, hi = r[f"lo_{c}"], r[f"hi_{c}"]
            if lo is None:
                exprs[c + self.suffix] = "CAST(NULL AS DOUBLE)"
            elif hi == lo:
                exprs[c + self.suffix] = f"CASE WHEN `{c}` IS NULL THEN NULL ELSE 0.0 END"
            else:
                exprs[c + self.suffix] = (f"(`{c}` - {_lit_sql(float(lo))}) / "
                                          f"{_lit_sql(float(hi) - float(lo))}")
        return expr_model(exprs)


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                   suffix: str = "") -> DataFrame:
    """Fit on ``fit_on`` (default ``df``), apply to ``df``."""
    return StandardScale(columns, suffix).fit(fit_on if fit_on is not None else df).transform(df)


def minmax_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                 suffix: str = "") -> DataFrame:
    return MinMaxScale(columns, suffix).fit(fit_on if fit_on is not None else df).transform(df)


# J1 / J2 / J3 / J4 ---------------------------------------------------------------------

def sorted_categories(df: DataFrame, c: str) -> list:
    """Distinct non-null values in ascending order, collected: only for
    categorical columns. More than ``MAX_CATEGORIES`` raise an error."""
    found = (df.where(F.col(c).isNotNull()).select(c).distinct().limit(MAX_CATEGORIES + 1).collect())
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"{c} has more than {MAX_CATEGORIES} categories: it is no categorical column")
    return sorted(r[0] for r in found)


#: Most categories of an encoded column; more raise an error.
MAX_CATEGORIES = 100_000


def label_encoder(c: str, out: str) -> StringIndexer:
    """Classes sorted ascending (scikit-learn LabelEncoder order)."""
    return StringIndexer(inputCol=c, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid="keep")


def label_encode(df: DataFrame, c: str, out: str, fit_on: DataFrame | None = None
                 ) -> tuple[DataFrame, object]:
    """Returns ``(frame with int code, fitted StringIndexerModel)``."""
    model = label_encoder(c, out).fit(fit_on if fit_on is not None else df)
    return model.transform(df).withColumn(out, F.col(out).cast("int")), model


def label_decode(df: DataFrame, code: str, out: str, model) -> DataFrame:
    """J1 inverse (``inverse_transform``)."""
    return IndexToString(inputCol=code, outputCol=out, labels=model.labels).transform(
        df.withColumn(code, F.col(code).cast("double")))


def one_hot_columns(df: DataFrame, c: str, categories: Sequence | None = None,
                    prefix: str | None = None, fit_on: DataFrame | None = None
                    ) -> DataFrame:
    """One 0/1 double column per category, all categories kept.

    A NULL input gives all zeros (an unseen category too).
    """
    cats = list(categories) if categories is not None else sorted_categories(
        fit_on if fit_on is not None else df, c)
    p = prefix if prefix is not None else f"{c}_"
    return df.withColumns({f"{p}{v}": F.coalesce((F.col(c) == F.lit(v)).cast("double"),
                                                 F.lit(0.0)) for v in cats})


def one_hot_vector(index_col: str, out: str) -> OneHotEncoder:
    """J3 as an ML stage over an index column: every category kept."""
    return OneHotEncoder(inputCols=[index_col], outputCols=[out], dropLast=False)


def first_category_indicator(df: DataFrame, c: str, out: str | None = None,
                             fit_on: DataFrame | None = None) -> DataFrame:
    """1.0 where the value is the alphabetically first category, else 0.0
    (what assigning a K-column one-hot to one column leaves behind)."""
    src = fit_on if fit_on is not None else df
    first = src.agg(F.min(c).alias("m")).first()["m"]
    return df.withColumn(out or c, F.coalesce((F.col(c) == F.lit(first)).cast("double"),
                                              F.lit(0.0)))


# J8 / J9 / J10 ---------------------------------------------------------------------------

def equal_width_bins(df: DataFrame, c: str, bins: int = 10, out: str = "bin",
                     fit_on: DataFrame | None = None) -> DataFrame:
    """``pd.cut(x, bins)``: right-closed equal-width bins over [min, max],
    1-based codes, plus the interval ``(lo, hi]`` (first edge lowered by 0.1%
    of the range, as pandas does)."""
    src = fit_on if fit_on is not None else df
    r = src.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    lo, hi = float(r["lo"]), float(r["hi"])
    width = (hi - lo) / bins
    x = F.col(c).cast("double")
    code = F.least(F.greatest(F.ceil((x - F.lit(lo)) / F.lit(width)), F.lit(1)),
                   F.lit(bins)).cast("int")
    lo_edge = F.when(F.col(out) == 1, F.lit(lo - (hi - lo) * 0.001)).otherwise(
        F.lit(lo) + (F.col(out) - 1) * F.lit(width))
    return (df.withColumn(out, code)
              .withColumn(f"{out}_lo", lo_edge)
              .withColumn(f"{out}_hi", F.lit(lo) + F.col(out) * F.lit(width)))


def quantile_bins(df: DataFrame, c: str, q: int = 3, out: str = "qbin",
                  fit_on: DataFrame | None = None, one_hot: bool = True) -> DataFrame:
    """``pd.qcut(x, q)``: exact interpolated cut points, right-closed,
    0-based codes; optional one-hot columns ``{out}_{i}``."""
    src = fit_on if fit_on is not None else df
    cuts = Q.global_cuts(src, c, [i / q for i in range(1, q)])
    x = F.col(c)
    code = F.lit(q - 1)
    for i in reversed(range(len(cuts))):
        code = F.when(x <= F.lit(cuts[i]), F.lit(i)).otherwise(code)
    code = F.when(x.isNull(), F.lit(None)).otherwise(code).cast("int")
    res = df.withColumn(out, code)
    if one_hot:
        res = res.withColumns({f"{out}_{i}": F.coalesce((F.col(out) == i).cast("double"),
                                                        F.lit(0.0)) for i in range(q)})
    return res


def binarize(c: str, t: float) -> Column:
    """``Binarizer(threshold=t)``: 1.0 where x > t else 0.0."""
    return F.when(F.col(c).isNull(), F.lit(None).cast("double")).when(
        F.col(c) > F.lit(t), 1.0).otherwise(0.0)
