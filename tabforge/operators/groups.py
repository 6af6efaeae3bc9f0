"""Group statistics and aggregations.

Pandas ``groupby(...).transform(f)`` broadcasts a group statistic back to the
rows. Here that is always *aggregate, then join back*: the aggregate runs with
map-side partial aggregation, so a key that holds a third of all rows costs one
partial row per task instead of one task holding the whole group (which an
unordered ``Window.partitionBy`` would do). The joined-back side is one row per
group; adaptive execution broadcasts it when its measured size is small and
otherwise splits skewed partitions of the row side (left outer join, row side
on the left).

NULL keys: an equi-join never matches NULL, so rows with a NULL key get NULL
statistics, which is pandas' behaviour (it drops NaN keys from groups).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col
from . import quantiles as Q
from .lookup import salted_left_join


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_stats(df: DataFrame, keys: str | Sequence[str],
                aggs: Mapping[str, Column]) -> DataFrame:
    """One row per group with named aggregates (partial aggregation)."""
    return df.groupBy(*_keys(keys)).agg(*[c.alias(n) for n, c in aggs.items()])


def with_group_stats(df: DataFrame, keys: str | Sequence[str],
                     aggs: Mapping[str, Column],
                     exclude: Column | None = None) -> DataFrame:
    """Attach group aggregates to every row.

    ``exclude`` removes rows (e.g. a sentinel group such as 'Alone') *before*
    grouping, so one huge sentinel key never reaches the aggregate; those rows
    get NULL statistics and the caller sets them with ``when``.
    """
    ks = _keys(keys)
    src = df if exclude is None else df.where(~F.coalesce(exclude, F.lit(False)))
    stats = group_stats(src, ks, aggs)
    # excluded and NULL-key rows never match: salted so they do not pile up in one task
    return salted_left_join(df, stats, ks, exclude)


def group_size(df: DataFrame, keys: str | Sequence[str], name: str = "group_size",
               count_col: str | None = None, sentinel: tuple[str, object] | None = None
               ) -> DataFrame:
    """Number of rows in each row's group (``transform('count')``).

    ``count_col`` counts non-null values of that column (pandas ``count``);
    ``sentinel=(col, value)`` forces size 1 for the sentinel group without
    aggregating it.
    """
    ks = _keys(keys)
    counted = F.count(col(count_col)) if count_col else F.count(F.lit(1))
    exclude = None
    if sentinel is not None:
        exclude = F.col(sentinel[0]) == F.lit(sentinel[1])
    out = with_group_stats(df, ks, {name: counted}, exclude=exclude)
    if sentinel is not None:
        out = out.withColumn(
            name, F.when(F.col(sentinel[0]) == F.lit(sentinel[1]), F.lit(1).cast("long"))
            .otherwise(F.col(name)))
    return out


def group_count_if(df: DataFrame, keys: str | Sequence[str], cond: Column,
                   name: str) -> DataFrame:
    """Count of rows in the group satisfying ``cond``."""
    return with_group_stats(df, keys, {name: F.count_if(F.coalesce(cond, F.lit(False)))})


def group_rate(train: DataFrame, keys: str | Sequence[str], target: str,
               positive=1, name: str = "rate",
               exclude: Column | None = None) -> DataFrame:
    """Target encoding table ``(keys, rate, n)`` fitted on ``train`` only.

    ``rate = count(target == positive) / count(*)``; returned as a table so it
    can be mapped onto any frame with ``operators.lookup.map_with_fallback``.
    """
    src = train if exclude is None else train.where(~F.coalesce(exclude, F.lit(False)))
    return src.groupBy(*_keys(keys)).agg(
        (F.count_if(F.col(target) == F.lit(positive)) / F.count(F.lit(1))).alias(name),
        F.count(F.lit(1)).alias(f"{name}_n"))


def leave_one_out(df: DataFrame, keys: str | Sequence[str], flag: Column,
                  value: ColumnOrName, prefix: str = "loo") -> DataFrame:
    """Group count/sum over flagged rows, minus the row's own contribution.

    For flagged rows: ``count = n_flagged - 1``, ``sum = s_flagged - own``
    (own NULL counts as 0); unflagged rows keep the full group figures.
    ``rate = sum / nullif(count, 0)`` (B4).
    """
    f = F.coalesce(flag, F.lit(False))
    v = F.coalesce(col(value).cast("double"), F.lit(0.0))
    tmp = df.withColumn(f"_{prefix}_f", f).withColumn(f"_{prefix}_v", v)
    out = with_group_stats(tmp, keys, {
        f"_{prefix}_n": F.count_if(F.col(f"_{prefix}_f")),
        f"_{prefix}_s": F.sum(F.when(F.col(f"_{prefix}_f"), F.col(f"_{prefix}_v"))
                             .otherwise(F.lit(0.0))),
    })
    fl = F.col(f"_{prefix}_f")
    n = F.when(fl, F.col(f"_{prefix}_n") - 1).otherwise(F.col(f"_{prefix}_n"))
    s = F.when(fl, F.col(f"_{prefix}_s") - F.col(f"_{prefix}_v")).otherwise(F.col(f"_{prefix}_s"))
    return (out.withColumn(f"{prefix}_count", n)
               .withColumn(f"{prefix}_sum", s)
               .withColumn(f"{prefix}_rate", F.try_divide(F.col(f"{prefix}_sum"),
                                                          F.nullif(F.col(f"{prefix}_count"), F.lit(0))))
               .drop(f"_{prefix}_f", f"_{prefix}_v", f"_{prefix}_n", f"_{prefix}_s"))


def group_median_fill(df: DataFrame, keys: str | Sequence[str],
                      columns: Sequence[str]) -> DataFrame:
    """Fill NULLs of each column with its group median (exact, interpolated).

    All columns share one grouping; a group whose values are all NULL stays
    NULL. Medians come from ``quantiles.group_quantiles`` which bounds the
    work per task for hot groups.
    """
    ks = _keys(keys)
    med = Q.group_quantiles_multi(df, ks, list(columns), 0.5, prefix="_med_")
    out = salted_left_join(df, med, ks)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in columns}
                           ).drop(*[f"_med_{c}" for c in columns])


# Global imputation ---------------------------------------------------

def mode_value(df: DataFrame, c: str) -> DataFrame:
    """One-row frame with the most frequent non-null value (lowest on ties).

    Exact and bounded: ``groupBy(value).count()`` is partially aggregated, and
    the top-1 is a per-partition top-1 merged on the driver side of the plan.
    """
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), F.col(c).asc()).limit(1).select(
        F.col(c).alias("mode"))


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact interpolated medians of several columns (one small row)."""
    row = Q.global_quantiles(df, columns, 0.5)
    return {c: row[c] for c in columns}


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    out = {}
    for c in columns:
        r = mode_value(df, c).first()
        out[c] = None if r is None else r["mode"]
    return out


def fill_with_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with each column's mode."""
    modes = {k: v for k, v in column_modes(df, columns).items() if v is not None}
    return df.fillna(modes) if modes else df


def global_impute(df: DataFrame, columns: Sequence[str] | None = None,
                  fit_on: DataFrame | None = None) -> DataFrame:
    """Per column, mode for strings and median for numbers, fitted on
    ``fit_on`` (default: ``df``) and applied as literals (one small row)."""
    src = fit_on if fit_on is not None else df
    columns = list(columns) if columns is not None else list(df.columns)
    types = dict(src.dtypes)
    nums = [c for c in columns if types[c] not in ("string", "boolean")]
    strs = [c for c in columns if types[c] == "string"]
    fills: dict[str, object] = {}
    if nums:
        fills.update({k: v for k, v in column_medians(src, nums).items() if v is not None})
    fills.update({k: v for k, v in column_modes(src, strs).items() if v is not None})
    exprs = {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in fills.items()}
    return df.withColumns(exprs) if exprs else df


def simple_impute(df: DataFrame, columns: Sequence[str], strategy: str = "median",
                  fill_value=None, fit_on: DataFrame | None = None) -> DataFrame:
    """SimpleImputer strategies median / mean / most_frequent / constant.

    ``median`` is the interpolated median (pyspark.ml's Imputer returns an
    element of the data instead, e.g. 3.0 rather than 6.5 for {1,3,10,11}).
    """
    src = fit_on if fit_on is not None else df
    if strategy == "median":
        fills = column_medians(src, columns)
    elif strategy == "mean":
        row = src.agg(*[F.avg(c).alias(c) for c in columns]).first()
        fills = {c: row[c] for c in columns}
    elif strategy == "most_frequent":
        fills = column_modes(src, columns)
    elif strategy == "constant":
        fills = {c: fill_value for c in columns}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    types = dict(df.dtypes)
    exprs = {c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
             for c, v in fills.items() if v is not None}
    return df.withColumns(exprs) if exprs else df


# Reports -------------------------------------------------------------------

#: Columns up to which correlations are aggregate expressions; p^2 of them make a plan.
MOST_CORR_EXPRESSIONS = 20


def corr_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair over the rows where both are known, as a
    long table ``(col_a, col_b, corr)``; NULL where a column does not vary. Few columns are one
    aggregate in the JVM, more are masked products (``corr_products``)."""
    if len(columns) > MOST_CORR_EXPRESSIONS:
        return corr_products(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs.append(F.corr(F.when(both, F.col(a).cast("double")),
                           F.when(both, F.col(b).cast("double"))).alias(f"c{i}"))
    wide = df.agg(*aggs)
    cells = [(a, b, i) for i, (a, b) in enumerate(pairs)] + [(b, a, i) for i, (a, b) in enumerate(pairs) if a != b]
    stack = ", ".join(f"'{a}', '{b}', c{i}" for a, b, i in cells)
    return wide.selectExpr(f"stack({len(cells)}, {stack}) as (col_a, col_b, corr)")


def corr_products(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E11 for wide tables: the same correlations from sums of products.

    Each task forms the masked products of its rows with NumPy (values, squares and
    known-masks, about the columns' means); one shuffle adds the tasks' sums by pair, so
    the plan does not grow with the columns and the shuffle not with the rows."""
    cols = list(columns)
    p = len(cols)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    means = values.agg(*[F.avg(F.nullif(f"c{i}", F.lit(float("nan")))).alias(f"c{i}") for i in range(p)]).first()
    centre = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    iu, ju = np.triu_indices(p)

    def part(batches):
        n, c, s, q = (np.zeros((p, p)) for _ in range(4))
        for pdf in batches:
            x = pdf.to_numpy(dtype=np.float64) - centre
            known = (~np.isnan(x)).astype(np.float64)
            x = np.nan_to_num(x, nan=0.0)
            n += known.T @ known
            c += x.T @ x
            s += x.T @ known
            q += (x * x).T @ known
        yield pd.DataFrame({"i": iu.astype(np.int32), "j": ju.astype(np.int32), "n": n[iu, ju], "c": c[iu, ju], "si": s[iu, ju],
                            "sj": s[ju, iu], "qi": q[iu, ju], "qj": q[ju, iu]})

    sums = (values.mapInPandas(part, "i int, j int, n double, c double, si double, sj double, qi double, qj double")
            .groupBy("i", "j").agg(*[F.sum(v).alias(v) for v in ("n", "c", "si", "sj", "qi", "qj")]))
    # what is left of a square sum after its mean: rounding of a constant column is none
    spread = lambda q, s: F.when(F.expr(f"{q} - try_divide({s} * {s}, n) > 1e-13 * {q}"), F.expr(f"{q} - {s} * {s} / n"))
    corr = F.try_divide(F.expr("c - try_divide(si * sj, n)"), F.sqrt(spread("qi", "si")) * F.sqrt(spread("qj", "sj")))
    name = lambda i: F.get(F.lit(cols), F.col(i))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return sums.select(corr.alias("corr"), F.explode(both).alias("pair")).select(
        name("pair.i").alias("col_a"), name("pair.j").alias("col_b"), "corr")


def count_where(df: DataFrame, cond: Column) -> DataFrame:
    """Non-null count of every column among rows satisfying ``cond``,
    unpivoted to ``(column, n)``."""
    f = df.where(cond)
    wide = f.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) as (column, n)")


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts of ``row`` x ``column`` with explicit pivot values (no extra
    distinct pass); absent combinations are 0."""
    out = df.groupBy(row).pivot(column, list(values)).count()
    return out.fillna(0, subset=[str(v) for v in values])


def histogram(df: DataFrame, c: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram ``(bin, lo, hi, n)`` over [min, max], empty bins included.

    min/max come from one aggregate row (bounded); the bin index is a column
    expression; counts are a partially aggregated ``groupBy``. The maximum
    falls into the last bin (NumPy rule).
    """
    r = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n long")
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(c).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(c).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def mean_std(df: DataFrame, c: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std (NumPy ``std``)."""
    aggs = [F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def profile(df: DataFrame) -> DataFrame:
    """``(column, dtype, non_null)`` per column from one aggregate."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    dtypes = dict(df.dtypes)
    stack = ", ".join(f"'{c}', '{dtypes[c]}', `{c}`" for c in df.columns)
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) as (column, dtype, non_null)")
