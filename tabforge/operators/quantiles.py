"""Exact quantiles with bounded work per task (used by E7, E9, E10, J9).

``percentile``/``median`` aggregates keep every distinct value of a group in
one buffer, which for a group holding a third of 100 TB does not fit one task.
This module finds the exact order statistics instead by *histogram
refinement*, each step a partially aggregated ``groupBy``:

1. per group: ``n, min, max`` of the non-null values;
2. the ranks needed for quantile ``p`` (linear interpolation, NumPy default,
   same as Spark ``percentile`` and DuckDB ``quantile_cont``) are
   ``floor(p*(n-1))`` and ``ceil(p*(n-1))``;
3. while a rank's candidate range ``[lo, hi]`` holds more than ``max_exact``
   values, histogram the range into ``bins`` equal-width bins with
   ``groupBy(key, rank, bin).agg(count, min, max)`` and keep the bin that holds
   the rank (a prefix sum over at most ``bins`` rows per rank);
4. when the range holds at most ``max_exact`` rows or distinct values, count
   the distinct values inside it (``groupBy(key, rank, value).count()``, at most
   ``max_exact`` rows per rank) and pick the value whose running count covers
   the rank.

The first pass also estimates each group's number of distinct values
(HyperLogLog), so a group with few distinct values, however many rows it has,
goes straight to step 4: one pass after the statistics. Each refinement
shrinks the value range by at least ``bins``, so the loop ends in a handful
of passes. The per-rank state is one row per (group, rank): cached after the
first aggregate, checkpointed after each refinement to cut lineage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DEFAULT_MAX_EXACT = 50_000
DEFAULT_BINS = 4096
_G = "_qgrp"


def _rank_exprs(p: float):
    pos = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
    return F.floor(pos).cast("long"), F.ceil(pos).cast("long"), pos - F.floor(pos)


def order_statistics(df: DataFrame, keys: Sequence[str], x: str,
                     probs: Sequence[float], max_exact: int = DEFAULT_MAX_EXACT,
                     bins: int = DEFAULT_BINS) -> DataFrame:
    """Return ``(keys, _n, _k, _v)``: the exact value ``_v`` at 0-based rank
    ``_k`` for every needed rank of every group (``_n`` values in the group).

    Rows with a NULL key, or a NULL or NaN value, take no part (pandas drops
    NaN keys and skips NaN values). Values are assumed finite."""
    spark = df.sparkSession
    ks = list(keys)
    cond = F.col("_x").isNotNull() & ~F.isnan("_x")   # NaN is missing, as in pandas
    for k in ks:
        cond = cond & F.col(k).isNotNull()
    data = df.select(*ks, F.col(x).cast("double").alias("_x")).where(cond)
    stats = data.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"),
                                  F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                                  F.approx_count_distinct("_x", 0.02).alias("_ndv"))
    ranks = []
    for p in probs:
        k1, k2, _ = _rank_exprs(p)
        ranks += [k1, k2]
    # initial state: one aggregate of the data, short lineage -> cached, not checkpointed
    state = stats.select(*ks, "_n", F.explode(F.array_distinct(F.array(*ranks))).alias("_k"),
                         "_lo", "_hi", F.lit(0).cast("long").alias("_below"),
                         F.col("_n").alias("_cnt"), F.col("_ndv")).persist()
    ensure_checkpoint_dir(spark)

    # ndv carries a 2% estimate error: keep a margin below max_exact
    open_cond = ((F.col("_cnt") > F.lit(max_exact)) & (F.col("_lo") < F.col("_hi"))
                 & (F.col("_ndv") > F.lit(int(max_exact * 0.9))))
    pending_cond = F.col("_lo") < F.col("_hi")

    def flags(st):  # one small job on the (cached or checkpointed) state
        r = st.agg(F.max(open_cond.cast("int")).alias("o"),
                   F.max(pending_cond.cast("int")).alias("p")).first()
        return bool(r["o"]), bool(r["p"])

    for _ in range(200):
        has_open, has_pending = flags(state)
        if not has_open:
            break
        active = state.where(open_cond)
        span = F.col("_hi") / 2 - F.col("_lo") / 2
        b = F.least(F.floor((F.col("_x") / 2 - F.col("_lo") / 2) / span * F.lit(bins)),
                    F.lit(bins - 1)).cast("int")
        hist = (data.join(active.select(*ks, "_k", "_lo", "_hi"), on=ks)
                .where(F.col("_x").between(F.col("_lo"), F.col("_hi")))
                .groupBy(*ks, "_k", b.alias("_bin"))
                .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_bmin"),
                     F.max("_x").alias("_bmax")))
        w = Window.partitionBy(*ks, "_k").orderBy("_bin").rowsBetween(
            Window.unboundedPreceding, -1)
        hist = (hist.join(active.select(*ks, "_n", "_k", "_below"), on=[*ks, "_k"])
                .withColumn("_cum", F.coalesce(F.sum("_c").over(w), F.lit(0)))
                .where((F.col("_below") + F.col("_cum") <= F.col("_k"))
                       & (F.col("_k") < F.col("_below") + F.col("_cum") + F.col("_c"))))
        refined = hist.select(*ks, "_n", "_k", F.col("_bmin").alias("_lo"),
                              F.col("_bmax").alias("_hi"),
                              (F.col("_below") + F.col("_cum")).alias("_below"),
                              F.col("_c").alias("_cnt"), F.col("_c").alias("_ndv"))
        # iterative state: reliable checkpoint cuts the growing lineage
        state = state.where(~open_cond).unionByName(refined).checkpoint()
    else:  # pragma: no cover - range shrinks by `bins` per pass
        raise RuntimeError("quantile refinement did not converge")

    single = state.where(F.col("_lo") == F.col("_hi")).select(
        *ks, "_n", "_k", F.col("_lo").alias("_v"))
    pending = state.where(pending_cond)
    if not has_pending:
        return single
    counts_in = (data.join(pending.select(*ks, "_n", "_k", "_lo", "_hi", "_below"), on=ks)
                 .where(F.col("_x").between(F.col("_lo"), F.col("_hi")))
                 .groupBy(*ks, "_n", "_k", "_below", "_x").agg(F.count(F.lit(1)).alias("_c")))
    wv = Window.partitionBy(*ks, "_k").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    picked = (counts_in.withColumn("_cum", F.coalesce(F.sum("_c").over(wv), F.lit(0)))
              .where((F.col("_below") + F.col("_cum") <= F.col("_k"))
                     & (F.col("_k") < F.col("_below") + F.col("_cum") + F.col("_c")))
              .select(*ks, "_n", "_k", F.col("_x").alias("_v")))
    return single.unionByName(picked)


def long_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                col_name: str = "_col", value: str = "_xv") -> DataFrame:
    """Stack several value columns into ``(keys, col_name, value)`` so one set
    of passes serves all of them."""
    return df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias(col_name), F.col(c).cast("double").alias(value))
        for c in columns])).alias("_lv")).select(*keys, f"_lv.{col_name}", f"_lv.{value}")


def group_quantiles(df: DataFrame, keys: Sequence[str], x: str,
                    probs: Mapping[str, float], max_exact: int = DEFAULT_MAX_EXACT,
                    bins: int = DEFAULT_BINS, approx_accuracy: int | None = None) -> DataFrame:
    """Exact interpolated quantiles per group: ``(keys..., name...)``.

    Groups whose values are all NULL do not appear (a left join gives NULL).
    ``approx_accuracy`` switches to one pass of ``percentile_approx`` (a
    mergeable sketch of bounded size; rank error about n / accuracy, and it
    returns data values, without interpolation).
    """
    if approx_accuracy is not None:
        v = F.col(x).cast("double")
        clean = df.where(v.isNotNull() & ~F.isnan(v))
        return clean.groupBy(*keys).agg(*[
            F.percentile_approx(v, float(p), int(approx_accuracy)).alias(n)
            for n, p in probs.items()])
    ks = list(keys)
    added = not ks
    if added:
        df = df.withColumn(_G, F.lit(0))
        ks = [_G]
    values = order_statistics(df, ks, x, list(probs.values()), max_exact, bins)
    # at most 2 entries per probability and group: a bounded map per group
    out = values.groupBy(*ks).agg(
        F.first("_n").alias("_n"),
        F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_m"))
    cols = []
    for name, p in probs.items():
        k1, k2, frac = _rank_exprs(p)
        v1 = F.element_at("_m", k1)
        v2 = F.element_at("_m", k2)
        cols.append((v1 + frac * (v2 - v1)).alias(name))
    out = out.select(*ks, *cols)
    return out.drop(_G) if added else out


def group_quantiles_multi(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                          p: float, prefix: str = "", max_exact: int = DEFAULT_MAX_EXACT
                          ) -> DataFrame:
    """Quantile ``p`` of several columns per group in one set of passes:
    ``(keys..., prefix + column...)``."""
    ks = list(keys)
    added = not ks
    if added:
        df = df.withColumn(_G, F.lit(0))
        ks = [_G]
    long = long_values(df, ks, columns)
    q = group_quantiles(long, [*ks, "_col"], "_xv", {"_q": p}, max_exact)
    wide = q.groupBy(*ks).pivot("_col", list(columns)).agg(F.first("_q"))
    wide = wide.select(*ks, *[F.col(f"`{c}`").alias(prefix + c) for c in columns])
    return wide.drop(_G) if added else wide


def global_quantiles(df: DataFrame, columns: Sequence[str], p: float,
                     max_exact: int = DEFAULT_MAX_EXACT) -> dict[str, float | None]:
    """Exact quantile ``p`` of each column as driver values (one small row)."""
    r = group_quantiles_multi(df, [], columns, p, max_exact=max_exact).first()
    return {c: (None if r is None else r[c]) for c in columns}


def global_cuts(df: DataFrame, c: str, probs: Sequence[float],
                max_exact: int = DEFAULT_MAX_EXACT) -> list[float]:
    """Exact quantiles of one column at several probabilities (J9 cut points)."""
    names = {f"q{i}": p for i, p in enumerate(probs)}
    r = group_quantiles(df, [], c, names, max_exact).first()
    return [] if r is None else [r[n] for n in names]
