"""Hold-outs, stratified splits and folds.

Every split is a *column* (``split`` or ``fold``) on one frame, so parts are
disjoint and exhaustive by construction and no positional slice is needed.
Randomness comes from ``ordering.seeded_hash_sql``: a function of the row key
and the seed, so a recomputed task after executor loss assigns the same rows.

Exact-size splits need a row's ordinal in hash order within its stratum. The
hash is uniform, so it is cut into equal ranges (``R`` per stratum, sized so a
range holds ~``target_rows`` rows); a window numbers rows inside each
(stratum, range) and a small per-range count table gives the offsets. No task
ever holds a whole stratum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import HASH_P, seeded_hash_sql

TARGET_ROWS = 2_000_000
MIN_ROWS_PER_RANGE = 50_000


def n_ranges(spark, n: int, target_rows: int) -> int:
    """Ranges for ``n`` rows: at most ``target_rows`` each, and at least the
    default parallelism while ranges keep ``MIN_ROWS_PER_RANGE`` rows."""
    par = spark.sparkContext.defaultParallelism
    return max(1, -(-n // target_rows), min(par, n // MIN_ROWS_PER_RANGE))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where a NULL key matches a NULL key (a NULL stratum is a group)."""
    if not keys:
        return left
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def hash_col(key: str, seed: int) -> Column:
    return F.expr(seeded_hash_sql(key, seed))


def hash_ordinal(df: DataFrame, key: str, seed: int, by: Sequence[str] = (),
                 name: str = "_ord", size_name: str = "_n",
                 target_rows: int = TARGET_ROWS) -> DataFrame:
    """1-based ordinal of each row in seeded-hash order (ties by key) within
    its stratum ``by``, plus the stratum size."""
    by = list(by)
    work = df.withColumn("_h", hash_col(key, seed))
    gkeys = by
    if gkeys:
        sizes = work.groupBy(*gkeys).agg(F.count(F.lit(1)).alias(size_name))
        par = df.sparkSession.sparkContext.defaultParallelism
        sizes = sizes.withColumn("_R", F.greatest(
            F.lit(1), F.ceil(F.col(size_name) / F.lit(target_rows)),
            F.least(F.lit(par), F.floor(F.col(size_name) / F.lit(MIN_ROWS_PER_RANGE)))).cast("long"))
        work = _join_null_safe(work, sizes, gkeys)
    else:  # one stratum: its size is a driver scalar
        n = work.count()
        work = work.withColumns({size_name: F.lit(n).cast("long"),
                                 "_R": F.lit(n_ranges(df.sparkSession, n, target_rows)).cast("long")})
    work = work.withColumn("_rb", F.floor(F.col("_h") * F.col("_R") / F.lit(HASH_P)).cast("long"))
    w = Window.partitionBy(*gkeys, "_rb").orderBy("_h", key)
    work = work.withColumn("_local", F.row_number().over(w))
    counts = work.groupBy(*gkeys, "_rb").agg(F.count(F.lit(1)).alias("_c"))
    w_off = Window.partitionBy(*gkeys).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*gkeys, "_rb", F.coalesce(F.sum("_c").over(w_off), F.lit(0)).alias("_off"))
    out = _join_null_safe(work, offsets, [*gkeys, "_rb"])
    return out.withColumn(name, (F.col("_off") + F.col("_local")).cast("long")).drop(
        "_h", "_R", "_rb", "_local", "_off")


def random_holdout(df: DataFrame, key: str, test_ratio: float, seed: int,
                   out: str = "split") -> DataFrame:
    """K1: approximate-size hold-out by seeded hash (no count needed)."""
    cut = int(round(test_ratio * HASH_P))
    return df.withColumn(out, F.when(hash_col(key, seed) < F.lit(cut), F.lit("test"))
                         .otherwise(F.lit("train")))


def exact_holdout(df: DataFrame, key: str, test_ratio: float, seed: int,
                  by: Sequence[str] = (), out: str = "split",
                  target_rows: int = TARGET_ROWS) -> DataFrame:
    """K1 exact / K2 stratified: in each stratum the first
    ``floor(n * ratio + 0.5)`` rows in hash order are 'test'."""
    o = hash_ordinal(df, key, seed, by, target_rows=target_rows)
    n_test = F.floor(F.col("_n") * F.lit(float(test_ratio)) + F.lit(0.5))
    return o.withColumn(out, F.when(F.col("_ord") <= n_test, F.lit("test"))
                        .otherwise(F.lit("train"))).drop("_ord", "_n")


def three_way_split(df: DataFrame, key: str, test_ratio: float, valid_ratio: float,
                    seed: int, out: str = "split", target_rows: int = TARGET_ROWS) -> DataFrame:
    """K4: exact sizes ``test = int(n*test_ratio)``, ``valid = int(n*valid_ratio)``,
    train = the rest, in seeded-hash order."""
    o = hash_ordinal(df, key, seed, target_rows=target_rows)
    n_test = F.floor(F.col("_n") * F.lit(float(test_ratio)))
    n_valid = F.floor(F.col("_n") * F.lit(float(valid_ratio)))
    return o.withColumn(out, F.when(F.col("_ord") <= n_test, F.lit("test"))
                        .when(F.col("_ord") <= n_test + n_valid, F.lit("valid"))
                        .otherwise(F.lit("train"))).drop("_ord", "_n")


def positional_split(ordered: DataFrame, ordinal: str, n: int,
                     fractions: Sequence[tuple[str, float]], out: str = "split") -> DataFrame:
    """Consecutive ranges of an ordinal (``iloc[:a]``, ``[a:b]``...).

    ``fractions`` like ``[("train", .75), ("valid", .05), ("test", .20)]``; the
    boundaries are ``int(n * cumulative)``, the last part takes the rest.
    """
    expr = None
    acc = 0.0
    for name, frac in fractions[:-1]:
        acc += frac
        cond = F.col(ordinal) <= F.lit(int(n * acc))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(fractions[-1][0])
    return ordered.withColumn(out, last if expr is None else expr.otherwise(last))


def kfold(df: DataFrame, key: str, k: int, seed: int, by: Sequence[str] = (),
          out: str = "fold", target_rows: int = TARGET_ROWS, exact: bool = True) -> DataFrame:
    """K6: fold ids 0..k-1.

    ``exact`` deals folds round-robin in seeded-hash order, so sizes differ by
    at most one per stratum (``by``); it needs the hash ordinal (a window per
    hash range). ``exact=False`` is ``hash mod k``: a pure projection, no
    shuffle, sizes balanced only in expectation (enough for cross-validation).
    """
    if not exact:
        return df.withColumn(out, F.pmod(hash_col(key, seed), F.lit(k)).cast("int"))
    o = hash_ordinal(df, key, seed, by, target_rows=target_rows)
    return o.withColumn(out, ((F.col("_ord") - 1) % F.lit(k)).cast("int")).drop("_ord", "_n")


def repeated_holdout_baseline(df: DataFrame, key: str, target: str, reps: int,
                              test_ratio: float) -> DataFrame:
    """K7 with the constant-mean model: for each repetition ``r`` (seed r), fit
    the train mean and score test MSE.

    Two scans in total, whatever ``reps``: each holds one pair of sums a
    repetition, side by side, so a row is read and shuffled no oftener for more
    repetitions; first the train means (one row), then the test errors against
    those means.
    """
    y = F.col(target).cast("double")
    cut = F.lit(int(round(test_ratio * HASH_P)))
    rows = df.select(y.alias("_y"), *[(hash_col(key, r) < cut).alias(f"_t{r}") for r in range(reps)])
    means = rows.agg(*[F.avg(F.when(~F.col(f"_t{r}"), F.col("_y"))).alias(f"m{r}") for r in range(reps)]).first()   # one row
    found = rows.agg(F.count(F.lit(1)).alias("n"), *[c for r in range(reps) for c in (
        F.avg(F.when(F.col(f"_t{r}"), F.pow(F.col("_y") - F.lit(means[f"m{r}"]).cast("double"), 2))).alias(f"e{r}"),
        F.count_if(F.col(f"_t{r}")).alias(f"n{r}"))])
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rep"), F.col(f"e{r}").alias("mse"), F.col(f"n{r}").alias("n_test"))
                               for r in range(reps)]))
    return found.where("n > 0").select(each.alias("r")).select("r.*")                   # an empty table gives no rows
