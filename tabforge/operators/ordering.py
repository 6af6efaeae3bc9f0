"""Order-dependent operators without a single-task window (SURVEY ids G2-G11,
B24, B25, K4/K5 ordinals, N5 prefix sums).

A global row number or running total over ``Window.orderBy`` with no
partitioning moves every row into one task. Here the rows are first
cut into ranges of the whole order key by bounds drawn once, so each range is
one window partition; per-range totals (one row per range) give the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET_ROWS_PER_RANGE = 2_000_000
MIN_ROWS_PER_RANGE = 50_000
#: Most ranges: their bounds are one expression, a balanced tree of comparisons.
MAX_RANGES = 2048
#: Keys drawn per range to place its bounds.
KEYS_PER_RANGE = 32


def _precedes(spec: Sequence[tuple[str, bool]], bound: Sequence) -> Column:
    """True where a row's order key comes before ``bound`` (NULL first ascending, last descending)."""
    out = F.lit(False)
    for (name, ascending), value in reversed(list(zip(spec, bound))):
        c = F.col(name)
        if value is None:
            before = F.lit(False) if ascending else c.isNotNull()
        elif ascending:
            before = c.isNull() | (c < F.lit(value))
        else:
            before = F.coalesce(c > F.lit(value), F.lit(False))
        out = F.coalesce(before, F.lit(False)) | (c.eqNullSafe(F.lit(value)) & out)
    return out


def _range_of(spec: Sequence[tuple[str, bool]], bounds: Sequence[Sequence], lo: int = 0) -> Column:
    """Number of bounds at or before a row's key, found by halving."""
    if not bounds:
        return F.lit(lo)
    mid = len(bounds) // 2
    return F.when(_precedes(spec, bounds[mid]), _range_of(spec, bounds[:mid], lo)).otherwise(
        _range_of(spec, bounds[mid + 1:], lo + mid + 1))


def _draw_bounds(df: DataFrame, spec: Sequence[tuple[str, bool]], n: int, ranges: int) -> list[tuple]:
    """Up to ``ranges - 1`` order keys that cut the rows into like parts.

    The keys of least hash are counted (so a repeated key is one row with its
    weight) and about ``KEYS_PER_RANGE`` per range reach the driver.
    """
    if ranges < 2:
        return []
    names = [c for c, _ in spec]
    share = min(1.0, KEYS_PER_RANGE * ranges / n)
    drawn = (df.select(*names).where(F.shiftrightunsigned(F.xxhash64(*names), 1) <= int(share * (2**63 - 1024)))
             .groupBy(*names).agg(F.count(F.lit(1)).alias("_k"))
             .orderBy(*[F.col(c).asc() if a else F.col(c).desc() for c, a in spec]).collect())
    total, seen, cuts = sum(r["_k"] for r in drawn), 0, []
    for r in drawn:
        if seen >= (len(cuts) + 1) * total / ranges:
            cuts.append(tuple(r[c] for c in names))
        seen += r["_k"]
    return cuts


def global_prefix(df: DataFrame, order: Sequence[str | tuple[str, bool]],
                  sums: dict[str, Column] | None = None, ordinal: str | None = None,
                  descending: bool = False,
                  target_rows: int = TARGET_ROWS_PER_RANGE) -> DataFrame:
    """Running sums and/or a 1-based ordinal over a total order.

    ``order`` items are names (direction from ``descending``) or
    ``(name, ascending)`` pairs; include a unique column last for a
    deterministic order. A row's range is a pure function of its order key: the
    key is compared with bounds drawn once, so totals per range (straight from
    the scan, one row per range, broadcast) and the numbering inside each range
    (one shuffle by range) always speak of the same ranges.
    """
    spec = [(o, not descending) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]
    sums = dict(sums or {})
    okeys = [F.col(c).asc() if a else F.col(c).desc() for c, a in spec]
    n = df.count()
    par = df.sparkSession.sparkContext.defaultParallelism
    ranges = min(MAX_RANGES, max(1, -(-n // target_rows), min(par, n // MIN_ROWS_PER_RANGE)))
    bounds = _draw_bounds(df, spec, n, ranges)
    # one range: 0 in a form that is not folded, or the join below would lose its key
    index = _range_of(spec, bounds) if bounds else F.spark_partition_id() * F.lit(0)
    work = df.withColumn("_rb", index.cast("int"))
    vals = {f"_v_{k}": v for k, v in sums.items()}
    if ordinal:
        vals["_v__ord"] = F.lit(1).cast("long")
    work = work.withColumns(vals)
    w_local = Window.partitionBy("_rb").orderBy(*okeys).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = work.groupBy("_rb").agg(*[F.sum(k).alias(f"_t{k}") for k in vals])
    local = work.withColumns({f"_l{k}": F.sum(k).over(w_local) for k in vals})
    # offsets over at most (#ranges) rows: a window on a tiny frame
    w_off = Window.orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_rb", *[F.coalesce(F.sum(f"_t{k}").over(w_off), F.lit(0))
                                     .alias(f"_o{k}") for k in vals])
    out = local.join(F.broadcast(offsets), on="_rb", how="left")
    final = {name: F.col(f"_o_v_{name}") + F.col(f"_l_v_{name}") for name in sums}
    if ordinal:
        final[ordinal] = (F.col("_o_v__ord") + F.col("_l_v__ord")).cast("long")
    drop = ["_rb", *vals, *[f"_l{k}" for k in vals], *[f"_o{k}" for k in vals]]
    return out.withColumns(final).drop(*drop)


def row_ordinal(df: DataFrame, order: Sequence[str], name: str = "row_id",
                target_rows: int = TARGET_ROWS_PER_RANGE) -> DataFrame:
    """1-based position in the total order ``order``."""
    return global_prefix(df, order, ordinal=name, target_rows=target_rows)


def sort_mixed(df: DataFrame, spec: Sequence[tuple[str, bool]]) -> DataFrame:
    """Multi-key sort, ``(column, ascending)`` pairs."""
    return df.orderBy(*[F.col(c).asc() if a else F.col(c).desc() for c, a in spec])


# Prime modulus 2^31 - 1 and odd multiplier 2654435761 (2^32 / golden ratio).
HASH_P = 2147483647
HASH_A = 2654435761


def seeded_hash_sql(key: str, seed: int) -> str:
    """SQL text of a seeded pseudo-random hash of a non-negative integer key.

    Affine step then a squaring step, in 64-bit integer arithmetic that never
    overflows (operands stay below 2^31 * 2^32). The same text runs in Spark and
    in DuckDB with identical results, unlike engine-specific hash functions, so
    shuffles, hold-outs and folds are reproducible across runs, engines and
    task recomputation after executor loss.
    """
    s1 = (int(seed) * 7919 + 17) % HASH_P
    s2 = (int(seed) * 104729 + 31) % HASH_P
    h1 = f"((cast({key} as bigint) % {HASH_P}) * {HASH_A} + {s1}) % {HASH_P}"
    return f"(({h1}) * ({h1}) + {s2}) % {HASH_P}"


def seeded_order_key(key: str, seed: int) -> Column:
    """Reproducible pseudo-random order key computed from the row key."""
    return F.expr(seeded_hash_sql(key, seed))


def seeded_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Joint shuffle of features and labels (same row) by a seeded key."""
    return df.orderBy(seeded_order_key(key, seed), F.col(key))


def union_all(frames: Sequence[DataFrame], origin: str | None = None,
              labels: Sequence[str] | None = None) -> DataFrame:
    """Union by name; missing columns are NULL. ``origin`` adds a
    column telling which input a row came from (replaces positional slices)."""
    out = None
    for i, f in enumerate(frames):
        if origin:
            f = f.withColumn(origin, F.lit(labels[i] if labels else i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out
