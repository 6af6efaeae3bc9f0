"""Array (vector / image) expressions.

Images are ``array<double>`` in row-major order (pixel ``r * width + c``);
everything is a higher-order function over the array, evaluated in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnOrName, col


def to_double_array(c: ColumnOrName) -> Column:
    """float32 vectors are widened before any arithmetic."""
    return col(c).cast("array<double>")


def array_sum(a: ColumnOrName) -> Column:
    return F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x)


def softmax(a: ColumnOrName, stable: bool = True) -> Column:
    """``exp(x) / sum(exp(x))``; ``stable`` subtracts the row max first
    (same result where the naive form does not overflow)."""
    arr = col(a)
    m = F.array_max(arr) if stable else F.lit(0.0)
    e = F.transform(arr, lambda x: F.exp(x - m))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda acc, y: acc + y))


def with_softmax(df, a: ColumnOrName, out: str, stable: bool = True):
    """H10 as three projections (max, exps, sum) so each is computed once per
    row: a lambda cannot share a sub-expression with its enclosing row, so the
    single-expression ``softmax`` re-evaluates the sum for every element."""
    arr = col(a)
    df = df.withColumn("_sm_m", F.array_max(arr) if stable else F.lit(0.0))
    df = df.withColumn("_sm_e", F.transform(arr, lambda x: F.exp(x - F.col("_sm_m"))))
    df = df.withColumn("_sm_s", F.aggregate("_sm_e", F.lit(0.0), lambda acc, y: acc + y))
    return df.withColumn(out, F.transform("_sm_e", lambda x: x / F.col("_sm_s"))).drop(
        "_sm_m", "_sm_e", "_sm_s")


def cross_entropy_term(probs: ColumnOrName, label: ColumnOrName, eps: float = 1e-10) -> Column:
    """``-ln(p[label] + eps)`` per row; average it for the loss."""
    return -F.ln(F.get(col(probs), col(label)) + F.lit(eps))


def argmax(a: ColumnOrName) -> Column:
    """0-based index of the first maximum."""
    arr = col(a)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def prepend_bias(a: ColumnOrName, value: float = 1.0) -> Column:
    """Bias term of ones in front of the features."""
    return F.concat(F.array(F.lit(float(value))), col(a))


def scale(a: ColumnOrName, divisor: float = 255.0) -> Column:
    """Pixel scaling."""
    return F.transform(col(a), lambda x: x / F.lit(float(divisor)))


def reshape_rows(a: ColumnOrName, width: int) -> Column:
    """Flat ``width*width`` array to an array of rows."""
    arr = col(a)
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                       lambda r: F.slice(arr, r * width + 1, F.lit(width)))


def flatten_rows(m: ColumnOrName) -> Column:
    """H14 inverse."""
    return F.flatten(col(m))


def _pixel(arr: Column, r: Column, c: Column, width: int) -> Column:
    inside = (r >= 0) & (r < width) & (c >= 0) & (c < width)
    return F.when(inside, F.get(arr, r * width + c)).otherwise(F.lit(0.0))


def pad(a: ColumnOrName, width: int, p: int) -> Column:
    """Zero border of ``p`` pixels (``width`` -> ``width + 2p``)."""
    arr = col(a)
    m = width + 2 * p
    return F.transform(
        F.sequence(F.lit(0), F.lit(m * m - 1)),
        lambda i: _pixel(arr, F.floor(i / m).cast("int") - p, (i % m) - p, width))


def shift(a: ColumnOrName, width: int, dr: int, dc: int) -> Column:
    """Move the image ``dr`` rows down and ``dc`` columns right, zero fill."""
    arr = col(a)
    return F.transform(
        F.sequence(F.lit(0), F.lit(width * width - 1)),
        lambda i: _pixel(arr, F.floor(i / width).cast("int") - dr, (i % width) - dc, width))


# The four one-pixel moves (down, up, right, left).
FOUR_SHIFTS: Sequence[tuple[str, int, int]] = (("down", 1, 0), ("up", -1, 0),
                                               ("right", 0, 1), ("left", 0, -1))


def shifted_copies(a: ColumnOrName, width: int,
                   moves: Sequence[tuple[str, int, int]] = FOUR_SHIFTS) -> Column:
    """Array of ``struct(move, pixels)`` to ``explode`` into 4 extra rows."""
    return F.array(*[F.struct(F.lit(n).alias("move"), shift(a, width, dr, dc).alias("pixels"))
                     for n, dr, dc in moves])
