"""Row-local column expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen and works unchanged on batch and streaming
DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Derived arithmetic columns (otherwise plain ``withColumns``) ----------------

def family_size(*parts: ColumnOrName, plus: int = 1) -> Column:
    """B1: ``SibSp + Parch + 1`` style sum of count columns."""
    total = F.lit(plus)
    for p in parts:
        total = total + col(p)
    return total


# Ratios --------------------------------------------------------------------

def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / nullif(den, 0)``: a zero denominator gives NULL, never an error."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def ratio_features(df: DataFrame, ratios: Mapping[str, tuple[str, str]],
                   optional: Mapping[str, tuple[str, str]] | None = None,
                   add_optional: bool = True) -> DataFrame:
    """B2: ratio features, with an optional group switched by a flag
    (``add_bedrooms_per_room``)."""
    exprs = {name: safe_ratio(a, b) for name, (a, b) in ratios.items()}
    if add_optional and optional:
        exprs.update({name: safe_ratio(a, b) for name, (a, b) in optional.items()})
    return df.withColumns(exprs)


# Constant column at a position --------------------------------------------------

def insert_constant(df: DataFrame, name: str, value, position: int = 0) -> DataFrame:
    cols = [F.col(c) for c in df.columns if c != name]
    cols.insert(position, F.lit(value).alias(name))
    return df.select(*cols)


# Projections ----------------------------------------------------------------

def columns_of_type(df: DataFrame, types: Iterable[str], exclude: Iterable[str] = ()) -> list[str]:
    """Names of columns whose Spark type is in ``types``, minus ``exclude``
    (schema metadata only, no data is read)."""
    want, drop = set(types), set(exclude)
    return [c for c, t in df.dtypes if t in want and c not in drop]


def with_label_last(df: DataFrame, label: str, features: Iterable[str] | None = None,
                    name: str = "label") -> DataFrame:
    """``y = X.pop(label)`` keeps features and label in *one* frame: the
    feature columns, then the label renamed to ``name`` (no positional pairing)."""
    feats = [c for c in (features if features is not None else df.columns) if c != label]
    return df.select(*feats, F.col(label).alias(name))


# Casts and rounding ----------------------------------------------

def trunc_int(c: ColumnOrName) -> Column:
    """Cast toward zero (Spark's double->int cast truncates)."""
    return col(c).cast("int")


def round_half_even_int(c: ColumnOrName) -> Column:
    """banker's rounding then int (``np.round`` / Python ``round``)."""
    return F.bround(col(c), 0).cast("int")


def ceil_cap(c: ColumnOrName, divisor: float, cap: float) -> Column:
    """``ceil(x / divisor)`` capped at ``cap``.

    Mirrors ``s.where(s < cap, cap)``: the comparison is false for a missing
    value, so a NULL input becomes ``cap``.
    """
    v = F.ceil(col(c) / F.lit(divisor)).cast("double")
    return F.when(v < F.lit(cap), v).otherwise(F.lit(float(cap)))


# Predicates to values -----------------------------------------------------

def indicator(cond: Column) -> Column:
    """0/1 int from a predicate; an unknown (NULL) predicate counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def threshold(score: ColumnOrName, t: float, strict: bool = True) -> Column:
    """Class 1.0 where the score exceeds ``t``, else 0.0 (NULL stays NULL)."""
    s = col(score)
    cond = s > F.lit(t) if strict else s >= F.lit(t)
    return F.when(s.isNull(), F.lit(None).cast("double")).when(cond, 1.0).otherwise(0.0)


# Rule chains and overrides ------------------------------------------------

def rule_chain(rules: Sequence[tuple[Column, object]], default) -> Column:
    """Sequential overwrite rules where *later* rules win.

    ``rules`` are applied in the given order like repeated ``df.loc[cond, c] = v``
    statements, so the CASE expression is built in reverse precedence.
    """
    expr = None
    for cond, value in reversed(list(rules)):
        v = value if isinstance(value, Column) else F.lit(value)
        c = F.coalesce(cond, F.lit(False))
        expr = F.when(c, v) if expr is None else expr.when(c, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def point_override(value: ColumnOrName, key: ColumnOrName,
                   overrides: Mapping[object, object]) -> Column:
    """Replace ``value`` for a handful of literal keys (fixed, small map).

    Larger override sets belong in a table: see ``operators.lookup.keyed_update``.
    """
    expr = col(value)
    out = None
    for k, v in overrides.items():
        cond = col(key) == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return expr if out is None else out.otherwise(expr)


# Missing values -------------------------------------------------------------

def sentinel_to_null(c: ColumnOrName, sentinel=0.0) -> Column:
    """A sentinel value (e.g. a zero fare) becomes NULL."""
    return F.nullif(col(c), F.lit(sentinel))


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN is a value in Spark aggregates; convert it to NULL at load."""
    x = col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULLs with constants per column."""
    return df.fillna(dict(values))


def fill_from(c: ColumnOrName, *fallbacks: ColumnOrName) -> Column:
    """Fill NULLs from another column or expression."""
    return F.coalesce(col(c), *[col(f) for f in fallbacks])
